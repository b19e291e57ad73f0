"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

The field is fitted by maximum likelihood on a bounded sample of labelled documents, with
weak line labels: a line is boilerplate if it repeats an earlier one or its document is
labelled as bad. Viterbi decoding runs in Arrow batches, all documents of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm.common import WHITE, add_columns, sampled, table, texts_of
from dealtide.llm.textstats import SYMBOLS, code_points, n_of, repeated_words

# Training documents at most, and their lines at most: longer ones are no training documents.
SAMPLE, SAMPLE_LINES = 800, 120
# A document is kept if content lines hold at least this share of its words.
CONTENT_SHARE = 0.5
# The base rules of the query.
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
N_FEATURES = 16


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[float]:
    n, size = len(words), len(line)
    symbols, upper = n_of(line, SYMBOLS) / n, n_of(line, _UPPER) / size
    same = sum(map(bytes.__eq__, words[1:], words)) / n
    long = size / n
    return [
        1.0, n <= 3, 3 < n <= 10, n > 40, symbols > 0.15, symbols > 0.5, upper > 0.2, upper > 0.5, same > 0.1, same > 0.4,
        seen, b"!!" in line, b" | " in line, n_of(line, _DIGITS) / size > 0.2, long > 20 or long < 2.5, line.rstrip(WHITE)[-1:] in b".!?",
    ]


@dataclass
class Lines:
    """The worded lines of one document and its base counts."""

    features: list[list[float]]
    sizes: list[int]
    counts: tuple[int, int, int, int, int]


def read_lines(data: bytes | None) -> Lines:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and features of each line with a word."""
    data = data or b""
    seen: set[bytes] = set()
    features, sizes, repeats = [], [], 0
    for line in data.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again = line in seen
        seen.add(line)
        repeats += again
        features.append(line_features(line, words, again))
        sizes.append(len(words))
    words = data.split()
    chars = code_points(data) - n_of(data, WHITE)
    return Lines(features, sizes, (len(words), chars, n_of(data, SYMBOLS), repeats, repeated_words(words)))


@dataclass
class Field:
    """Weights of a two-state chain: state 1 is content. ``steps[a, b]`` scores a line in b after one in a."""

    weights: np.ndarray
    steps: np.ndarray

    def content(self, documents: list[list[list[float]]]) -> list[np.ndarray]:
        """Viterbi: for each document the best state of each line. All documents advance line by line."""
        lengths = np.array([len(d) for d in documents])
        if not lengths.sum():
            return [np.zeros(0, np.int8) for _ in documents]
        order = np.argsort(-lengths, kind="stable")
        ordered = lengths[order]
        starts = np.concatenate([[0], np.cumsum(ordered)])[:-1]
        flat = np.array([f for i in order for f in documents[i]], np.float64) @ self.weights
        back = np.zeros((len(flat), 2), np.int8)
        score = np.zeros((len(documents), 2))
        live = int((ordered > 0).sum())
        score[:live, 1] = flat[starts[:live]]
        for t in range(1, int(ordered[0])):
            live = int((ordered > t).sum())
            ways = score[:live, :, None] + self.steps  # document, from, to
            back[starts[:live] + t] = best = ways.argmax(1)
            score[:live] = np.take_along_axis(ways, best[:, None, :], 1)[:, 0]
            score[:live, 1] += flat[starts[:live] + t]
        states = np.zeros(len(flat), np.int8)
        state = score.argmax(1)
        for t in range(int(ordered[0]) - 1, -1, -1):
            live = int((ordered > t).sum())
            states[starts[:live] + t] = state[:live]
            if t:
                state[:live] = back[starts[:live] + t, state[:live]]
        out = [np.zeros(0, np.int8)] * len(documents)
        for place, i in enumerate(order):
            out[i] = states[starts[place] : starts[place] + ordered[place]]
        return out


def fit_field(documents: list[list[list[float]]], labels: list[list[int]], rounds: int = 80) -> Field:
    """Maximum likelihood with a small ridge, by Adam; forward and backward sums over all documents at once."""
    weights, steps = np.zeros(N_FEATURES), np.zeros((2, 2))
    if not documents:
        weights[0] = 1.0
        return Field(weights, steps)
    size, longest = len(documents), max(map(len, documents))
    x = np.zeros((size, longest, N_FEATURES))
    y = np.zeros((size, longest), int)
    on = np.zeros((size, longest))
    for i, (d, states) in enumerate(zip(documents, labels, strict=True)):
        x[i, : len(d)], y[i, : len(d)], on[i, : len(d)] = d, states, 1
    pairs = on[:, 1:] * on[:, :-1]
    seen_pairs = np.array([[(pairs * (y[:, :-1] == a) * (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    first, second = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    total = on.sum()
    for r in range(1, rounds + 1):
        gain = x @ weights
        ahead, behind = np.zeros((size, longest, 2)), np.zeros((size, longest, 2))
        ahead[:, 0, 1] = gain[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, axis=1)
            step[:, 1] += gain[:, t]
            ahead[:, t] = np.where(on[:, t, None] > 0, step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead_of = behind[:, t + 1].copy()
            ahead_of[:, 1] += gain[:, t + 1]
            step = np.logaddexp.reduce(steps + ahead_of[:, None, :], axis=2)
            behind[:, t] = np.where(on[:, t + 1, None] > 0, step, 0)
        norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
        likely = np.exp(ahead[:, :, 1] + behind[:, :, 1] - norm[:, None]) * on
        grad = np.einsum("dt,dtf->f", (y * on) - likely, x)
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                log = ahead[:, :-1, a] + steps[a, b] + b * gain[:, 1:] + behind[:, 1:, b] - norm[:, None]
                expected[a, b] = np.exp(np.where(pairs > 0, log, -np.inf)).sum()
        g = np.concatenate([grad, (seen_pairs - expected).ravel()]) / total
        g -= 1e-3 * np.concatenate([weights, steps.ravel()])
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        move = 0.1 * first / (1 - 0.9**r) / (np.sqrt(second / (1 - 0.99**r)) + 1e-8)
        weights = weights + move[:N_FEATURES]
        steps = steps + move[N_FEATURES:].reshape(2, 2)
    return Field(weights, steps)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """The field, from at most about ``sample`` labelled documents of at most ``SAMPLE_LINES`` lines.

    Only line features of the sample come to the driver, never texts. Without labels every line is content.
    """
    chosen = sampled(labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "quality"), "doc_id", sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batch: pa.RecordBatch) -> list:
        found = [read_lines(t).features for t in texts_of(batch)]
        return [[f if 0 < len(f) <= SAMPLE_LINES else [] for f in found]]

    read = add_columns(rows, "features array<array<double>>", features, drop=("text",)).where("size(features) > 0")
    got = sorted(((r.doc_id, r.quality, r.features) for r in read.collect()), key=lambda r: (r[0], r[1]))
    states = [[int(quality == 1 and not line[10]) for line in lines] for _, quality, lines in got]
    return fit_field([lines for _, _, lines in got], states)


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, content_share double, kept boolean"
)


def judge(documents: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """``documents`` with the columns of ``FIELDS``, which replace input columns of these names.

    A null or empty text has no words, so it fails the base rules. A text is kept if the base
    rules pass and lines marked as content hold ``share`` of its words or more. Each row is
    judged by its own text only: repeated rows get equal verdicts; empty tables stay empty.
    """

    def columns(batch: pa.RecordBatch) -> list:
        read = [read_lines(t) for t in texts_of(batch)]
        states = field.content([r.features for r in read])
        shares = [float(np.dot(s, r.sizes)) / max(1, r.counts[0]) for s, r in zip(states, read, strict=True)]
        failed = [r.counts[0] < LEAST_WORDS or 100 * r.counts[4] > MOST_REPEATED_PERCENT * r.counts[0] for r in read]
        kept = [not f and s >= share for f, s in zip(failed, shares, strict=True)]
        return [*([r.counts[i] for r in read] for i in range(5)), failed, shares, kept]

    return add_columns(documents, FIELDS, columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train(documents, table(spark, sf_dir, "labels"))
    return judge(documents, field).drop("text")
