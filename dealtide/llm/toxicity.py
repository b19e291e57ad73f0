"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words and their first letters are hashed to rows of an embedding table; filters one, two and three words wide slide
over the text, the greatest response of each filter is kept, and a logistic layer reads
these. As a filter is linear, its response is a sum of table rows of its words, so scoring
looks precomputed rows up. The language that selects a threshold is predicted from the text.

All labelled rows outside of the held-out ones are learned from. Three quarters fit the weights, in shards of a bounded size: each
task fits its shard from the same weights, and the mean of the shards' weights begins the next round. The other rows
give the thresholds, from counts of all their scores. Texts stay where they are read: their hashed words, or their
scores, go to the labels.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm import language_id
from dealtide.llm.common import add_columns, fold, remainder, segments, table, texts_of

# Rows of a shard, about. Texts of more words fit no weights, as a shard is held in memory; they count for the thresholds.
SHARD, SHARD_WORDS = 6000, 4000
# Passes over the training rows, of one shard and of several, whose mean is taken after each.
ROUNDS, SHARED_ROUNDS = 7, 3
# Scores are counted in so many bins, each with its least and greatest score.
BINS = 1 << 14
# Bucket numbers are stored as int16.
BUCKETS, WIDTHS, FILTERS, SIZE, START = 1 << 15, (1, 2, 3), 8, 12, 4
# The held-out rows and the threshold of the query.
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
_WORD = re.compile(r"\w+")
_CACHE = 200_000
_PART = 1 << 17


def hashed_words(text: bytes | None, cache: dict[str, tuple[int, int]]) -> np.ndarray:
    """Word by (bucket of the lower-cased word, bucket of its start), over a whole text; bucket 0 pads.

    The start has ``START`` letters, so that inflected forms of one stem share a row.
    """
    parts = []
    for part in segments(text or b""):
        words = _WORD.findall(part.decode("utf-8", "replace").lower())
        if len(cache) > _CACHE:
            cache.clear()
        for w in [w for w in set(words) if w not in cache]:
            start = b"^" + w[:START].encode()
            cache[w] = (1 + crc32(w.encode()) % (BUCKETS - 1), 1 + crc32(start) % (BUCKETS - 1))
        parts.append(np.array([cache[w] for w in words], np.int32).reshape(-1, 2))
    return np.concatenate(parts) if parts else np.zeros((0, 2), np.int32)


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in a row, each with padding behind that ends every window; their starts; where a window may begin."""
    gap = np.zeros((max(WIDTHS) - 1, 2), np.int32)
    empty = np.zeros((1, 2), np.int32)
    rows = [part for t in texts for part in (t if len(t) else empty, gap)]
    sizes = np.array([max(1, len(t)) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes + len(gap))])[:-1]
    begins = np.ones(int((sizes + len(gap)).sum()), bool)
    for i in range(len(gap)):
        begins[starts + sizes + i] = False
    return np.concatenate(rows), starts, begins


def responses(parts: list[np.ndarray], begins: np.ndarray) -> np.ndarray:
    """Filter responses by place: part j of a filter meets the word j places further on."""
    total = parts[0].copy()
    for j, part in enumerate(parts[1:], 1):
        total[:-j] += part[j:]
    total[~begins] = -np.inf
    return total


@dataclass
class Network:
    """``tables[w][j]``: bucket by filter, the response to a word at place j of a filter w words wide."""

    tables: list[list[np.ndarray]]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    cuts: dict[str, float] = field(default_factory=dict)

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """The greatest response of each filter in each text."""
        words, starts, begins = laid_out(texts)
        best = []
        for tables in self.tables:
            parts = [t[words[:, 0]] + t[words[:, 1]] for t in tables]
            best.append(np.maximum.reduceat(responses(parts, begins), starts, axis=0))
        return np.maximum(0, np.concatenate(best, axis=1) + self.bias)

    def raw(self, texts: list[np.ndarray]) -> np.ndarray:
        """Uncalibrated scores. Texts are taken together up to a number of words; a longer one is cut
        into overlapping parts, whose greatest responses are the text's."""
        pools = np.full((len(texts), len(self.bias)), 0, np.float32)
        run: list[np.ndarray] = []
        owner: list[int] = []
        held = 0

        def flush() -> None:
            if run:
                np.maximum.at(pools, owner, self.pooled(run))
                run.clear()
                owner.clear()

        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text)), _PART):
                part = text[at : at + _PART + max(WIDTHS) - 1]
                if held + len(part) > _PART:
                    flush()
                    held = 0
                run.append(part)
                owner.append(i)
                held += len(part)
        flush()
        return 1 / (1 + np.exp(-np.clip(pools @ self.out + self.out_bias, -30, 30).astype(float)))

    def calibrated(self, raw: np.ndarray, languages: list[str], threshold: float) -> np.ndarray:
        """Scores in which the cut of each language lies at ``threshold``."""
        cut = np.array([self.cuts.get(x, self.cuts.get("", 0.5)) for x in languages])
        return np.where(raw < cut, threshold * raw / cut, threshold + (1 - threshold) * (raw - cut) / (1 - cut))


def held_buckets(texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """How many texts of each class hold each bucket."""
    held = np.zeros((2, BUCKETS))
    for words, label in zip(texts, y, strict=True):
        held[int(label), np.unique(words)] += 1
    return held


def log_odds(held: np.ndarray, sizes: np.ndarray, share: float) -> np.ndarray:
    """Of each bucket, by the texts that hold it, given the texts of each class; 0 for those of fewer than three texts."""
    rates = (held + 0.5 * np.array([[1 - share], [share]])) / (sizes[:, None] + 1)
    return np.clip(np.log(rates[1] / rates[0]), -3, 3) / 3 * (held.sum(0) > 2)


def _share(sizes: np.ndarray) -> float:
    return float(np.clip(sizes[1] / sizes.sum() if sizes.sum() else 0.5, 1e-3, 1 - 1e-3))


@dataclass
class Fit:
    """Weights with Adam's moments and steps."""

    state: dict[str, np.ndarray]
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    step: float = 0

    @staticmethod
    def begun(held: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> Fit:
        """The first embedding axis starts at the log odds of the bucket in the training texts."""
        share = _share(sizes)
        embedding = (rng.normal(size=(BUCKETS, SIZE)) * 0.05).astype(np.float32)
        if sizes.sum():
            embedding[:, 0] = log_odds(held, sizes, share)
        embedding[0] = 0
        n_out = FILTERS * len(WIDTHS)
        state = {
            "embedding": embedding,
            "bias": np.zeros(n_out, np.float32),
            "out": (rng.random(n_out) * 0.3).astype(np.float32),
            "out_bias": np.array([np.log(share / (1 - share))], np.float32),
        }
        for w, width in enumerate(WIDTHS):
            state[f"filter{w}"] = (rng.normal(size=(width, SIZE, FILTERS)) * 0.3).astype(np.float32)
            state[f"filter{w}"][0, 0] = np.abs(state[f"filter{w}"][0, 0]) + 0.5
        return Fit(state, {k: np.zeros_like(v) for k, v in state.items()}, {k: np.zeros_like(v) for k, v in state.items()})

    def rows(self) -> np.ndarray:
        """All numbers in rows, ``SIZE`` weights beside their moments; the embedding comes first."""
        sides = []
        for part in (self.state, self.first, self.second):
            flat = [np.pad(v.ravel(), (0, -v.size % SIZE)) for v in part.values()]
            sides.append(np.concatenate(flat).reshape(-1, SIZE))
        return np.concatenate(sides, axis=1)

    def of_rows(self, rows: np.ndarray, step: float) -> Fit:
        """A fit of this one's shapes from such rows."""
        parts = []
        for side in range(3):
            flat, at, part = np.ascontiguousarray(rows[:, side * SIZE : (side + 1) * SIZE], np.float32).ravel(), 0, {}
            for k, v in self.state.items():
                part[k] = flat[at : at + v.size].reshape(v.shape).copy()
                at += v.size + -v.size % SIZE
            parts.append(part)
        return Fit(*parts, step)

    def network(self) -> Network:
        state = self.state
        tables = [[state["embedding"] @ state[f"filter{w}"][j] for j in range(width)] for w, width in enumerate(WIDTHS)]
        return Network(tables, state["bias"], state["out"], float(state["out_bias"][0]))


def fit_round(
    fit: Fit, texts: list[np.ndarray], y: np.ndarray, share: float, rng: np.random.Generator, batch: int = 48, rate: float = 0.01
) -> None:
    """One pass over the texts by Adam on the log loss; the gradient reaches the places where a filter was greatest.

    ``share``: that of the positive texts among those of all shards.
    """
    state, first, second, step = fit.state, fit.first, fit.second, fit.step
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    order = rng.permutation(len(y))
    for at in range(0, len(order), batch):
        chosen = order[at : at + batch]
        words, starts, begins = laid_out([texts[i] for i in chosen])
        vectors = state["embedding"][words[:, 0]] + state["embedding"][words[:, 1]]
        grads = {k: np.zeros_like(v) for k, v in state.items() if k != "embedding"}
        tops, hidden = [], []
        for w, width in enumerate(WIDTHS):
            response = responses([vectors @ state[f"filter{w}"][j] for j in range(width)], begins)
            best = np.maximum.reduceat(response, starts, axis=0)
            owner = np.repeat(np.arange(len(starts)), np.diff([*starts, len(words)]))
            top = np.zeros((len(starts), FILTERS), int)
            for f in range(FILTERS):
                at_best = np.flatnonzero(response[:, f] == best[owner, f])[::-1]
                top[owner[at_best], f] = at_best
            tops.append(top)
            hidden.append(best)
        before = np.concatenate(hidden, axis=1) + state["bias"]
        after = np.maximum(0, before)
        p = 1 / (1 + np.exp(-np.clip(after @ state["out"] + state["out_bias"][0], -30, 30)))
        slope = (weight[chosen] * (p - y[chosen])).astype(np.float32)
        grads["out"] += slope @ after
        grads["out_bias"] += slope.sum()
        back = slope[:, None] * state["out"] * (before > 0)
        grads["bias"] += back.sum(0)
        touched, slopes = [], []
        for w, top in enumerate(tops):
            part = back[:, w * FILTERS : (w + 1) * FILTERS]
            for j in range(WIDTHS[w]):
                place = top + j  # document by filter
                grads[f"filter{w}"][j] += np.einsum("dfs,df->sf", vectors[place], part)
                pull = (part[:, :, None] * state[f"filter{w}"][j].T[None]).reshape(-1, SIZE)
                for column in (0, 1):
                    touched.append(words[place, column].ravel())
                    slopes.append(pull)
        step += 1
        rows, place = np.unique(np.concatenate(touched), return_inverse=True)
        summed = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(summed, place, np.concatenate(slopes))
        summed[rows == 0] = 0
        for k, g in [*grads.items(), ("embedding", summed)]:
            here = rows if k == "embedding" else slice(None)
            g = g / len(chosen) + 1e-4 * state[k][here]
            first[k][here] = 0.9 * first[k][here] + 0.1 * g
            second[k][here] = 0.99 * second[k][here] + 0.01 * g * g
            scale = np.sqrt(second[k][here] / (1 - 0.99**step)) + 1e-6
            state[k][here] -= rate * (first[k][here] / (1 - 0.9**step)) / scale
    fit.step = step


def fit_network(texts: list[np.ndarray], y: np.ndarray, rounds: int = ROUNDS) -> Network:
    """The network of texts that are at hand."""
    rng = np.random.default_rng(7)
    sizes = np.array([(y == 0).sum(), (y == 1).sum()], float)
    fit = Fit.begun(held_buckets(texts, y), sizes, rng)
    for _ in range(rounds if len(y) else 0):
        fit_round(fit, texts, y, _share(sizes), rng)
    return fit.network()


def _texts(batch: pa.RecordBatch | pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """Words and classes of stored training rows."""
    words = [np.frombuffer(w, np.int16).reshape(-1, 2).astype(np.int32) for w in batch.column("words").to_pylist()]
    return words, np.array(batch.column("y").to_pylist(), float)


def _fitter(shared: Broadcast, turn: int, share: float) -> Callable[[pa.Table], pa.Table]:
    """One round over a shard: what it adds to the rows of the weights that it changes, times its texts."""

    def fitted(part: pa.Table) -> pa.Table:
        begun, shard = shared.value, part.column("shard")[0].as_py()
        # in an order that does not depend on the shuffle
        part = part.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("words", "ascending")])
        before = begun.rows()
        fit = begun.of_rows(before, begun.step)
        texts, y = _texts(part)
        fit_round(fit, texts, y, share, np.random.default_rng([7, turn, shard]))
        moved = fit.rows() - before
        slots = np.flatnonzero(moved.any(axis=1) | (np.arange(len(moved)) >= BUCKETS))
        weight = float(len(y))
        values = pa.FixedSizeListArray.from_arrays(pa.array((moved[slots] * weight).astype(np.float64).ravel()), 3 * SIZE).cast(pa.list_(pa.float64()))
        steps = pa.array(np.full(len(slots), (fit.step - begun.step) * weight))
        return pa.table([pa.array(slots, pa.int32()), pa.array(np.full(len(slots), weight)), steps, values], names=["slot", "weight", "steps", "moved"])

    return fitted


def fit_shards(rows: DataFrame, shard_rows: int = SHARD) -> Network:
    """The network of all ``rows`` (doc_id, y, words), fitted in shards of about ``shard_rows``.

    A round's result is the mean of the shards' weights, by their texts; that of a bucket is taken over the shards that hold it. The driver
    gets the mean only, whose size does not depend on the rows.
    """
    spark = rows.sparkSession
    total, *by_class = rows.agg(F.count("*"), F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    sizes = np.array(by_class, float)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sum((held_buckets(*_texts(b)) for b in batches), np.zeros((2, BUCKETS)))
        y, bucket = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(bucket, pa.int32()), pa.array(held[y, bucket])], ["y", "bucket", "n"])

    held = np.zeros((2, BUCKETS))
    for r in rows.mapInArrow(counted, "y int, bucket int, n double").groupBy("y", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        held[r.y, r.bucket] = r.n
    fit = Fit.begun(held, sizes, np.random.default_rng(7))
    shards = max(1, -(-total // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "words"), F.lit(shards)).cast("int"))
    share, width = _share(sizes), 3 * SIZE
    for turn in range((ROUNDS if shards == 1 else SHARED_ROUNDS) if total else 0):
        shared = spark.sparkContext.broadcast(fit)
        moves = dealt.groupBy("shard").applyInArrow(_fitter(shared, turn, share), "slot int, weight double, steps double, moved array<double>")
        sums = [F.sum(F.get("moved", F.lit(i))).alias(f"m{i}") for i in range(width)]
        found = moves.groupBy("slot").agg(F.sum("weight").alias("weight"), F.sum("steps").alias("steps"), *sums).toPandas()
        numbers = fit.rows().astype(float)
        weight = found.weight.to_numpy()
        numbers[found.slot.to_numpy()] += found[[f"m{i}" for i in range(width)]].to_numpy() / weight[:, None]
        # slots behind the embedding are in every shard
        last = found.slot.to_numpy().argmax()
        fit = fit.of_rows(numbers, fit.step + found.steps.to_numpy()[last] / weight[last])
        shared.unpersist()
    return fit.network()


def best_cut(low: np.ndarray, high: np.ndarray, n: np.ndarray, hits: np.ndarray, least: int = 10) -> float | None:
    """The raw score with the best F1, midway between neighbours; none with fewer than ``least`` positives or negatives.

    Of each bin, from the greatest scores down: its least and greatest score, its rows and the positive ones.
    """
    if hits.sum() < least or (n - hits).sum() < least:
        return None
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    k = int(f1.argmax())
    below = high[k + 1] if k + 1 < len(n) else 0.0
    return float(np.clip((low[k] + below) / 2, 0.02, 0.98))


def calibrate(network: Network, documents: DataFrame, known: DataFrame, languages: language_id.Languages) -> None:
    """Cuts from all ``documents`` (doc_id, text) with a row in ``known`` (doc_id, y): their scores are counted by language and bin,
    and only counts reach the driver. The scores go to the labels, not the texts."""
    shared = documents.sparkSession.sparkContext.broadcast((network, languages))
    cache: dict[str, tuple[int, int]] = {}

    def scored(batch: pa.RecordBatch) -> list:
        net, langs = shared.value
        texts = texts_of(batch)
        return [net.raw([hashed_words(t, cache) for t in texts]), langs.predict(texts)[0]]

    raw = _of_known(add_columns(documents, "raw double, language string", scored, drop=("text",)), known)
    bins = raw.groupBy("language", F.floor(F.col("raw") * BINS).alias("bin"))
    counted = bins.agg(F.min("raw").alias("low"), F.max("raw").alias("high"), F.count("*").alias("n"), F.sum("y").alias("hits")).toPandas()

    def cut(some) -> float | None:
        together = some.groupby("bin").agg({"low": "min", "high": "max", "n": "sum", "hits": "sum"}).sort_index(ascending=False)
        return best_cut(*[together[c].to_numpy(float) for c in ("low", "high", "n", "hits")])

    network.cuts = {"": cut(counted) or 0.5}
    for language, own in counted.groupby("language"):
        found = cut(own)
        if found is not None:
            network.cuts[language] = found


def _of_known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with the labels of their ids. Both grow with the data, so both are shuffled by id, whatever their size."""
    return rows.join(known.hint("merge"), "doc_id")


def train(documents: DataFrame, labels: DataFrame, languages: language_id.Languages, shard_rows: int = SHARD) -> Network:
    """The network, from all labelled rows outside of the held-out ones.

    Three quarters fit the weights, the rest gives the cut of each language. No labels: a network
    that gives 0.5 to everything.
    """
    known = labels.where("toxic IS NOT NULL").where(remainder("doc_id", FOLDS) != HELD_OUT)
    known = known.select("doc_id", (F.col("toxic") == 1).cast("int").alias("y"))
    # only rows that a label may have go to the join
    rows = documents.select("doc_id", "text").where(remainder("doc_id", FOLDS) != HELD_OUT)
    part = F.crc32(F.concat(F.lit("fit"), F.col("doc_id").cast("string"))) % 4
    cache: dict[str, tuple[int, int]] = {}

    def read(batch: pa.RecordBatch) -> list:
        words = [hashed_words(t, cache) for t in texts_of(batch)]
        return [[w.astype(np.int16).tobytes() if len(w) <= SHARD_WORDS else None for w in words]]

    # copies of a row fit no weights a second time; they are told apart where the join left them
    fitting = add_columns(rows.where(part > 0), "words binary", read, drop=("text",)).where("words IS NOT NULL")
    fitting = fold(_of_known(fitting, known.where(part > 0)).distinct(), "training-words")
    network = fit_shards(fitting, shard_rows)
    calibrate(network, rows.where(part == 0), known.where(part == 0), languages)
    return network


def score(documents: DataFrame, network: Network, languages: language_id.Languages, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with score and predicted, which replace input columns of these names.

    Only the text is read. Null and empty texts count as padding alone and get a score as any
    other. Equal texts get equal scores; empty tables stay empty.
    """
    shared = documents.sparkSession.sparkContext.broadcast((network, languages))
    cache: dict[str, tuple[int, int]] = {}

    def columns(batch: pa.RecordBatch) -> list:
        net, langs = shared.value
        texts = texts_of(batch)
        raw = net.raw([hashed_words(t, cache) for t in texts])
        found = net.calibrated(raw, langs.predict(texts)[0], threshold)
        return [found, (found >= threshold).astype(np.int32)]

    return add_columns(documents, "score double, predicted int", columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    languages = language_id.train(documents)
    documents = documents.select("doc_id", "text")
    network = train(documents, table(spark, sf_dir, "labels"), languages)
    # a null id is in no fold
    held_out = F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return score(documents, network, languages).select("doc_id", held_out.alias("held_out"), "score", "predicted")
