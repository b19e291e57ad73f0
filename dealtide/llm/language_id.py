"""Language identification with string kernels.

The kernel counts the byte n-grams, of one to three bytes, that two lower-cased texts
share (presence, not frequency; n-grams are hashed), divided by the root of the product of
their own counts. A bounded sample of training texts gives landmarks; Nyström features
k(x, landmarks) K^-1/2 go into one ridge regression per language. As all of this is linear
in the presence vector, the landmark and regression matrices are multiplied once, and a
batch of texts is scored by one matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm.common import add_columns, remainder, sampled, table, texts_of

# Training texts and, among them, landmarks; of the texts only presence bits come to the driver.
SAMPLE, LANDMARKS = 3000, 192
BUCKETS = 1 << 15
# The held-out rows and the answer for texts without letters.
FOLDS, HELD_OUT, UNKNOWN = 3, 1, "und"
_SLICE = 1 << 20
_ROWS = 64


def presence(row: np.ndarray, text: bytes) -> None:
    """Set the buckets of the n-grams of a whole text. Slices overlap by two bytes."""
    for at in range(0, max(1, len(text)), _SLICE):
        b = np.frombuffer(text[at : at + _SLICE + 2], np.uint8).astype(np.uint32)
        row[_bucket(b)] = 1
        two = b[:-1] * np.uint32(257) + b[1:] + np.uint32(1 << 10)
        row[_bucket(two)] = 1
        row[_bucket(two[:-1] * np.uint32(263) + b[2:] + np.uint32(1 << 26))] = 1


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint32(2654435761)) >> np.uint32(17)


def lowered(text: bytes | None) -> bytes:
    return (text or b"").decode("utf-8", "replace").lower().encode()


@dataclass
class Languages:
    """``matrix``: bucket by language, the product of landmarks, K^-1/2 and regression weights."""

    names: list[str]
    matrix: np.ndarray

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and a score of 0 to 1 for each text, by its letters or not."""
        names, scores = [], []
        for at in range(0, len(texts), _ROWS):
            part = texts[at : at + _ROWS]
            x = np.zeros((len(part), BUCKETS), np.float32)
            for row, text in zip(x, part, strict=True):
                presence(row, lowered(text))
            if not self.names:
                names += [UNKNOWN] * len(part)
                scores += [0.0] * len(part)
                continue
            own = np.sqrt(np.maximum(1, x.sum(1)))
            margin = (x @ self.matrix) / own[:, None]
            odds = np.exp(6 * (margin - margin.max(1, keepdims=True)))
            best = odds.argmax(1)
            names += [self.names[i] for i in best]
            scores += (1 / odds.sum(1)).astype(float).tolist()
        return names, scores


def fit_languages(bits: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-3) -> Languages:
    """``bits``: a row of packed presence bits for each text. Texts are unpacked some at a time."""
    names = sorted(set(langs))
    if not names:
        return Languages([], np.zeros((BUCKETS, 0), np.float32))

    def units(rows: np.ndarray) -> np.ndarray:
        x = np.unpackbits(rows, axis=1).astype(np.float32)
        return x / np.sqrt(np.maximum(1, x.sum(1, keepdims=True)))

    marks = units(bits[:: max(1, -(-len(bits) // landmarks))])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    half = vectors / np.sqrt(np.maximum(values, 1e-4)) @ vectors.T
    near = np.concatenate([units(bits[at : at + 128]) @ marks.T for at in range(0, len(bits), 128)])
    phi = near @ half
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weights = np.linalg.solve(phi.T @ phi + ridge * len(phi) * np.eye(len(marks)), phi.T @ y)
    return Languages(names, (marks.T @ (half @ weights)).astype(np.float32))


def has_letter(column: str = "text"):
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def train(documents: DataFrame, sample: int = SAMPLE) -> Languages:
    """The model, from about ``sample`` texts with a letter and a language, outside of the held-out rows.

    The sample takes every language by its share. No such rows: a model that knows none.
    """
    known = documents.where(remainder("doc_id", FOLDS) != HELD_OUT).where("lang IS NOT NULL").select("doc_id", "lang", "text")
    chosen = sampled(known, "doc_id", sample).where(has_letter())

    def bits(batch: pa.RecordBatch) -> list:
        out = []
        for text in texts_of(batch):
            row = np.zeros(BUCKETS, np.uint8)
            presence(row, lowered(text))
            out.append(np.packbits(row).tobytes())
        return [out]

    read = add_columns(chosen, "bits binary", bits, drop=("text",))
    got = sorted((r.doc_id, r.lang, bytes(r.bits)) for r in read.collect())
    bits_of = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(-1, BUCKETS // 8)
    return fit_languages(bits_of, [r[1] for r in got])


def identify(documents: DataFrame, model: Languages) -> DataFrame:
    """``documents`` with lang_pred and score, which replace input columns of these names.

    Only the text is read. A null text, or one without a letter, is ``und`` with score 0. Repeated
    rows get equal answers; an empty table stays empty.
    """

    def columns(batch: pa.RecordBatch) -> list:
        letters = batch.column("_letters").to_pylist()
        texts = [t if ok else None for t, ok in zip(texts_of(batch), letters, strict=True)]
        names, scores = model.predict(texts)
        return [
            [n if ok else UNKNOWN for n, ok in zip(names, letters, strict=True)],
            [s if ok else 0.0 for s, ok in zip(scores, letters, strict=True)],
        ]

    flagged = documents.withColumn("_letters", has_letter())
    return add_columns(flagged, "lang_pred string, score double", columns, drop=("_letters",))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train(documents)
    # a null id is in no fold
    held_out = F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    found = identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
