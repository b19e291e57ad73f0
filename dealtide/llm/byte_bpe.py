"""Byte-level BPE over a global shuffle of distinct words, and its decoding.

Texts are split into pre-tokens ("words") in blocks of neighbouring rows. A block has the
position list of each text as numbers of its distinct words, and sends each distinct word
once to the task that owns the word's bucket. There each distinct word is encoded once, and
its ids go to all blocks that asked, where they meet the positions and are put in the places of their
words. Words and positions travel packed and compressed, many to a row: one row per occurrence
would be many times the input. The positions do not travel with the words, so a very
frequent word is one entry per block, not a hot key.

Decoding looks the bytes of each id up in the vocabulary, which is a fixed table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dealtide.llm.common import WordTable, add_columns, gather, ragged, small_batches, table

# Bytes of text in a block, at least.
BLOCK = 16 << 20
# Encoded words that a task remembers at most, for words that come from several blocks.
_CACHE = 500_000
_SLICE = 1 << 20
_SPLIT = regex.compile(public_tokenizers.PATTERN)
_BEFORE_SPACE = regex.compile(r"\s ")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token bytes in a row; by id the start and size of its bytes."""
    tokens = sorted(vocabulary(path).items(), key=lambda x: x[1])
    at = np.array([i for _, i in tokens])
    size, start = np.zeros(at[-1] + 1, np.int64), np.zeros(at[-1] + 1, np.int64)
    size[at] = [len(t) for t, _ in tokens]
    start[at] = np.cumsum(size[at]) - size[at]
    return np.frombuffer(b"".join(t for t, _ in tokens), np.uint8), start, size


def chunks(text: str) -> Iterator[list[str]]:
    """The text in parts that begin before a space behind a non-space; no pre-token crosses such a place.

    The first part of the first list is as it stands, all others lack their leading space.
    """
    at = 0
    while at < len(text) or at == 0:
        end = text.find(" ", at + _SLICE)
        while end > 0 and text[end - 1].isspace():
            end = text.find(" ", end + 1)
        part = text[at:] if end < 0 else text[at:end]
        found = part.split(" ")
        if _BEFORE_SPACE.search(part) or part[:1] == " " and at == 0:
            joined = [found[0]]
            for x in found[1:]:
                if joined[-1] == "" and len(joined) > 1 or joined[-1][-1:].isspace() or joined == [""] and at == 0:
                    joined[-1] += " " + x
                else:
                    joined.append(x)
            found = joined
        yield found if at == 0 else found[1:]
        if end < 0:
            return
        at = end


def words_behind_space(chunk: str) -> list[str]:
    """Pre-tokens of a space and a chunk."""
    if chunk.isalpha():
        return [" " + chunk]
    if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
        return [" " + chunk[:-1], chunk[-1]]
    return _SPLIT.findall(" " + chunk)


class Block:
    """Distinct words of neighbouring texts, numbered as they come."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.spaced = WordTable(lambda found: ragged([self.number(words_behind_space(c)) for c in found]), 1 << 62)

    def number(self, words: list[str]) -> list[int]:
        return [self.words.setdefault(w, len(self.words)) for w in words]

    def places(self, text: str) -> np.ndarray:
        parts = []
        for n, part in enumerate(chunks(text)):
            if n == 0:
                parts.append(np.array(self.number(_SPLIT.findall(part[0])), np.uint32))
                part = part[1:]
            parts.append(self.spaced.ids(part))
        return np.concatenate(parts).astype(np.uint32)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned 32-bit numbers, by byte planes, compressed."""
    planes = [a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(np.array([len(a) for a in arrays], "<u4").tobytes() + b"".join(planes))


def unpacked(data: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = raw[: 4 * count].view("<u4").astype(int)
    out, at = [], 4 * count
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at : at + 4 * n].reshape(4, n).T).view("<u4").ravel())
        at += 4 * n
    return out


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block, list[pa.RecordBatch], list[np.ndarray]]]:
    """(number, words, rows, places of each row) of each block."""
    base = None
    block, rows, places, size = Block(), [], [], 0
    for batch in batches:
        if base is None:
            base = batch.column("_part")[0].as_py() << 32
        rows.append(batch)
        for text in batch.column("_text").to_pylist():
            places.append(block.places(text or ""))
            size += len(text or "")
        if size >= BLOCK:
            yield base, block, rows, places
            base += 1
            block, rows, places, size = Block(), [], [], 0
    if rows:
        yield base, block, rows, places


def encode(documents: DataFrame, ranks: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ids (array<int>) of every row, as the ranks encode its whole text without special tokens.

    A null or empty text has no ids. Repeated rows and null keys stay rows of their own; other
    columns are ignored; an empty table gives no rows. Very long texts are read whole. Texts are read and split once: one shuffle takes
    the words to their buckets and the positions to their block, where the ids join them.
    """
    spark = documents.sparkSession
    small_batches(spark)
    own = [f"_{i}" for i, _ in enumerate(keep)]
    source = documents.select(*[F.col(k).alias(o) for k, o in zip(keep, own, strict=True)], F.col("text").alias("_text"))
    # the number of the scan's own partition; a task's number differs below a union
    source = source.withColumn("_part", F.spark_partition_id())
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own_shape = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema if f.name in own)
    sent_shape = T._parse_datatype_string(f"{own_shape}target long, block long, head int, body binary")
    out_shape = T._parse_datatype_string(f"{own_shape}ids array<int>")
    sent_arrow, out_arrow = to_arrow_schema(sent_shape), to_arrow_schema(out_shape)

    def asked(number: int, block: Block) -> pa.RecordBatch:
        """The words of a block, a row for each bucket; buckets are targets below zero."""
        found = [w.encode("utf-8", "surrogatepass") for w in block.words]
        owner = np.fromiter((crc32(w) % buckets for w in found), np.int64, len(found))
        order = np.argsort(owner, kind="stable")
        edges = np.searchsorted(owner[order], np.arange(buckets + 1))
        target, head, body = [], [], []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            places = order[edges[b] : edges[b + 1]]
            mine = [found[i] for i in places]
            steps = packed(np.diff(places, prepend=0), np.array([len(w) for w in mine]))
            target.append(-1 - b)
            head.append(len(steps))
            body.append(steps + zstandard.ZstdCompressor(level=3).compress(b"".join(mine)))
        columns = [*([None] * len(target) for _ in own), target, [number] * len(target), head, body]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, sent_arrow, strict=True)], schema=sent_arrow)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, rows, found in blocks(batches):
            yield asked(number, block)
            at = 0
            for batch in rows:
                n = batch.num_rows
                body = [packed(p) for p in found[at : at + n]]
                at += n
                columns = [*(batch.column(o) for o in own), [number] * n, [number] * n, [None] * n, body]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, sent_arrow, strict=True)], names=sent_arrow.names)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks)
        known = WordTable(lambda new: ragged(coder.encode_ordinary_batch([w.decode("utf-8", "replace") for w in new], num_threads=1)), _CACHE)
        for batch in batches:
            batch = batch.select(["target", "block", "head", "body"]).filter(pc.less(batch.column("target"), 0))
            out = []
            for head, body in zip(batch.column("head").to_pylist(), batch.column("body").to_pylist(), strict=True):
                steps, sizes = unpacked(body[:head], 2)
                text = zstandard.ZstdDecompressor().decompress(body[head:])
                ends = np.cumsum(sizes).tolist()
                found = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                flat, counts = known.ids_by_word(found)
                out.append(packed(steps, counts, flat))
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["target", "answer"])

    def put(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """The ids of the texts of a block. Groups of words, which are targets below zero, have no texts."""
        texts = texts.filter(pc.greater_equal(texts.column("target"), 0))
        got = [unpacked(body, 3) for body in answers.column("answer").to_pylist()]
        at = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(steps, dtype=np.int64) for steps, _, _ in got)])
        sent = np.concatenate([np.zeros(0, np.int64), *(sizes for _, sizes, _ in got)]).astype(np.int64)
        values = np.concatenate([np.zeros(0, np.uint32), *(flat for _, _, flat in got)])
        size, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        size[at], start[at] = sent, np.cumsum(sent) - sent
        found = [np.zeros(0, np.int32)]
        for body in texts.column("body").to_pylist():
            place = unpacked(body, 1)[0]
            found.append(gather(values, start[place], size[place]).astype(np.int32))
        edges = pa.array(np.cumsum([len(f) for f in found]), pa.int32())
        lists = pa.ListArray.from_arrays(edges, pa.array(np.concatenate(found)))
        return pa.Table.from_arrays([*(texts.column(o) for o in own), lists], names=out_arrow.names)

    # both readers below take the whole of this shuffle, so Spark runs it once
    sent = source.mapInArrow(split, sent_shape).repartition(buckets, "target")
    answers = sent.mapInArrow(ids, "target long, answer binary")
    joined = sent.groupBy("target").cogroup(answers.groupBy("target")).applyInArrow(put, out_shape)
    return joined.select(*[F.col(o).alias(k) for k, o in zip(keep, own, strict=True)], "ids")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of the tokens of ``ids`` in a row. No ids: no bytes; null: null."""

    def columns(batch: pa.RecordBatch) -> list:
        flat, start, size = token_bytes(ranks)
        ids = batch.column("ids")
        edges = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False)
        valid = ids.is_valid().to_pylist()
        return [[gather(flat, start[p], size[p]).tobytes() if ok else None for ok, p in zip(valid, (values[a:b] for a, b in zip(edges, edges[1:], strict=False)), strict=True)]]

    return add_columns(encoded, "decoded binary", columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = decode(encode(table(spark, sf_dir, "documents"), ranks), ranks)
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
