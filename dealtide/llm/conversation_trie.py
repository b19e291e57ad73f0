"""Prefix trie of conversations: grouped by blocks of turns first, by single turns only where blocks diverge.

A turn is known by two 64-bit hashes of its role, text and place; a run of turns by the xor of theirs, so the name of a prefix is the
name of a shorter one xor that of the turns between. Each conversation is cut into blocks of ``block`` turns, and
conversations with the same turns up to and in a block are one group, a unit, which later steps handle as one row with a count.
Where all that follow the same prefix continue with the same unit, its turns are nodes as they stand; where
siblings diverge, the units are refined: their turns are grouped by the names of their prefixes.

A subtree's sums come without walking the tree. A node belongs to the smallest conversation in it, and a conversation owns the
nodes of its path from some depth to its end. So the sum over the distinct nodes of a subtree is the sum of what its
members own, but for the smallest one, whose path is corrected by what lies above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealtide.llm.common import dealt_join, fold, table

# Turns of a block.
BLOCK = 4
# A conversation shares up to SHARED - 1 turns with the first one of its GROUP.
GROUP, SHARED = 100, 6
# Turns of one conversation that one task orders at a time, and turns a block of running sums spans.
_STRIDE = 1024


def _hashes(*columns: Column | str) -> list[Column]:
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second name"), *columns)]


def placed(turns: DataFrame, key: str) -> DataFrame:
    """(c, place, a, b, size): the turns of each conversation in order, from 1 on, by two hashes and their code points.

    Ordered by turn, nulls first; equal turns by role, then by hash.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    a, b = _hashes(role, text)
    small = turns.select(F.col(key).cast("long").alias("c"), F.col("turn"), role.alias("role"), a.alias("a"), b.alias("b"), F.length(text).cast("long").alias("size"))
    return numbered(small.where("c IS NOT NULL"), ["turn", "role", "a", "b"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place within c, from 1 on, instead of ``order``'s first two columns.

    The whole table is sorted over all tasks and numbered by the sizes of the partitions, so that one very long
    conversation does not meet in one task.
    """
    ranged = rows.repartitionByRange("c", *[F.col(o).asc_nulls_first() for o in order])
    ranged = ranged.sortWithinPartitions("c", *[F.col(o).asc_nulls_first() for o in order])
    # the number within the task is stored, so it holds whatever happens to the task later
    stored = fold(ranged.withColumn("_task", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id()), "ordered")
    own = stored.withColumn("_n", F.col("_n").bitwiseAND(F.lit((1 << 33) - 1)))
    # one row a task
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = own.groupBy("_task").agg(F.count("*").alias("_rows")).select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    whole = own.join(F.broadcast(tasks), "_task").withColumn("_n", F.col("_first") + F.col("_n"))
    opening = whole.groupBy("c").agg(F.min("_n").alias("_open"), F.count("*").alias("_m"))
    found = dealt_join(whole, opening, ["c"], F.col("_n"), "_m", None)
    return found.withColumn("place", F.col("_n") - F.col("_open") + 1).drop("_task", "_n", "_first", "_open", "_m", *order[:2])


def rebuilt(turns: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations as in ``placed``, and all conversations (c)."""
    own = fold(placed(turns, key), "placed")
    members = own.select("c").distinct()
    shared = (F.crc32(F.col("c").cast("string")) % SHARED).alias("h")
    lent = members.select("c", shared, (F.col("c") - F.col("c") % GROUP).alias("base"))
    # of each first conversation SHARED - 1 turns at most, for GROUP conversations on either side of zero
    heads = own.where((F.col("place") < SHARED) & (F.col("c") % GROUP == 0)).withColumnRenamed("c", "base")
    head = lent.join(heads, "base").where("place <= h").select("c", "place", "a", "b", "size")
    lengths = head.groupBy("c").agg(F.count("*").alias("_lent"), F.lit(1).alias("_one"))
    # the first h turns give way, the rest follows the lent ones; at most h < SHARED are lent, so the place needs no join with a hot side
    rest = own.withColumn("h", F.crc32(F.col("c").cast("string")) % SHARED).where("place > h")
    count = rest.groupBy("c").agg(F.count("*").alias("_m"))
    lengths = count.join(lengths, "c", "left").select("c", "_m", F.coalesce("_lent", F.lit(0)).alias("_lent"))
    rest = dealt_join(rest, lengths, ["c"], F.col("place"), "_m", None)
    rest = rest.select("c", (F.col("place") - F.col("h") + F.col("_lent")).alias("place"), "a", "b", "size")
    return head.unionByName(rest), members


def blocks_of(turns: DataFrame, block: int) -> DataFrame:
    """(c, k, a, b, ua, ub, above, turns, total, length): the blocks of each conversation.

    a, b name the turns before the block, ua, ub those in it, above sums the code points before it, turns has (a, b, size)
    in order, total and length are those of the whole conversation.
    """
    a, b = _hashes("a", "b", "place")
    named = turns.select("c", "place", a.alias("a"), b.alias("b"), "size", F.floor((F.col("place") - 1) / block).alias("k"))
    # a block has ``block`` turns at most
    rows = named.groupBy("c", "k").agg(
        F.bit_xor("a").alias("ua"), F.bit_xor("b").alias("ub"), F.sum("size").alias("sum"), F.array_sort(F.collect_list(F.struct("place", "a", "b", "size"))).alias("turns")
    )
    rows = fold(rows.withColumn("stride", F.floor(F.col("k") / _STRIDE)), "blocks")
    # running names and sums in two steps, so that a very long conversation is dealt to a task for each stride
    inner = Window.partitionBy("c", "stride").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("c").orderBy("stride").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("c")
    strides = rows.groupBy("c", "stride").agg(F.bit_xor("ua").alias("xa"), F.bit_xor("ub").alias("xb"), F.sum("sum").alias("xs"), F.sum(F.size("turns")).alias("xn"))
    zero = F.lit(0).cast("long")
    strides = strides.select(
        "c",
        "stride",
        F.coalesce(F.bit_xor("xa").over(outer), zero).alias("oa"),
        F.coalesce(F.bit_xor("xb").over(outer), zero).alias("ob"),
        F.coalesce(F.sum("xs").over(outer), zero).alias("os"),
        F.sum("xs").over(every).alias("total"),
        F.sum("xn").over(every).alias("length"),
    )
    found = rows.join(strides, ["c", "stride"])
    return found.select(
        "c",
        "k",
        F.col("oa").bitwiseXOR(F.coalesce(F.bit_xor("ua").over(inner), zero)).alias("a"),
        F.col("ob").bitwiseXOR(F.coalesce(F.bit_xor("ub").over(inner), zero)).alias("b"),
        "ua",
        "ub",
        (F.col("os") + F.coalesce(F.sum("sum").over(inner), zero)).alias("above"),
        "turns",
        "total",
        "length",
    )


_UNIT = ["k", "a", "b", "ua", "ub"]


def _turn_nodes(units: DataFrame, block: int, sums: list[str]) -> DataFrame:
    """The nodes at the turns of each unit: depth, name (a, b), parent's name (pa, pb), size of the turn, code points above, and ``sums``."""
    start = F.struct(F.col("a"), F.col("b"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.lit(0).cast("long").alias("size"), F.col("above").alias("up"))

    def grown(path: Column, turn: Column) -> Column:
        last = F.element_at(path, -1)
        fresh = F.struct(
            last["a"].bitwiseXOR(turn["a"]).alias("a"),
            last["b"].bitwiseXOR(turn["b"]).alias("b"),
            last["a"].alias("pa"),
            last["b"].alias("pb"),
            turn["size"].alias("size"),
            (last["up"] + last["size"]).alias("up"),
        )
        return F.concat(path, F.array(fresh))

    path = F.slice(F.aggregate("turns", F.array(start), grown), 2, F.lit(block))
    found = units.select("k", *sums, *(["diverges"] if "diverges" in units.columns else []), F.posexplode(path).alias("j", "x"))
    return found.select((F.col("k") * block + F.col("j") + 1).alias("depth"), "x.*", *[c for c in found.columns if c not in ("k", "j", "x")])


def digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): of the conversations (depth, a, b, c) the SHA-256 of their ids by node, ascending, joined by commas.

    Ids are sorted over all tasks and joined to long texts first; a task then takes in the texts of a node in order.
    So a node with very many ends is one row for a task's batch of ids, and no task holds them all.
    """
    keys = ["depth", "a", "b"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs: list[tuple] = []
            texts: list[list[str]] = []
            for row in zip(*[batch.column(n).to_pylist() for n in (*keys, "c")], strict=True):
                if not runs or runs[-1][:3] != row[:3]:
                    runs.append(row)
                    texts.append([])
                texts[-1].append(str(row[3]))
            columns = [pa.array(c, pa.int64()) for c in (zip(*runs, strict=True) if runs else [[]] * 4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([",".join(t) for t in texts], pa.string())], names=[*keys, "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hash_ = None, hashlib.sha256()

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*keys, "ends_sha256"])

        for batch in batches:
            done = []
            for *node, ids in zip(*[batch.column(n).to_pylist() for n in (*keys, "ids")], strict=True):
                if node == now:
                    hash_.update(b",")
                else:
                    if now is not None:
                        done.append((*now, hash_.hexdigest()))
                    now, hash_ = node, hashlib.sha256()
                hash_.update(ids.encode())
            yield out(done)
        yield out([(*now, hash_.hexdigest())] if now is not None else [])

    ranged = ends.select(*keys, "c").repartitionByRange(*keys, "c").sortWithinPartitions(*keys, "c")
    texts = fold(ranged.mapInArrow(joined, "depth long, a long, b long, first long, ids string"), "ends")
    return texts.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digested, "depth long, a long, b long, ends_sha256 string")


def trie(conversations: DataFrame, key: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations, the root included.

    ``conversations`` has key, turn, role and text. Turns are ordered by turn, nulls first; equal turns by role, then by a hash. Null
    roles and texts are empty; a repeated row is a turn of its own; rows with a null key take no part. The conversation c then consists of the first h =
    crc32(c) % 6 turns of c - c % 100, where there are such, and of its own turns after its first h. A node is a distinct
    sequence of the first depth turns; columns: conv_id, the smallest member; depth; parent_conv_id, null at the root; n_convs;
    n_children; n_leaves, the childless nodes of its subtree; saved_tokens, over its subtree the sum of n_convs - 1 times the code points of
    the last text; ends_sha256, of the decimal ids of the members that end there. Texts of any length are hashed once, where they lie; other
    columns are ignored; an empty table gives no rows, not even a root. Nodes are told apart by 128 bits of hashes.
    """
    turns, members = rebuilt(conversations, key)
    members = fold(members, "members")
    parts = fold(blocks_of(turns, block), "units")
    # rows of one unit are added up before the shuffle
    weights = [F.count("*").alias("n"), F.min("c").alias("c"), F.sum("total").alias("total")]
    units = parts.groupBy(*_UNIT).agg(*weights, F.first("turns").alias("turns"), F.first("above").alias("above"))
    units = fold(units, "grouped")
    siblings = units.groupBy("k", "a", "b").agg(F.count("*").alias("m"))
    units = dealt_join(units, siblings, ["k", "a", "b"], F.xxhash64("ua", "ub"), "m", None).withColumn("diverges", F.col("m") > 1)
    units = fold(units.drop("m"), "siblings")

    node = ["depth", "a", "b"]
    each = _turn_nodes(units, block, ["n", "c", "total"])
    shape = [*node, "pa", "pb", "size", "up", "n", "c", "total"]
    alike = [F.first(x).alias(x) for x in ("pa", "pb", "size", "up")]
    refined = each.where("diverges").groupBy(*node).agg(*alike, F.sum("n").alias("n"), F.min("c").alias("c"), F.sum("total").alias("total"))
    zeros = [F.lit(0).cast("long").alias(x) for x in ("depth", "a", "b", "pa", "pb", "size", "up")]
    opening = parts.where("k = 0").select(F.lit(0).alias("n"), "c", "total")
    root = members.select(F.lit(1).alias("n"), "c", F.lit(0).alias("total")).unionByName(opening)
    root = root.agg(F.sum("n").alias("n"), F.min("c").alias("c"), F.sum("total").alias("total")).where("n > 0").select(*zeros, "n", "c", "total")
    nodes = each.where("NOT diverges").select(*shape).unionByName(refined.select(*shape)).unionByName(root.select(*shape))
    nodes = fold(nodes, "nodes")
    below = nodes.where("depth > 0")
    children = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = fold(nodes.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "children")

    # what each conversation owns, and the highest node of it
    highest = F.min(F.struct("depth", "pa", "pb")).alias("top")
    owned = nodes.groupBy("c").agg(F.sum("size").alias("own"), F.count_if(F.col("n_children") == 0).alias("leaf"), highest)
    owned = fold(owned, "owned")
    lengths = parts.groupBy("c").agg(F.count("*").alias("m"))
    gifts = owned.join(lengths, "c").select("c", "own", "leaf", "m")
    shares = dealt_join(parts.select("c", *_UNIT), gifts, ["c"], F.col("k"), "m", None)
    shares = shares.groupBy(*_UNIT).agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    each = _turn_nodes(units.join(shares, _UNIT, "left"), block, ["own", "leaf"])
    refined = each.where("diverges").groupBy(*node).agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    at_root = owned.agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf")).select(*zeros[:3], "own", "leaf")
    gathered = each.where("NOT diverges").select(*node, "own", "leaf").unionByName(refined).unionByName(at_root)

    # the parent's smallest member, of each conversation's highest node
    tops = owned.where("top.depth > 0").select("c", (F.col("top.depth") - 1).alias("depth"), F.col("top.pa").alias("a"), F.col("top.pb").alias("b"))
    parents = nodes.where("n_children > 0").select(*node, F.col("c").alias("above"), F.col("n_children").alias("m"))
    tops = dealt_join(tops, parents, node, F.xxhash64("c"), "m", None).select("c", (F.col("depth") + 1).alias("depth"), "above")

    lasts = parts.where(F.col("k") == F.floor((F.col("length") - 1) / block))
    ended = lasts.select("c", F.col("length").alias("depth"), F.col("a").bitwiseXOR(F.col("ua")).alias("a"), F.col("b").bitwiseXOR(F.col("ub")).alias("b"))
    turnless = members.join(lengths.select("c"), "c", "left_anti").select("c", *zeros[:3])
    ends = digests(ended.unionByName(turnless))

    own_total = lasts.select("c", F.col("total").alias("own_total"))
    # the smallest member has its own total and what it owns: once for each node it owns, so a long path is dealt
    held = nodes.groupBy("c").agg(F.count("*").alias("m"))
    smallest = owned.select("c", F.col("own").alias("own_c")).join(own_total, "c", "left").join(held, "c")
    whole = dealt_join(nodes, smallest, ["c"], F.col("depth"), "m", None)
    whole = whole.join(gathered, node, "left").join(tops, ["c", "depth"], "left").join(ends, node, "left")
    distinct = F.col("own") + F.coalesce("own_total", F.lit(0)) - F.col("up") - F.col("own_c")
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(
        F.col("c").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("above", "c")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaf").alias("n_leaves"),
        (F.col("total") - F.col("n") * F.col("up") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


# crc32 is worked out digit by digit; prefixes are lists of turns.
SQL = """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc(c, s, v) AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT c, s[2:], xor(crc.v >> 8, bits.v) FROM crc JOIN bits ON k = 8 AND i = xor(crc.v, ascii(s[1])) & 255 WHERE s <> ''),
convs AS (SELECT c, (xor(v, 4294967295) % 6)::BIGINT AS h, c - c % 100 AS base FROM crc WHERE s = ''),
own AS (SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS place FROM conversations),
lent AS (SELECT v.c, place, x FROM convs v JOIN own o ON o.c = v.base AND place <= h),
built AS (
  SELECT c, place, x FROM lent UNION ALL
  SELECT o.c, place - h + (SELECT count(*) FROM lent l WHERE l.c = o.c), x FROM own o JOIN convs v ON o.c = v.c AND place > h),
path AS (
  SELECT c, place AS d, list(x) OVER (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING) AS p, length(x.t) AS z, count(*) OVER (PARTITION BY c) AS n FROM built),
member AS (
  SELECT c, d, p, z, d = n AS ends FROM path UNION ALL
  SELECT c, 0, [], 0, c NOT IN (SELECT c FROM built) FROM convs),
node AS (
  SELECT d, p, min(z) AS z, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM member GROUP BY d, p),
family AS (
  SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM node w WHERE w.d = n.d + 1 AND w.p[1 : n.d] = n.p) AS n_children
  FROM node n LEFT JOIN node u ON u.d = n.d - 1 AND u.p = n.p[1 : n.d - 1]),
below AS (
  SELECT m.d, m.p, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.z) AS saved_tokens
  FROM member m JOIN family u ON u.conv_id = m.c AND u.d >= m.d GROUP BY m.d, m.p)
SELECT conv_id, f.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM family f JOIN below b ON b.d = f.d AND b.p = f.p
"""
