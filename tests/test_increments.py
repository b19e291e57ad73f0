"""Merges, watermarks, versioned tables, numbering and streams."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions.columns import parse_date
from dealtide.functions.types import wider
from dealtide.operators import increments, merge
from dealtide.operators.numbering import number_rows
from dealtide.scratch import scratch_root
from dealtide.sources.tables import Load, Mark, Table, greatest, write_apart
from dealtide.sinks.files import write_parquet
from dealtide.streaming.available_now import append_stream, file_stream, merge_stream, newest_stream


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string, n int")


def test_merge_inserts_and_overwrites(spark):
    target = kv(spark, (1, "a", 0), (2, "c", 0))
    incoming = kv(spark, (1, "n", 1), (9, "n", 1))
    once = merge.merge_rows(target, incoming, ["k"])
    assert bag(once) == [(1, "n", 1), (2, "c", 0), (9, "n", 1)]
    assert bag(merge.merge_rows(once, incoming, ["k"])) == bag(once)


def test_merge_takes_the_newest_of_several(spark):
    incoming = kv(spark, (1, "x", 2), (1, "y", 3), (1, "z", None))
    assert bag(merge.merge_rows(kv(spark, (1, "a", 9)), incoming, ["k"], ["n"])) == [(1, "y", 3)]


def test_rows_without_key_are_kept(spark):
    merged = merge.merge_rows(kv(spark, (None, "t", 0)), kv(spark, (None, "a", 1), (None, "b", 1)), ["k"])
    assert bag(merged) == [(None, "a", 1), (None, "b", 1), (None, "t", 0)]


def test_updates_are_not_multiplied(spark):
    target = kv(spark, (1, "a", 0), (1, "b", 0))
    incoming = kv(spark, (1, "n", 1), (2, "n", 1))
    assert bag(merge.updating_rows(target, incoming, ["k"])) == [(1, "n", 1)]
    assert bag(merge.new_rows(target, incoming, ["k"])) == [(2, "n", 1)]


def test_merge_against_a_dictionary(spark):
    draw = random.Random(4)
    old = {k: f"o{k}" for k in draw.sample(range(200), 120)}
    new = [(draw.randrange(250), f"n{i}", i) for i in range(300)]
    hot = [(7, f"h{i}", 1000 + i) for i in range(150)]
    merged = merge.merge_rows(kv(spark, *[(k, v, 0) for k, v in old.items()]), kv(spark, *new, *hot), ["k"], ["n"])
    state = {k: (v, 0) for k, v in old.items()} | {k: (v, n) for k, v, n in [*new, *hot]}
    assert {r.k: (r.v, r.n) for r in merged.collect()} == state and merged.count() == len(state)


def test_partition_merge_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "p int, k int, v string").write.partitionBy("p").parquet(path)
    untouched = {f.name for f in (tmp_path / "t" / "p=2").glob("*.parquet")}
    incoming = spark.createDataFrame([(1, 2, "B"), (3, 1, "d")], "p int, k int, v string")
    for _ in range(2):
        merge.merge_partitions(spark.read.parquet(path), path, incoming, ["p", "k"], ["p"])
    assert bag(spark.read.parquet(path).select("p", "k", "v")) == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c"), (3, 1, "d")]
    assert {f.name for f in (tmp_path / "t" / "p=2").glob("*.parquet")} == untouched
    with pytest.raises(ValueError, match="part of the key"):
        merge.merge_partitions(spark.read.parquet(path), path, incoming, ["k"], ["p"])


def test_interrupted_partition_merge_is_finished(spark, tmp_path, monkeypatch):
    whole, torn = str(tmp_path / "whole"), str(tmp_path / "torn")
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "p int, k int, v string")
    rows.write.partitionBy("p").parquet(whole)
    incoming = spark.createDataFrame([(1, 1, "A")], "p int, k int, v string")

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(merge, "_put_in_place", stop)
        merge.merge_partitions(spark.read.parquet(whole), whole, incoming, ["p", "k"], ["p"])
    # the same state with the partition already deleted
    rows.where("p <> 1").write.partitionBy("p").parquet(torn)
    spark.read.parquet(f"{whole}/_merges").write.parquet(f"{torn}/_merges")
    for path in (whole, torn):
        merge.merge_partitions(spark.read.parquet(path), path, incoming, ["p", "k"], ["p"])
        assert bag(spark.read.parquet(path).select("p", "k", "v")) == [(1, 1, "A"), (1, 2, "b"), (2, 1, "c")]


def test_empty_replacement_empties_the_table(spark, tmp_path):
    rows = spark.createDataFrame([("01", 1)], "p string, n int")
    for partition_by in ((), ("p",)):
        table = Table(spark, str(tmp_path / f"t{len(partition_by)}"))
        table.append(rows, partition_by=partition_by)
        assert table.read().select("p").first().p == "01"
        assert table.replace(rows.where("n > 1"), partition_by=partition_by) == Load(0, True)
        assert table.version() == 2 and table.read().select("p", "n").collect() == []
        assert not table.append(rows.where("n > 1")).committed


def test_reading_needs_only_the_commits_since_the_last_replacement(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1,)], "n int")
    for _ in range(3):
        table.append(rows)
    table.replace(rows)
    table.append(rows)
    assert [c.version for c in table.commits(after=3)] == [4, 5] and table.read().count() == 2
    assert table.appended_since(4).count() == 1 and table.appended_since(3) is None


def test_watermark_is_compared_as_a_date(spark):
    df = spark.createDataFrame([("9/9/2016",), ("10/1/2016",)], "d string").select(parse_date(F.col("d")).alias("d"))
    assert bag(increments.increment(df, "d", "2016-09-09")) == [(date(2016, 10, 1),)]
    assert increments.increment(df, "d", None).count() == 2
    assert increments.increment(df, "d", "2016-10-01").count() == 0
    assert increments.increment(df, "d", "2016-10-01", lookback_days=40).count() == 2
    assert bag(increments.watermark_row(df, "t", "d")) == [("t", "d", "2016-10-01")]
    assert increments.watermark_row(df.where("d IS NULL"), "t", "d").count() == 0


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id").write.parquet(path)
    plan = increments.increment(spark.read.parquet(path), "d", "2020-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(d,2020-01-05)" in plan


def test_watermark_table(spark):
    shape = "table_name string, column_name string, max_value string"
    current = spark.createDataFrame([("a", "c", "1"), ("b", "c", "1")], shape)
    updates = spark.createDataFrame([("a", "c", "2"), ("n", "c", "5"), ("b", "c", None)], shape)
    assert bag(increments.upsert_watermarks(current, updates)) == [("a", "c", "2"), ("b", "c", "1"), ("n", "c", "5")]


def test_table_versions(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert not table.exists() and table.mark("n") is None
    with pytest.raises(ValueError, match="no table"):
        table.read()
    first = kv(spark, (1, "a", 5), (2, "b", 7))
    load = table.append(first, load_id="one", mark=greatest(first, "n"))
    assert (load.rows, load.committed, table.mark("n")) == (2, True, "7")
    assert not table.append(first, load_id="one").committed
    empty = increments.increment(first, "n", "7")
    load = table.append(empty, mark=greatest(empty, "n", "7"))
    assert (load.rows, load.committed, table.mark("n"), table.version()) == (0, False, "7", 1)
    late = kv(spark, (3, "c", 6))
    table.append(late, mark=greatest(late, "n", "7"))
    assert table.mark("n") == "7" and table.read().count() == 3
    assert bag(table.appended_since(1)) == [(3, "c", 6)] and table.appended_since(2) is None
    table.replace(table.read().where("k > 1"))
    assert bag(table.read()) == [(2, "b", 7), (3, "c", 6)] and table.appended_since(1) is None
    table.merge(kv(spark, (2, "B", 8), (2, "x", 1)), ["k"], ["n"], mark=Mark("n", value="8"))
    assert bag(table.read()) == [(2, "B", 8), (3, "c", 6)] and table.mark("n") == "8"
    assert not table.merge(table.read().limit(0), ["k"]).committed


def test_numbers_equal_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 613).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b"))
    for order in (["a", "b"], [F.desc("a"), F.col("b")]):
        wanted = df.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("no"), "a", "b")
        assert bag(number_rows(df, "no", order, rows_unique=True)) == bag(wanted)
        assert bag(number_rows(df, "no", order)) == bag(wanted)


def test_copies_spread_over_partitions(spark):
    df = spark.range(40000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    numbered = number_rows(df.repartition(8), "no", ["a"])
    assert sorted(r.no for r in numbered.select("no").collect()) == list(range(1, 40001))
    hot = numbered.where("a = 'hot'").agg(F.min("no"), F.max("no"), F.count("no")).first()
    assert hot[1] - hot[0] + 1 == hot[2] == 13334


@pytest.mark.parametrize("copies", [1, 2, 7, 1000])
def test_rows_with_many_copies_are_numbered_as_one_first(spark, copies):
    df = spark.range(3000).select((F.col("id") % 50 % 17).alias("a"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 4).alias("b c"))
    wanted = df.select(F.row_number().over(Window.orderBy("a", "`b c`")).cast("bigint").alias("no"), "a", "b c")
    expected = bag(wanted.withColumn("no", F.col("no") + 10))
    assert bag(number_rows(df.repartition(5), "no", ["a"], after=10, copies=copies)) == expected


def test_no_single_task_for_all_rows(spark):
    df = spark.range(100).withColumn("v", F.col("id"))
    numbered = number_rows(df, "no", ["v"], rows_unique=True)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    single = plan.index("SinglePartition")
    # the one exchange to a single task sits above the per-partition sizes
    assert plan.count("SinglePartition") == 1 and "Aggregate(keys=[_part" in plan[single:]


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    assert scratch_root(Session(spark__checkpoint__dir="hdfs://x/ck/", spark__master="yarn")) == "hdfs://x/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session(spark__master="yarn"))


def test_stream_takes_new_files_only(spark, tmp_path):
    folder, schema = tmp_path / "in", "k int, v string, n int"
    table, copies = Table(spark, str(tmp_path / "t")), Table(spark, str(tmp_path / "all"))

    def run():
        stream = file_stream(spark, str(folder), spark.createDataFrame([], schema).schema, max_bytes_per_batch=1 << 30)
        merge_stream(stream, table, ["k"], ["n"], str(tmp_path / "ck1"))
        append_stream(stream, copies, str(tmp_path / "ck2"))

    kv(spark, (1, "a", 5), (2, "b", 5)).write.mode("append").parquet(str(folder))
    run()
    assert bag(table.read()) == [(1, "a", 5), (2, "b", 5)]
    kv(spark, (1, "late", 4), (2, "new", 6), (3, "c", 1)).write.mode("append").parquet(str(folder))
    run()
    run()
    assert bag(table.read()) == [(1, "a", 5), (2, "new", 6), (3, "c", 1)]
    assert copies.read().count() == 5 and table.version() == 2


def test_late_rows_reach_silver_once(spark, tmp_path):
    from dealtide.plans.loads import Lake
    from dealtide.sources.catalog import SALES, SOURCES

    dates, lake = SOURCES["dates"], Lake(spark, str(tmp_path / "lake"))
    head = "full_date,date_id,day,month,year,quarter\n"
    exports = ["2017-01-01,a,1,1,2017,1\n2017-02-01,b,1,2,2017,1\n", "2017-01-20,c,20,1,2017,1\n2017-02-03,d,3,2,2017,1\n"]
    for n, rows in enumerate(exports):
        path = tmp_path / f"export{n}.csv"
        path.write_text(head + rows)
        lake.ingest(dates, str(path), lookback_days=30 * n)
        for _ in range(2):
            lake.refine(dates)
    assert sorted(r.date_id for r in lake.table(dates.silver_table).read().collect()) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="no key"):
        lake.ingest(SALES, str(path), lookback_days=30)


def test_a_table_takes_columns_that_come_go_and_widen(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, "a")], "k int, v string"))
    table.append(spark.createDataFrame([(2**40, 1.5)], "k bigint, w double"))
    table.append(spark.createDataFrame([(3, "c", 7)], "k smallint, v string, w int"))
    table.append(spark.createDataFrame([], "k int, only_here date"), even_empty=True)
    assert bag(table.read().select("k", "v", "w", "only_here")) == bag(
        spark.createDataFrame([(1, "a", None, None), (2**40, None, 1.5, None), (3, "c", 7.0, None)], "k bigint, v string, w double, only_here date")
    )
    version = table.version()
    for wrong in ("k string", "v int", "w bigint", "k double", "w timestamp"):
        with pytest.raises(ValueError, match="does not go with"):
            table.append(spark.createDataFrame([(None,)], wrong))
    assert table.version() == version
    table.replace(spark.createDataFrame([("new",)], "k string"))
    assert bag(table.read()) == [("new",)]
    empty = Table(spark, str(tmp_path / "empty"))
    empty.replace(spark.createDataFrame([], "k int"))
    assert empty.read().columns == ["k"] and empty.read().collect() == []


def test_types_that_hold_the_values_of_two():
    def of(a, b):
        found = wider(T._parse_datatype_string(a), T._parse_datatype_string(b))
        assert found == wider(T._parse_datatype_string(b), T._parse_datatype_string(a))
        return found and found.simpleString()

    assert of("int", "bigint") == "bigint" and of("smallint", "tinyint") == "smallint" and of("int", "double") == "double"
    assert of("decimal(5,2)", "decimal(4,3)") == "decimal(6,3)" and of("int", "decimal(3,1)") == "decimal(11,1)"
    assert of("float", "double") == "double" and of("void", "date") == "date" and of("array<int>", "array<int>") == "array<int>"
    assert of("bigint", "double") is None and of("string", "int") is None and of("decimal(38,0)", "decimal(5,2)") is None


def test_one_write_for_two_tables(spark, tmp_path):
    sound, other = Table(spark, str(tmp_path / "a")), Table(spark, str(tmp_path / "b"))
    rows = spark.range(10).select("id", (F.col("id") * 2).alias("v"), F.when(F.col("id") > 7, "big").alias("why"))

    def run(load_id, rows, modes=("append", "append")):
        return write_apart(sound, other, rows, F.col("why").isNotNull(), ["id", "v"], ["id", "why"], modes, load_id, Mark("id", metric=F.max("id").cast("string").alias("mark")))

    done = run("1", rows)
    assert [d.rows for d in done] == [8, 2] and sound.mark("id") == "9"
    assert bag(other.read()) == [(8, "big"), (9, "big")] and sound.read().columns == ["id", "v"]
    assert not run("1", rows)[0].committed and sound.read().count() == 8
    # a run that stopped between the two commits
    other.append(spark.createDataFrame([(99, "late")], "id long, why string"), load_id="2")
    assert [d.committed for d in run("2", rows)] == [True, False]
    assert sound.read().count() == 16 and other.read().count() == 3
    run("3", rows.where("id < 3"), ("replace", "replace"))
    assert sound.read().count() == 3 and other.read().collect() == []


def test_merge_rewrites_only_the_buckets_it_meets(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    first = spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).alias("n"))
    table.merge(first.unionByName(spark.createDataFrame([(None, "loose", 0)], "k long, v string, n int")), ["k"], ["n"], buckets=8)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("v1-*/*/*.parquet")}
    change = spark.createDataFrame([(5, "new", 1), (5, "newer", 2), (999, "more", 1)], "k long, v string, n int")
    met = {r[0] for r in change.select(merge.bucket_of(["k"], 8)).distinct().collect()}
    done = table.merge(change, ["k"], ["n"], load_id="a", buckets=8)
    assert done.committed and not table.merge(change, ["k"], ["n"], load_id="a", buckets=8).committed
    written = {f.parent.name for f in (tmp_path / "t").glob("v2-*/*/*.parquet")}
    assert written == {f"_bucket={b}" for b in met} and len(met) < 3
    assert {f: f.stat().st_mtime_ns for f in files} == files
    # untouched buckets are read where they were, met ones only where they are now
    scanned = "".join(table.read().inputFiles())
    assert all((f"v1-" in p) != (p.split("_bucket=")[1].split("/")[0] in map(str, met)) for p in table.read().inputFiles()) and "v2-" in scanned
    wanted = {k: ("old", 0) for k in range(200)} | {5: ("newer", 2), 999: ("more", 1), None: ("loose", 0)}
    assert {r.k: (r.v, r.n) for r in table.read().collect()} == wanted and table.read().count() == len(wanted)
    assert table.appended_since(1) is None

    # competing rows, a wider key, another number of buckets, rows added without buckets
    table.merge(spark.createDataFrame([(5, "late", 1), (6, "late", 1)], change.schema), ["k"], ["n"], buckets=8, competing=True)
    wanted |= {6: ("late", 1)}
    assert {r.k: (r.v, r.n) for r in table.read().collect()} == wanted
    table.merge(spark.createDataFrame([(7, "int", 3)], "k int, v string, n int"), ["k"], ["n"], buckets=8)
    table.merge(spark.createDataFrame([(8, "x", 3)], change.schema), ["k"], ["n"], buckets=3)
    table.append(spark.createDataFrame([(1000, "added", 0)], change.schema))
    table.merge(spark.createDataFrame([(1000, "y", 3)], change.schema), ["k"], ["n"], buckets=3)
    wanted |= {7: ("int", 3), 8: ("x", 3), 1000: ("y", 3)}
    assert {r.k: (r.v, r.n) for r in table.read().collect()} == wanted and table.read().count() == len(wanted)
    with pytest.raises(ValueError, match="does not go with"):
        table.merge(spark.createDataFrame([(1, 2)], "k long, v int"), ["k"], buckets=3)
    assert not table.merge(change.limit(0), ["k"], buckets=3).committed


def test_few_keys_are_looked_up_by_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select((F.col("id") * 2).alias("k"), F.col("id").cast("string").alias("v"))
    write_parquet(rows.repartition(3), path, sort_by=["k"])
    target = spark.read.parquet(path)
    incoming = spark.createDataFrame([(4, "a"), (5, "b"), (None, "c")], "k long, v string")
    assert bag(merge.new_rows(target, incoming, ["k"])) == [(5, "b"), (None, "c")]
    found = merge.updating_rows(target, incoming, ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert bag(found) == [(4, "a")]
    assert "PushedFilters: [In(k, [4,5])" in plan and "Aggregate" not in plan
    many = spark.range(3000).select("id", F.lit("x").alias("v")).withColumnRenamed("id", "k")
    found = merge.new_rows(target, many, ["k"])
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 1500


def test_late_files_do_not_undo_newer_rows(spark, tmp_path):
    shape = T._parse_datatype_string("k int, v string, n int")
    for name, run in (("a", merge_stream), ("b", newest_stream)):
        folder, table = str(tmp_path / f"{name}-in"), Table(spark, str(tmp_path / name))
        for part in ([(1, "new", 5), (2, "x", 1)], [(1, "late", 3), (3, "y", 1)], [(1, "newest", 6)]):
            spark.createDataFrame(part, shape).write.mode("append").parquet(folder)
            run(file_stream(spark, folder, shape), table, ["k"], ["n"], str(tmp_path / f"{name}-done"), buckets=2)
        assert bag(table.read()) == [(1, "newest", 6), (2, "x", 1), (3, "y", 1)]
