"""Types, transforms, quality rules and file sources on literal rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions.types import struct_type
from dealtide.operators import quality
from dealtide.operators.transforms import apply_transforms
from dealtide.plans.silver import to_silver
from dealtide.sinks.files import export_reports, write_parquet
from dealtide.sources import catalog
from dealtide.sources.files import REASON, RECORD, read_csv, read_source, register_views


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_type_names():
    schema = struct_type({"a": "Int64", "b": "TEXT", "c": "decimal", "d": "numeric(10, 4)", "e": "float", "f": "bool"})
    assert [f.dataType for f in schema] == [
        T.LongType(), T.StringType(), T.DecimalType(18, 2), T.DecimalType(10, 4), T.DoubleType(), T.BooleanType(),
    ]
    assert all(f.nullable for f in schema)
    with pytest.raises(ValueError, match="unknown column type"):
        struct_type({"a": "blob"})


def test_clean_trims_the_ends_only(spark):
    df = spark.createDataFrame([("  Ann  B ",), (None,)], "`Lead Name` string")
    assert rows(apply_transforms(df, [{"type": "clean_column", "column": "Lead Name"}])) == [("Ann  B",), (None,)]


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("12.5", "1/5/2017"), ("zz", "13/45/2017"), (None, "2017-01-05")], "n string, d string")
    steps = [
        {"type": "type_conversion", "column": "n", "to_type": "double"},
        {"type": "date_conversion", "column": "d", "from_format": "M/d/yyyy", "to_format": "yyyy-MM-dd"},
    ]
    assert rows(apply_transforms(df, steps)) == [(12.5, date(2017, 1, 5)), (None, None), (None, None)]


def test_steps_build_on_each_other(spark):
    df = spark.createDataFrame([(" 7 ", 1)], "a string, b int")
    steps = [
        {"type": "clean_column", "column": "A"},
        {"type": "rename_column", "from": "a", "to": "c"},
        {"type": "type_conversion", "column": "c", "to_type": "int"},
        {"type": "rename_column", "from": "absent", "to": "x"},
        {"type": "drop_column", "column": "b"},
        {"type": "drop_column", "column": "absent"},
    ]
    out = apply_transforms(df, steps)
    assert out.columns == ["c"] and rows(out) == [(7,)]
    with pytest.raises(ValueError, match="unknown transform"):
        apply_transforms(df, [{"type": "explode"}])
    with pytest.raises(ValueError, match="no column"):
        apply_transforms(df, [{"type": "clean_column", "column": "absent"}])


def test_nulls_in_rules(spark):
    df = spark.createDataFrame([(5,), (-1,), (None,)], "v int")
    at_least = [{"column": "v", "rule_type": "greater_than_equal", "value": 0}]
    assert sorted(rows(quality.kept(df, at_least)), key=str) == [(5,), (None,)]
    assert rows(quality.kept(df, [{"column": "v", "rule_type": "greater_than", "value": 4}])) == [(5,), (None,)]
    text = spark.createDataFrame([("ab1",), ("x",), (None,)], "t string")
    assert rows(quality.kept(text, [{"column": "t", "rule_type": "regex", "pattern": "[0-9]"}])) == [("ab1",)]


def test_counts_follow_the_rule_order(spark):
    df = spark.createDataFrame([(None, None), (None, -1), (1, -1), (1, 5), (1, None)], "a int, b int")
    rules = [
        {"column": "a", "rule_type": "not_null"},
        {"column": "b", "rule_type": "greater_than_equal", "value": 0},
        {"column": "a", "rule_type": "greater_than", "value": 0},
    ]
    report = [(r.rule_no, r.message, r.failed_count) for r in quality.report(df, rules).collect()]
    assert report == [
        (1, "Column 'a' contains 2 NULL values", 2),
        (2, "Column 'b' contains 1 values less than 0", 1),
    ]
    broken = {(r.a, r.b): r.failed_rules for r in quality.quarantine(df, rules).collect()}
    assert broken == {
        (None, None): ["not_null(a)"],
        (None, -1): ["not_null(a)", "greater_than_equal(b)"],
        (1, -1): ["greater_than_equal(b)"],
    }
    assert quality.kept(df, rules).count() + len(broken) == df.count()
    assert quality.report(df, []).count() == 0 and quality.quarantine(df, []).count() == 0


@pytest.mark.parametrize(
    "rule",
    [
        {"column": "a", "rule_type": "between"},
        {"column": "a", "rule_type": "regex"},
        {"column": "a", "rule_type": "greater_than"},
        {"column": "a", "rule_type": "date_format"},
    ],
)
def test_incomplete_rules_are_errors(rule):
    with pytest.raises(ValueError):
        quality.Rule.of(rule)


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "dates.csv"
    path.write_text('day,n,note,at\n1/5/2017,7,"a, b",1/5/2017 10:00:00\n2017-01-06,zz,,\nnever,8,x,2017-01-06 11:00:00\n')
    df = read_csv(spark, str(path), {"day": "date", "n": "int", "note": "string", "at": "timestamp"})
    assert rows(df) == [
        (date(2017, 1, 5), 7, "a, b", datetime(2017, 1, 5, 10)),
        (date(2017, 1, 6), None, None, None),
        (None, 8, "x", datetime(2017, 1, 6, 11)),
    ]


def test_csv_inference_and_line_breaks(spark, tmp_path):
    path = tmp_path / "free.csv"
    path.write_text('n,ok,text\n1,true,"two\nlines"\n2,false,one\n')
    df = read_csv(spark, str(path), multi_line=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "boolean", "string"]
    assert rows(df) == [(1, True, "two\nlines"), (2, False, "one")]


def test_unsupported_format(spark):
    with pytest.raises(ValueError, match="unsupported source format"):
        read_source(spark, "xlsx", "x")


def test_partitioned_parquet_keeps_all_rows(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise("cold").alias("kind"))
    write_parquet(df, str(tmp_path / "t"), partition_by=["kind"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 1000 and {p.name for p in (tmp_path / "t").glob("kind=*")} == {"kind=hot", "kind=cold"}


def test_views_in_sql(spark):
    register_views({"silver_probe": spark.createDataFrame([(1,), (2,)], "a int")})
    assert rows(spark.sql("SELECT sum(a) FROM silver_probe")) == [(3,)]


def test_empty_reports_are_left_out(spark, tmp_path):
    df = spark.createDataFrame([("EU", 1)], "region string, n int")
    written = export_reports({"full": df, "empty": df.where("n > 1")}, str(tmp_path), stamp="s")
    assert list(written) == ["full"] and written["full"].endswith("full_s")
    assert rows(read_csv(spark, written["full"])) == [("EU", 1)]
    assert not (tmp_path / "empty_s").exists()


def test_sales_file_to_silver(spark):
    names = list(catalog.SALES.columns)
    raw = spark.createDataFrame(
        [
            ("1/5/2017", " Ann ", "Acme ", "Retail", "EU", "2/1/2017", Decimal("10.50"), "Lead", Decimal("1.00"), False, True, True),
            ("bad", "Bob", None, "Retail", "EU", None, None, "Lead", None, None, None, None),
        ],
        struct_type(catalog.SALES.columns),
    )
    assert raw.columns == names
    silver = to_silver(raw, catalog.SALES)
    assert rows(silver.rows) == [
        (date(2017, 1, 5), "Ann", "Acme", "Retail", "EU", date(2017, 2, 1), Decimal("10.50"), "Lead", Decimal("1.00"), False, True, True)
    ]
    assert [r.failed_rules for r in silver.rejected.collect()] == [["not_null(lead_name)"]]
    assert [(r.column_name, r.failed_count) for r in silver.report.collect()] == [("lead_name", 1)]


def test_broken_records_keep_their_text_and_a_reason(spark, tmp_path):
    columns = {"n": "int", "note": "string", "flag": "boolean", "day": "date"}
    path = tmp_path / "broken.csv"
    path.write_text('n,note,flag,day\n1,a,true,1/2/2017\nx,"a, b",true,\n2,b\n3,c,maybe,1/2/2017,more\n4,,,never\n,,,\n')
    found = read_csv(spark, str(path), columns, broken=True)
    assert [(r.n, r[RECORD], r[REASON]) for r in found.collect()] == [
        (1, None, None),
        (None, 'x,"a, b",true,', "n: x"),
        (2, "2,b", "fewer than 4 cells"),
        (3, "3,c,maybe,1/2/2017,more", "more than 4 cells; flag: maybe"),
        (4, None, None),
        (None, None, None),
    ]
    assert rows(found.select("n").where(F.col(RECORD).isNull())) == [(1,), (4,), (None,)]
    path = tmp_path / "broken.json"
    path.write_text('{"n": 1}\n{"n": "x"}\nnothing\n')
    found = read_source(spark, "json", str(path), columns, broken=True)
    assert [r[RECORD] for r in found.collect()] == [None, '{"n": "x"}', "nothing"]
    with pytest.raises(ValueError, match="declared columns"):
        read_source(spark, "parquet", str(path), columns, broken=True)
