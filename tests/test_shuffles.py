"""What goes through shuffles and to disk, of steps that move all rows."""

from __future__ import annotations

import contextlib
import io
from datetime import date
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from dealtide.checks import queries
from dealtide.operators import numbering
from dealtide.plans import marts
from dealtide.scratch import materialize

SALE = (
    "sale_date date, salesperson string, lead_name string, segment string, region string, target_close date, "
    "forecasted_monthly_revenue decimal(18,2), weighted_revenue decimal(18,2), opportunity_stage string, "
    "closed_opportunity boolean, active_opportunity boolean, latest_status_entry boolean"
)


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_rows_are_numbered_with_one_shuffle(spark, monkeypatch):
    seen = []
    placed = numbering._placed
    monkeypatch.setattr(numbering, "_placed", lambda ordered: seen.append(plan(ordered)) or placed(ordered))
    rows = [(i % 7, i % 3) for i in range(60)] + [(9, 9)] * 40 + [(None, 1)] * 2
    df = spark.createDataFrame(rows, "a int, b int")
    for copies, hot in ((1 << 20, False), (39, True), (1, True)):
        found = [tuple(r) for r in numbering.number_rows(df, "n", ["a"], after=5, copies=copies).orderBy("n").collect()]
        wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert found == [(6 + i, *r) for i, r in enumerate(wanted)]
        assert ("hashpartitioning" in seen[-1]) == hot


def sales(spark, days):
    rows = [
        (d, f"p{i % 2}", f"l{i}, x", "s", "r", None, Decimal(i), Decimal(1), "Lead", False, True, i % 2 == 0) for i, d in enumerate(days)
    ]
    return spark.createDataFrame(rows, SALE)


def test_two_exports_are_written_once(spark):
    early, late = date(1999, 6, 15), date(1999, 6, 16)
    for days, first in (([early, late, None, early], 2), ([late], 0), ([early], 1), ([], 0)):
        df = sales(spark, days)
        paths = queries._two_exports(df)
        read = [spark.read.option("header", True).schema(queries._raw_sales(df).schema).csv(p) for p in paths]
        assert [r.count() for r in read] == [first, len(days)]
        assert read[1].columns == queries._raw_sales(df).columns
        key = ["Date", "Lead Name", "Forecasted Monthly Revenue"]
        assert sorted(map(str, read[1].select(key).collect())) == sorted(map(str, queries._raw_sales(df).select(key).collect()))
        root = Path(paths[0]).parent
        assert not days or {f.suffix for f in root.glob("late=*/part-*") if f.stat().st_size > 300} <= {".gz"}
        assert spark.read.option("header", True).csv([str(f) for f in root.glob("late=*")]).count() == len(days)


IDS = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2 + "\n", "", "7", "é", None, "f" * 32, "f" * 31]


def test_normalized_summary_moves_opportunities_once(spark):
    # keys of all forms; people, leads and dates that come twice
    people = materialize(spark.createDataFrame([(p, f"n{i}") for i, p in enumerate(IDS + IDS[:2])], "salesperson_id string, salesperson string"), "t")
    leads = materialize(spark.createDataFrame([(p, f"r{i % 2}", "s") for i, p in enumerate(IDS + IDS[4:6])], "lead_id string, region string, segment string"), "t")
    dates = materialize(spark.createDataFrame([("a",), ("b",), ("b",)], "date_id string"), "t")
    rows = [
        (("a", "b", "c")[(i + j) % 3], p, q, Decimal(i), None if j % 4 == 0 else Decimal(j), bool(i % 2), None if j % 3 else True, None if i == j else "o")
        for i, p in enumerate(IDS)
        for j, q in enumerate(IDS)
    ]
    shape = (
        "date_id string, salesperson_id string, lead_id string, forecasted_monthly_revenue decimal(18,2), weighted_revenue decimal(18,2), "
        "closed_opportunity boolean, active_opportunity boolean, opportunity_id string"
    )
    sold = materialize(spark.createDataFrame(rows, shape), "t")
    found = marts.summary_of_normalized(sold, people, leads, dates)
    register = {"o": sold, "p": people, "l": leads, "d": dates}
    for name, df in register.items():
        df.createOrReplaceTempView(f"_sum_{name}")
    wanted = spark.sql(
        """SELECT o.salesperson_id, p.salesperson, l.region, l.segment, count(o.opportunity_id), CAST(sum(o.forecasted_monthly_revenue) AS DECIMAL(28,2)),
        CAST(sum(o.weighted_revenue) AS DECIMAL(28,2)), count_if(closed_opportunity), count_if(active_opportunity)
        FROM _sum_o o JOIN _sum_d d USING (date_id) JOIN _sum_l l ON o.lead_id = l.lead_id JOIN _sum_p p ON o.salesperson_id = p.salesperson_id
        GROUP BY ALL"""
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    # not by pairs of salesperson and lead
    assert not any("hashpartitioning(salesperson_id" in line and "lead_id" in line for line in plan(found).splitlines())
    numbers = sold.withColumn("salesperson_id", F.length("salesperson_id")).withColumn("lead_id", F.length("lead_id"))
    few = marts.summary_of_normalized(numbers, spark.createDataFrame([(32, "x")], "salesperson_id int, salesperson string"),
                                      spark.createDataFrame([(32, "r", "s")], "lead_id int, region string, segment string"), dates)
    assert [r.salesperson_id for r in few.collect()] == [32]
