"""Loading the lake: raw files to bronze, bronze to silver, silver to gold.

Each step is one write. Row counts and the new watermark are observed by that write
and stored with its commit; the run log follows. An interrupted step leaves no trace in
the tables and can simply be run again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import partial as partial_of
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from dealtide.functions.columns import named, parse_date
from dealtide.operators.increments import increment
from dealtide.operators.merge import new_rows
from dealtide.operators.quality import broken_rules, failure_counts, listed, report
from dealtide.operators.runlog import RunLog, increment_note
from dealtide.operators.transforms import apply_transforms
from dealtide.plans import dashboard, marts, star
from dealtide.scratch import CODEC, scratch_path
from dealtide.sources.catalog import SALES, SOURCES, Source
from dealtide.sources.files import REASON, RECORD, TEXT_FORMATS, read_source, register_views
from dealtide.sources.tables import Load, Mark, Table, greatest, write_apart

# Typed value that orders the increments; kept next to the raw columns.
ORDER = "_increment"
# Under this name a gold table remembers the silver version it was built from.
BUILT_FROM = "silver_version"
# Under this name the fact remembers that version, the last id and the last date.
NUMBERED = "numbering"
# Beside an aggregate table lies its state, under this ending; under this name it remembers what it takes in.
STATE, TAKEN_IN = "_state", "taken_in"
# The load id of pairs behind distinct counts is this and the silver version they come from.
CONSUMED_SILVER = "silver-"
# A silver commit's load id is this and the bronze version that it consumed.
CONSUMED = "bronze-"
# Ending of the tables that hold the rows which silver's rules reject.
REJECTED = "_rejected"
FAILED_RULES = "failed_rules"
# Ending of the tables that hold the records of bronze's files that do not fit the declared columns.
BROKEN = "_broken"

# Leads are known by name, segment and region: by name alone, one that moves would repeat.
LEAD_KEY = "triple"

# Gold tables built from the flat sales table, besides the aggregates.
DIMENSIONS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "gold_dim_salesperson": star.dim_salesperson,
    "gold_dim_lead": partial_of(star.dim_lead, key_by=LEAD_KEY),
    "gold_dim_date": star.dim_date,
    "gold_dim_opportunity_stage": star.dim_stage,
}
FACT = "gold_fact_sales"
NORMALIZED_SUMMARY = "gold_sales_summary"
NORMALIZED_SILVER = ("silver_sales_opportunities", "silver_salespeople", "silver_leads", "silver_dates")


def ordering_value(source: Source) -> Column:
    """The watermark column in the type it has once cleaned, so that it orders by time."""
    for step in source.transforms:
        if step["type"] == "date_conversion" and step["column"] == source.watermark:
            formats = step.get("from_format", "M/d/yyyy")
            return parse_date(F.trim(named(source.watermark)), [formats] if isinstance(formats, str) else formats)
    return named(source.watermark)


def consumed(silver: Table) -> int | None:
    """The bronze version that a silver table was last built from."""
    found = silver.newest_load(CONSUMED)
    return int(found.split("-")[1]) if found else None


class Lake:
    """Tables and run log below one shared folder.

    Silver tables with a key lie in ``buckets`` of it: choose so many that one is a task's share of the largest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16) -> None:
        self.spark = spark
        self.buckets = buckets
        self.path = path.rstrip("/")
        self.log = RunLog(spark, f"{self.path}/run_log")

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.path}/{name}")

    def read(self, *names: str) -> list[DataFrame]:
        return [self.table(n).read() for n in names]

    def register(self, *names: str) -> None:
        """Make tables addressable by name in SQL."""
        register_views(dict(zip(names, self.read(*names))))

    def watermarks(self, *names: str) -> DataFrame:
        """The newest stored progress of each table and column."""
        logs = [self.table(n).log().withColumn("table_name", F.lit(n)) for n in names if self.table(n).exists()]
        if not logs:
            raise ValueError("none of these tables exists")
        return (
            reduce(DataFrame.unionByName, logs)
            .where("max_value IS NOT NULL")
            .groupBy("table_name", "column_name")
            .agg(F.max_by("max_value", "version").alias("max_value"), F.max("committed_at").alias("last_updated"))
        )

    def _logged(
        self, name: str, origin: str, target: str, partial: bool, work: Callable[[], Load],
        note: Callable[[], str | None] = lambda: None, kind: str | None = None, if_empty: str | None = None,
    ) -> Load:
        run = self.log.start(name, origin, target, kind or ("incremental" if partial else "full"))
        try:
            load = work()
        except Exception as error:
            self.log.fail(run, str(error))
            raise
        if if_empty and not load.rows:
            self.log.empty(run, if_empty)
        else:
            self.log.complete(run, load.rows, note())
        return load

    def ingest(self, source: Source, path: str, incremental: bool = True, lookback_days: int = 0) -> Load:
        """Raw files to bronze: append what is past the watermark, or replace in full.

        Rows whose watermark value cannot be read enter with a full load only, since
        nothing tells whether an increment has seen them before; the run's note says how many there were. If a full load, or the first one,
        finds no rows, the table stays as it is and the run is logged as one of an empty source.

        Records of csv and json files that do not fit the declared columns are not taken for rows with nulls: they go to the table of broken
        records, as they stand in the file and with the reason, and the note counts them. An increment takes those past the watermark, and those
        whose watermark value cannot be read, unless a record of the same text is stored already.
        """
        if lookback_days and not source.key:
            raise ValueError(f"{source.name} has no key, so rows that a look-back reads again could not be told apart")
        partial = source.incremental(incremental)
        table, aside = self.table(source.bronze_table), self.table(source.bronze_table + BROKEN)
        last = table.mark(source.watermark) if partial else None
        text = source.format in TEXT_FORMATS
        counts: dict[str, int] = {}

        def work() -> Load:
            rows = read_source(self.spark, source.format, path, source.columns, **({"broken": True} if text else {}))
            mark, unread = None, Observation()
            if source.watermark:
                rows = rows.withColumn(ORDER, ordering_value(source))
                if last is not None and text:
                    rows = rows.observe(unread, F.count_if(F.col(ORDER).isNull() & F.col(RECORD).isNull()).alias("unreadable"))
                loose = F.col(RECORD).isNotNull() & F.col(ORDER).isNull() if text else F.lit(False)
                rows = increment(rows, ORDER, last, lookback_days, also=loose)
                mark = greatest(rows, ORDER, last, stored_as=source.watermark)
            mode = "append" if partial else "replace"
            if not text:
                return (table.append if partial else table.replace)(rows, mark=mark, even_empty=False)
            if mark:
                sound = F.when(F.col(RECORD).isNull(), F.col(ORDER))
                kind = rows.schema[ORDER].dataType.simpleString()
                reached = F.greatest(F.max(sound), F.lit(last).cast(kind)).cast("string")
                mark = Mark(mark.column, metric=reached.alias("mark"))
            columns = [c for c in rows.columns if c not in (RECORD, REASON)]
            beside = [RECORD, REASON, *([ORDER] if source.watermark else [])]

            def unknown(broken: DataFrame) -> DataFrame:
                """Without the records that are stored already: the watermark does not pass broken ones."""
                return broken.join(aside.read().select(RECORD).distinct(), RECORD, "left_anti").select(*broken.columns)

            sift = unknown if source.watermark and last is not None and aside.exists() else None
            done, broken = write_apart(
                table, aside, rows, F.col(RECORD).isNotNull(), columns, beside, (mode, mode), mark=mark, sift=sift
            )
            counts["broken_records"] = broken.rows
            if source.watermark and last is not None:
                counts["unreadable"] = unread.get["unreadable"]
            return done

        if_empty = f"no rows in {path}; {source.bronze_table} keeps its content" if last is None else None
        return self._logged(
            source.bronze_table, path, source.bronze_table, partial, work,
            lambda: increment_note(source.watermark or "", last, last is not None, **counts), if_empty=if_empty,
        )

    def refine(self, source: Source, incremental: bool = True) -> tuple[Load, DataFrame]:
        """Bronze to silver; also gives the quality report of the rows just read.

        An increment is what bronze committed since silver was last built, so late rows that a
        look-back admitted reach silver. It is merged where the source has a key and appended
        where it has none. If bronze was replaced meanwhile, all of it is read.
        Without ``incremental`` the table is replaced.

        Rows that break a rule go to the table of rejected rows, with the rules they break. The rows kept, those rejected and the counts of the report come
        from one pass over bronze.
        """
        partial = source.incremental(incremental)
        table, bronze = self.table(source.silver_table), self.table(source.bronze_table)
        last = table.mark(source.watermark) if partial else None
        version = bronze.version()
        seen = consumed(table) if partial else None
        if seen == version:
            raw = bronze.read().where("false")
        else:
            # what bronze committed since, also rows dated before silver's watermark
            raw = bronze.appended_since(seen) if seen is not None else None
            partial = partial and (raw is not None or seen is None)
            raw = bronze.read() if raw is None else raw
        load_id = f"{CONSUMED}{version}" if partial else f"{CONSUMED}{version}-{uuid4().hex}"
        merged = bool(incremental and source.key)
        changed = apply_transforms(raw, source.transforms)
        modes = ("append" if partial else "replace", "append" if partial and seen is not None else "replace")
        counted: dict[str, object] = {}

        def marked(rows: DataFrame, of: Column) -> Mark | None:
            if not source.watermark:
                return None
            reached = F.greatest(F.max(of), F.lit(last).cast(rows.schema[ORDER].dataType)).cast("string")
            return Mark(source.watermark, metric=reached.alias("mark"))

        def work() -> Load:
            if not source.rules:
                if merged:
                    newest = [ORDER] if source.watermark else []
                    return table.merge(changed, [source.key], newest, load_id, marked(changed, F.col(ORDER)) if source.watermark else None, self.buckets)
                return (table.append if partial else table.replace)(changed, load_id, mark=marked(changed, F.col(ORDER)) if source.watermark else None, even_empty=True)
            flagged = changed.withColumn(FAILED_RULES, broken_rules(source.rules))
            away, aside = F.size(FAILED_RULES) > 0, self.table(source.silver_table + REJECTED)
            sound = F.when(~away, F.col(ORDER)) if source.watermark else F.lit(None)
            if not merged:
                done, _ = write_apart(
                    table, aside, flagged, away, changed.columns, flagged.columns, modes, load_id,
                    marked(changed, sound), even_empty=True, observe=failure_counts(source.rules),
                )
                counted.update({k: v for k, v in done.metrics.items() if k.startswith("rule_")})
                return done
            if table._done(load_id):
                return Load(0, False)
            # one pass as well; rows that stay are then merged by key, the few others stored
            seen_rules = Observation()
            path = scratch_path(self.spark, "refined")
            flagged.observe(seen_rules, *failure_counts(source.rules)).withColumn("_away", away).write.partitionBy("_away").parquet(path, compression=CODEC)
            counted.update(seen_rules.get)
            staged = self.spark.read.schema(flagged.schema.add("_away", "boolean")).parquet(path)
            (aside.append if modes[1] == "append" else aside.replace)(staged.where("_away").drop("_away"), load_id)
            rows = staged.where("NOT _away").drop("_away", FAILED_RULES)
            mark = marked(rows, F.col(ORDER)) if source.watermark else None
            return table.merge(rows, [source.key], [ORDER] if source.watermark else [], load_id, mark, self.buckets)

        kind = "merge" if merged and not partial else None
        load = self._logged(
            source.name, source.bronze_table, source.silver_table, partial, work,
            lambda: increment_note(source.watermark or "", last, last is not None), kind,
        )
        if source.rules and not counted:
            return load, report(changed, source.rules)  # nothing was written, so nothing counted
        row = [F.lit(n).cast("bigint").alias(name) for name, n in counted.items()]
        return load, listed(self.spark.range(1, numPartitions=1).select(*row), source.rules)

    def _gold(self, name: str, build: Callable[[DataFrame], DataFrame], sales: Table) -> Load:
        version = str(sales.version())

        def work() -> Load:
            return self.table(name).replace(build(sales.read()), mark=Mark(BUILT_FROM, value=version))

        return self._logged(name, SALES.silver_table, name, False, work)

    def _grown(self, table: Table, sales: Table, incremental: bool) -> tuple[DataFrame | None, bool]:
        """The sales that silver got since a gold table was built, if it only grew; and whether there is nothing to do."""
        seen = table.mark(BUILT_FROM) if incremental else None
        if seen is None:
            return None, False
        return sales.appended_since(int(seen)), int(seen) == sales.version()

    def build_dimension(self, name: str, incremental: bool = True) -> Load:
        """A dimension: the members that only new sales have are added if silver only grew since, else in full."""
        sales, table, build = self.table(SALES.silver_table), self.table(name), DIMENSIONS[name]
        changed, current = self._grown(table, sales, incremental)
        if current:
            return Load(0, False)
        if changed is None:
            return self._gold(name, build, sales)
        key, version = table.read().columns[0], str(sales.version())

        def work() -> Load:
            fresh = new_rows(table.read(), build(changed), [key])
            return table.append(fresh, mark=Mark(BUILT_FROM, value=version), even_empty=True)

        return self._logged(name, SALES.silver_table, name, True, work)

    def build_fact(self, incremental: bool = True) -> Load:
        """The fact: if silver only grew since, and only by later dates, the new sales are numbered by themselves and added.

        Its commits say which silver version they take in, the last id and the last date. In all other cases it is built anew.
        """
        sales, table = self.table(SALES.silver_table), self.table(FACT)
        stored = table.mark(NUMBERED) if incremental else None
        state = json.loads(stored) if stored else {}
        version = sales.version()
        if state.get("silver") == version:
            return Load(0, False)
        changed = sales.appended_since(state["silver"]) if state else None

        def dates(rows: DataFrame) -> Row:
            return star.numbered_facts(rows).agg(F.min("sale_date").cast("string"), F.max("sale_date").cast("string")).first()

        first, last = dates(changed) if changed is not None else (None, None)
        grows = changed is not None and (first is None or state["until"] is None or first > state["until"])
        if not grows:
            last = dates(sales.read())[1]

        def work() -> Load:
            rows, after = (changed, state["last_id"]) if grows else (sales.read(), 0)
            fact = star.fact_sales(rows, key_by=LEAD_KEY, after=after)
            reached = F.coalesce(F.max("sales_id"), F.lit(after))
            until = F.lit(last or state.get("until")).cast("string")
            numbered = F.to_json(F.struct(F.lit(version).alias("silver"), reached.alias("last_id"), until.alias("until")), {"ignoreNullFields": "false"})
            write = table.append if grows else table.replace
            return write(fact, mark=Mark(NUMBERED, metric=numbered.alias("mark")), even_empty=True)

        return self._logged(FACT, SALES.silver_table, FACT, grows, work)

    def build_star(self, incremental: bool = True) -> dict[str, Load]:
        """The dimensions and the fact."""
        built = {name: self.build_dimension(name, incremental) for name in DIMENSIONS}
        built[FACT] = self.build_fact(incremental)
        return built

    def _keep_pairs(self, mart: marts.Mart, changed: DataFrame | None, version: int) -> None:
        """The pairs behind a mart's distinct counts, those of new sales added; all of them anew without ``changed``."""
        for column in mart.distinct:
            table = self.table(f"{mart.name}_{column}")
            if changed is None:
                found = mart.pairs(self.table(SALES.silver_table).read(), column)
                table.replace(found, f"{CONSUMED_SILVER}{version}-{uuid4().hex}")
            else:
                fresh = mart.new_pairs(table.read(), changed, column)
                table.append(fresh, f"{CONSUMED_SILVER}{version}", even_empty=True)

    def build_mart(self, mart: marts.Mart, incremental: bool = True) -> Load:
        """An aggregate table, from its stored state.

        If silver only grew since, the state of the new sales is merged with the stored one, and the sales before are not
        read; else all is built anew. Exact distinct counts have their pairs stored beside: those that
        an increment adds are counted. The state says which versions of silver and of the pairs it takes in, so
        a run repeated after a failure goes on where that one stopped.
        """
        sales, table, states = self.table(SALES.silver_table), self.table(mart.name), self.table(mart.name + STATE)
        stored = states.mark(TAKEN_IN) if incremental else None
        taken = json.loads(stored) if stored else {}
        version = sales.version()
        if taken.get("silver") == version and table.mark(BUILT_FROM) == str(version):
            return Load(0, False)
        changed = sales.appended_since(taken["silver"]) if taken else None
        if any(self.table(f"{mart.name}_{c}").replaced_since(v) for c, v in taken.get("pairs", {}).items()):
            changed = None  # a build of all pairs was interrupted

        def pairs(column: str) -> DataFrame:
            """All pairs, or those that the state has not taken in."""
            kept = self.table(f"{mart.name}_{column}")
            return kept.read() if changed is None else kept.appended_since(taken["pairs"][column])

        def work() -> Load:
            if taken.get("silver") != version:
                self._keep_pairs(mart, changed, version)
                state = mart.partial(sales.read() if changed is None else changed)
                state = mart.with_counts(state, {c: pairs(c) for c in mart.distinct})
                if changed is not None:
                    state = mart.merged(states.read(), state)
                reached = {"silver": version, "pairs": {c: self.table(f"{mart.name}_{c}").version() for c in mart.distinct}}
                states.replace(state, mark=Mark(TAKEN_IN, value=json.dumps(reached)))
            return table.replace(mart.with_ids(mart.finished(states.read())), mark=Mark(BUILT_FROM, value=str(version)))

        return self._logged(mart.name, SALES.silver_table, mart.name, changed is not None, work)

    def build_marts(self, incremental: bool = True) -> dict[str, Load]:
        return {m.name: self.build_mart(m, incremental) for m in marts.SALES_MARTS}

    def build_normalized_summary(self) -> Load:
        """The summary over the four related silver tables."""
        parts = NORMALIZED_SILVER

        def work() -> Load:
            return self.table(NORMALIZED_SUMMARY).replace(marts.summary_of_normalized(*self.read(*parts)))

        return self._logged(NORMALIZED_SUMMARY, ", ".join(parts), NORMALIZED_SUMMARY, False, work)

    def load(self, paths: Mapping[str, str], incremental: bool = True) -> dict[str, Load]:
        """Sources by name through bronze and silver, then the gold tables they feed."""
        done: dict[str, Load] = {}
        for name, path in paths.items():
            done[SOURCES[name].bronze_table] = self.ingest(SOURCES[name], path, incremental)
            done[SOURCES[name].silver_table] = self.refine(SOURCES[name], incremental)[0]
        if SALES.name in paths:
            done |= self.build_star(incremental) | self.build_marts(incremental)
        if all(self.table(t).exists() for t in NORMALIZED_SILVER):
            done[NORMALIZED_SUMMARY] = self.build_normalized_summary()
        return done

    def reports(self, as_of: str | None = None) -> dict[str, DataFrame]:
        """All report tables by name, ready for a CSV export."""
        # Names and row limits of the exported reports.
        fact, dates = self.read(FACT, "gold_dim_date")
        performance, regions, funnel, trends, scoring = self.read(
            marts.PERFORMANCE.name,
            marts.REGION_SUMMARY.name,
            marts.FUNNEL.name,
            marts.TRENDS.name,
            marts.LEAD_SCORING.name,
        )
        return {
            "sales_performance_summary": dashboard.kpi_summary(fact, dates),
            "top_performers": dashboard.top_performers(performance, limit=50),
            "regional_performance": dashboard.regional_performance(regions),
            "opportunity_funnel": dashboard.funnel_by_stage(funnel),
            "monthly_trends": dashboard.trend_rollup(trends, as_of),
            "lead_insights": dashboard.lead_insights(scoring),
            "segment_analysis": dashboard.segment_analysis(regions),
        }
