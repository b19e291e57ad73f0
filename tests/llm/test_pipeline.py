"""The pipeline, stage by stage, and on odd rows."""

from __future__ import annotations

import corpus_pipeline
import duckdb
from conftest import DATA
from odd_rows import none, odd, stored  # noqa: F401
from pyspark.sql import functions as F

from dealtide.llm import language_id, line_dedup, quality_rules

SF = str(DATA / "sf0.01")


def test_stages_keep_the_columns_and_clean_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 1").fetchall()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, SF)
        if name != "packing":
            assert found.columns == columns
        found.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        if name == "quality rules":
            kept = {r.doc_id for r in docs.collect()}
            present = [i for (i,) in labels]
            assert sum(i in kept for i in present) > 0.9 * len(present)
        if name == "SimHash near-dedup":
            # equal texts leave one row, the one with the smallest id
            wanted = before.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
            assert docs.join(wanted, "doc_id", "left_anti").count() == 0
    assert docs.agg(F.sum("length")).first()[0] > 0


def test_stages_on_odd_rows(spark, stored, none, tmp_path):
    for n, start in enumerate((stored.withColumn("score", F.lit("x")).withColumn("kept", F.lit("y")).withColumn("_bin", F.lit(1)), none)):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, docs, SF)
            assert name == "packing" or found.columns == start.columns
            found.write.parquet(str(tmp_path / f"{n}-{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}-{k}"))
        assert n == 0 or docs.count() == 0


def test_stages_are_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    named = language_id.identify(docs, model).where("lang_pred <> 'und' AND score >= 0.3")
    assert corpus_pipeline.known_language(spark, docs, SF).count() == named.count()
    field = quality_rules.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert corpus_pipeline.good_quality(spark, docs, SF).count() == quality_rules.judge(docs, field).where("kept").count()


def test_line_dedup_stage_is_its_operator(spark):
    lines = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6)]
    run = "\n".join(lines)
    inside = " ".join(f"v{j}" for j in range(60))
    texts = [run, f"own line\n{run}\nlast line", f"before {inside} behind", f"ahead {inside} after"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    found = {r.doc_id: r for r in corpus_pipeline.without_repeated_lines(spark, docs, SF).collect()}
    wanted = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert {i: r.text for i, r in found.items()} == wanted
    # a later run of whole lines goes, a line is kept or deleted as a whole
    assert [wanted[i] for i in range(4)] == [run, "own line\nlast line", *texts[2:]]
    assert all(r.n_chars == len(r.text) for r in found.values())
