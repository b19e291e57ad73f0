"""What op10 moves to the labels: words and scores, not texts."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from dealtide.llm import language_id, toxicity


def test_labels_meet_words_and_scores_not_texts(spark, tmp_path, monkeypatch):
    rows = [(i % 400, f"some words {i % 400} of a text" + " vile" * (i % 5 == 0)) for i in range(420)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 400, 2)] * 2, "doc_id long, toxic int").write.parquet(str(tmp_path / "l"))
    docs, labels = spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "l"))
    plans, columns, fold, join = [], [], toxicity.fold, toxicity._of_known

    def stored(df, label):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain()
        plans.append(out.getvalue())
        return fold(df, label)

    monkeypatch.setattr(toxicity, "fold", stored)
    monkeypatch.setattr(toxicity, "_of_known", lambda df, known: columns.append(df.columns) or join(df, known))
    languages = language_id.train(docs.limit(0).withColumn("lang", F.lit("x")))
    toxicity.train(docs, labels, languages)
    assert columns == [["doc_id", "words"], ["doc_id", "raw", "language"]]
    # one shuffle of the words, also for their distinct rows, whatever the size of the labels
    assert [(p.count("Exchange hashpartitioning"), p.count("SortMergeJoin")) for p in plans] == [(2, 1)]
