"""Rows that are decided on are taken where they lie: their ids travel as bits, not the texts."""

from pyspark.sql import functions as F

from roadloom.llm import common


def _docs(spark, folder):
    rows = [(i if i % 7 else None, f"text {i % 40}", "en", "web", 6) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(folder)
    return common.with_fixed_id(spark.read.parquet(folder))


def test_texts_stay_and_rows_are_those_asked_for(monkeypatch, spark, tmp_path):
    docs = _docs(spark, f"{tmp_path}/docs")
    asked = docs.filter(F.col("n_chars") + F.length("text") > 12).filter("doc_id % 3 = 0 OR doc_id IS NULL")
    asked = asked.unionByName(asked).select("rid__").unionByName(spark.sql("SELECT CAST(NULL AS long) AS rid__"))
    found = common.only_rows(docs, asked, ["doc_id", "text"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hash" in line and "text#" in line]
    want = sorted(docs.join(asked, "rid__", "left_semi").select("rid__").collect())
    kept = common.among(docs, asked)
    assert kept.columns == docs.columns and sorted(kept.select("rid__").collect()) == want and len(want) > 60
    monkeypatch.setattr(common, "MASKS_IN_MEMORY", 0)
    assert sorted(common.among(docs, asked).select("rid__").collect()) == want
