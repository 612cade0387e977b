"""The stages one by one, and the queries' contracts on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from roadloom.llm import queries
from roadloom.llm.common import DOCUMENT_COLUMNS

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    assert compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) == ""


@needs_tables
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append(docs.select("doc_id").distinct().count())
        if number < 4:
            assert docs.columns == list(DOCUMENT_COLUMNS)
    assert 0 < kept[1] < kept[0] and kept[2] <= kept[1] and kept[2] == kept[3] == kept[4]
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


def test_awkward_rows_through_the_stages(awkward, empty, spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    os.makedirs(f"{tmp_path}/in")
    labels.write.parquet(f"{tmp_path}/in/labels.parquet")
    for source in (awkward, empty):
        docs = source
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, f"{tmp_path}/in")
        assert (docs.count() > 0) == (source is awkward)
