"""The registered queries: results of the contract on the small tables, twins where there are any."""

import duckdb
import pytest

import corpus_pipeline
from check import rows
from jobtide.llm import catalog

SF = "/root/testdata/sf0.001"
TWINS = catalog.twins()
KEY = {"op1_url_filter": "page_id", "op6_warc": "page_id"}


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    mine = rows(df.columns, df.collect())
    source = "pages" if name in KEY else "documents"
    assert len(mine) == spark.read.parquet(f"{SF}/{source}.parquet").count()
    assert df.columns[0] == KEY.get(name, "doc_id")
    if name in TWINS:
        con = duckdb.connect()
        for table in ("documents", "pages"):
            con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
        cur = con.execute(TWINS[name])
        columns = [d[0] for d in cur.description]
        assert sorted(columns) == sorted(df.columns) and mine == rows(columns, cur.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = catalog.stored(stage(spark, docs, SF), name)
        assert docs.columns == names and 0 < docs.count() <= kept
        kept = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == kept
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, last.collect()))


def test_pipeline_of_nothing_and_of_odd_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, toxicity string"
    odd = [(None, None, None, None, None, None), (1, "", "en", "a", 0, "x"), (2, "the of and " * 40, None, None, 1, "y"),
           (2, "the of and " * 40, None, None, 1, "y")]
    for data in ([], odd):
        docs = spark.createDataFrame(data, kind)
        for name, stage in corpus_pipeline.STAGES:
            docs = catalog.stored(stage(spark, docs, SF), name)
        assert docs.count() <= len(data)
