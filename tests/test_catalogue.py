"""Every catalogue query against DuckDB on the smallest tables."""

import duckdb
import pytest

from quadrille.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.mark.parametrize("name", list(catalogue.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.sql(catalogue.oracle_sql()[name])
    got = catalogue.queries()[name](spark, DATA)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    rows = lambda rs, cols: sorted(repr([r[cols.index(c)] for c in names]) for r in rs)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)


def test_fresh_identifiers(spark):
    assert catalogue.queries()["fresh_identifiers"](spark, DATA).count() == 5


def test_language_tags_of_escaped_texts(spark, tmp_path):
    texts = ['say "no"', "C:\\dir\\", '\\"both\\\\"', 'a "quoted" word @fr behind the first forty characters\nand a line', ""]
    spark.createDataFrame([(k, t, "en" if k % 2 else "de") for k, t in enumerate(texts)], "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(catalogue.oracle_sql()["language_tags"])
    got = catalogue.queries()["language_tags"](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) and got.count() == len(texts)
