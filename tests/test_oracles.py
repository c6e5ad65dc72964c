"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest
from helpers import canon

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    got = canon(entry.queries()[name](spark, str(DATA)).toPandas())
    want = canon(sql.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_flagship(spark):
    found = {r["ner"]: r["cnt"] for r in entry.entry(spark).collect()}
    assert set(found) == {"B-w", "I-w", "L-w", "O", "U-w"} and found["B-w"] == found["L-w"]


def test_models_run_on_tables(spark):
    names = set(entry.queries()) - set(entry.oracle_sql())
    assert {"crf_fit", "crf_predict", "segment_lines", "batch_annotate", "offline_annotate", "crf_search"} <= names
    labels = entry.queries()["char_bilou"](spark, str(DATA)).select("ner").distinct().count()
    trans = entry.queries()["crf_fit"](spark, str(DATA)).where("kind = 'trans'")
    assert trans.count() == labels * labels
