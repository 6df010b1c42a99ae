"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF_DIR
from tools.check_oracle import TABLES, rows_of

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert got == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "rk", "phrase", "cnt", "rank_score"]
    assert not df.isEmpty()


def test_stop_words_are_those_of_spark(spark):
    from checks.oracle import stop_words
    from corpusloom.functions import words

    assert stop_words() == {code: [w for w in words.stop_words(code) if w] for code in ("en", "fr", "de", "es")}


def test_sql_needs_no_file_of_an_installed_package():
    import subprocess
    import sys

    code = "import pyspark; pyspark.__path__[:] = []; import checks.oracle as o; assert len(o.ORACLE) >= 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
