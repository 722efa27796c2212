"""The registered queries against their SQL, on the smallest driver tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import canonical

SF_DIR = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")

CHECKED = [
    "a5_resume",
    "b22_web_docs",
    "b22b_given_pages",
    "c1_attach_images",
    "d7_char_rep",
    "e15_filter_paragraphs",
    "f2_dedup_images",
    "f3_dedup_url",
    "f5_dedup_paragraphs",
    "f7_dedup_image_set",
    "g5_final_processing",
    "h4_histogram",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
