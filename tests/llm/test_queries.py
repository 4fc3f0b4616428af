"""The registered queries on given tables, against their SQL where they have it."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from ledgerline.llm.queries import ORACLES, QUERIES

DATA = Path("/root/testdata")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="needs the given tables")

COLUMNS = {
    "op1": "doc_id size source_size target taken",
    "op4": "page_id url text n_chars",
    "op5": "doc_id n_shingles component_id",
    "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9": "vec_id n_links component_id kept",
    "op10": "doc_id size text_crc32 law shard slot grown_shard",
    "op11": "lang rank phrase a l r n score",
    "op12": "word form root n n_near form_n",
    "op13": "query_id rank vec_id score",
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    folder = DATA / "sf0.01"
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, str(folder))
    columns = sorted(df.columns)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == expected


#: Their rows are not those of the table.
OTHER_ROWS = ("op11", "op12", "op13")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    df = QUERIES[name](spark, str(DATA / "sf0.001"))
    assert set(COLUMNS.get(name.split("_")[0], "doc_id").split()) <= set(df.columns)


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith(OTHER_ROWS)))
def test_every_row_of_the_table_is_there(spark, name):
    folder = str(DATA / "sf0.001")
    df = QUERIES[name](spark, folder)
    table, key = {"op4": ("pages", "page_id"), "op9": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()}
    rows = df.collect()
    assert {r[key] for r in rows} == ids
    assert len(rows) == len(ids) or name.startswith("op7")
