"""Every registered query against its SQL, on the smallest of the given data."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from ledgerline.trial.oracles import oracles
from ledgerline.trial.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="needs the given tables")

ORACLES = oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_the_entry_registers_them():
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_the_entry_works_without_the_text_operators():
    code = (
        "import sys; sys.modules['ledgerline.llm'] = sys.modules['corpus_pipeline'] = None; "
        "import __spark_entry__ as e; from ledgerline.trial.queries import QUERIES; "
        "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, check=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == expected
    assert expected
