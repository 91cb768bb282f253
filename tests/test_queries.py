"""Every query with SQL, against another engine on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(names), sorted((tuple(cell(r[k]) for k in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def engine(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, engine, sf, name):
    df = entry.queries()[name](spark, sf)
    other = engine.sql(entry.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows(other.columns, other.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_nothing_imports_the_corpus_operators():
    for path in Path(entry.__file__).parent.joinpath("tramlake").rglob("*.py"):
        if path.parent.name != "llm":
            assert "tramlake.llm" not in path.read_text(), path
