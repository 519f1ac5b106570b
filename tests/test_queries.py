"""Every registered query against its SQL in DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from umitally.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    cell = lambda v: None if v is None or v is pd.NaT or v != v else round(v, 9) if isinstance(v, float) else str(v)
    return sorted((tuple(cell(v) for v in row) for row in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    numbers = lambda df: df.astype({c: float for c in df.columns if pd.api.types.is_numeric_dtype(df[c])})
    assert canonical(numbers(got)) == canonical(numbers(want))


def test_rejects_are_ordered_key_by_key(spark, tmp_path):
    """Keys of larger tables: orders whose keys a packed number cannot hold, parts and suppliers of more digits."""
    con = duckdb.connect()
    for shift, name in ((0, "parts"), (20_000_000, "orders")):
        folder = tmp_path / name
        folder.mkdir()
        con.execute(f"""COPY (SELECT l_orderkey // 40 + {shift} AS l_orderkey, l_linenumber, l_partkey + 3_000_000 * (l_partkey % 3) AS l_partkey, l_suppkey + 700_000 * (l_suppkey % 2) AS l_suppkey
                              FROM read_parquet('{SF}/lineitem.parquet')) TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
        con.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM read_parquet('{folder}/lineitem.parquet')")
        got, want = QUERIES["rejects_fastq"](spark, str(folder)).toPandas(), con.execute(SQL["rejects_fastq"]).df()
        assert len(want) > 100 and canonical(got) == canonical(want[list(got.columns)])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 50
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
