"""Every registered query against plain SQL on the same Parquet files."""

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from conftest import DATA

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tickloom.oracle import ORACLE  # noqa: E402
from tickloom.queries import QUERIES  # noqa: E402


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime()
        return v.item() if hasattr(v, "item") else v

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(plain(v) for v in row) for row in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    ours = queries()[name](spark, DATA).toArrow()
    theirs = duck.execute(oracle_sql()[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    got, want = _canonical(ours.to_pandas()), _canonical(theirs.to_pandas())
    assert len(got) == len(want) > 0
    assert got == want
    for field in theirs.schema:
        assert str(ours.schema.field(field.name).type).replace("large_", "") == str(
            field.type
        ).replace("large_", "").replace("timestamp[us, tz=UTC]", "timestamp[us]"), field.name


def test_all_queries_have_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLE.keys() <= oracle_sql().keys()


def test_entry(spark):
    assert entry(spark).count() > 0
