"""One small local session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = Path(os.environ.get("SPARKLOOM_DATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from sparkloom.session import build_session

    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = build_session("tests", "local[4]", spark__driver__memory="4g", spark__sql__shuffle__partitions="4", spark__local__dir=scratch, spark__checkpoint__dir=f"{scratch}/ck", spark__sql__warehouse__dir=f"{scratch}/wh")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def sql(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def canonical(rows) -> list[tuple]:
    """Rows as sorted tuples of text; nulls and NaN alike."""
    show = lambda v: "~" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in r) for r in rows)


def check_against_sql(spark, sf_dir, sql, query, statement) -> None:
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = df.select(*columns).collect()
    theirs = sql.execute(statement)
    names = [d[0] for d in theirs.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert canonical(ours) == canonical([[r[i] for i in order] for r in theirs.fetchall()])
