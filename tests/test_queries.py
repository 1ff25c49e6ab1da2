"""Every query over a driver table equals its SQL in DuckDB, names and types included."""

import os

import duckdb
import pytest

from tessera.plans import annotated, clocks, duplicates, findings, flows, further, outliers, pairs, pixels, reviews, scenes, spans, streams  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        p = f"{SF}/{f}"
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, tmp_path, name):
    out = str(tmp_path / "out")
    QUERIES[name](spark, SF).write.parquet(out)
    if name not in ORACLES:
        return
    mine, theirs = f"SELECT * FROM '{out}/*.parquet'", ORACLES[name]
    kinds = [dict((r[0], r[1]) for r in duck.sql(f"DESCRIBE {q}").fetchall()) for q in (mine, theirs)]
    assert kinds[0] == kinds[1]
    columns = ", ".join(f'"{c}"' for c in sorted(kinds[0]))
    for a, b in ((mine, theirs), (theirs, mine)):
        assert duck.sql(f"SELECT {columns} FROM ({a}) EXCEPT ALL SELECT {columns} FROM ({b}) LIMIT 3").fetchall() == []
