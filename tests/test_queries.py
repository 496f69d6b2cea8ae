"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from quillstone.plans import ORACLES, QUERIES

TABLES = ("documents", "pages", "benchmark", "conversations")


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name, tmp_path):
    QUERIES[name](spark, sf).write.parquet(str(tmp_path / "out"))
    got = f"(select * from '{tmp_path}/out/*.parquet')"
    columns = ", ".join(f'"{c}"' for c in db.execute(f"select * from {got} limit 0").df().columns)
    for a, b in ((got, f"({ORACLES[name]})"), (f"({ORACLES[name]})", got)):
        assert db.execute(f"select count(*) from (select {columns} from {a} except all select {columns} from {b})").fetchone()[0] == 0
