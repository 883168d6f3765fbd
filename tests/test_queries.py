"""Every registered relational query against its SQL in DuckDB."""

import duckdb
import pytest

from tessera.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, tmp_path, name):
    out = str(tmp_path / "out")
    QUERIES[name](spark, FOLDER).write.parquet(out)
    if name not in ORACLES:
        assert spark.read.parquet(out).count() > 0
        return
    db.sql(f"create or replace temp table want as {ORACLES[name]}")
    db.sql(f"create or replace temp table got as select * from read_parquet('{out}/*.parquet')")
    kinds = lambda t: sorted((x[0], x[1]) for x in db.sql(f"describe {t}").fetchall())
    assert kinds("want") == kinds("got")
    columns = ", ".join(f'"{c}"' for c, _ in kinds("want"))
    for a, b in (("want", "got"), ("got", "want")):
        assert db.sql(f"select {columns} from {a} except all select {columns} from {b} limit 3").fetchall() == []


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
