"""Each query of the catalogue against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from fieldweave.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def rows(records, names):
    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return f"{float(v):.8g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(plain(r[n]) for n in names) for r in records)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == names
    assert rows([r.asDict() for r in df.collect()], names) == rows([dict(zip(columns, r, strict=True)) for r in found.fetchall()], names)


def test_whole_tables_as_input(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert QUERIES["all_face_edges"](spark, SF).count() == 3 * lines.count()
    assert QUERIES["all_unpacked_variables"](spark, SF).count() == lines.select("l_orderkey", "l_linenumber").distinct().count()
    pairs = QUERIES["all_radius_neighbours"](spark, SF)
    assert pairs.where("vertex_id % 10 <> 0").count() > 0 and pairs.where("vec_id = vertex_id").count() == pairs.select("vec_id").distinct().count()


def test_only_whole_days(spark):
    from fieldweave.operators import fields

    rows = [("a", step, float(step)) for step in (3, 4, 5, 6, 7, 8, 9, 10, 12)] + [("b", step, 1.0) for step in (5, 5, 6, 8)]
    found = fields.whole_days(fields.daily_fold(spark.createDataFrame(rows, "k string, step long, value double"), ["k"])).collect()
    assert [(r["k"], r["day"], r["daily_sum"]) for r in found] == [("a", 1, 26.0)]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
