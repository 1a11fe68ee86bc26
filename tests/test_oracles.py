"""Every query with SQL gives the rows that DuckDB gives."""

import math
import random
from datetime import datetime
from functools import reduce
from operator import add

import duckdb
import pytest

from vitrine.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return float(v) if type(v).__name__ == "Decimal" else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    out = duck.execute(ORACLES[name])
    names = [c[0] for c in out.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, out.fetchall())


@pytest.mark.parametrize("name", ["player_daily_avg", "discount_player_trend"])
def test_means_at_a_half(spark, tmp_path, name):
    """Fractional counts whose mean is a half by decimals, but not by a sum of doubles in the order of the rows, or the other way round."""
    rng, rows = random.Random(5), []
    while len(rows) < 100:
        n = rng.choice([3, 4, 5, 6])
        cents = [rng.randint(1, 20000) for _ in range(n)]
        plain = reduce(add, [c / 100 for c in cents]) / n  # sum() would make up for the errors
        if sum(cents) % (100 * n) * 2 == 100 * n and plain % 1 != 0.5:
            rows += [(len(rows) + i, datetime(2024, 1, 1 + len(rows) % 28, 5), len(rows) // 80, "view", c / 100, None) for i, c in enumerate(cents)]
            rows[-n:] = [(r[0], rows[-n][1], rows[-n][2], *r[3:]) for r in rows[-n:]]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, f"n{i}") for i in range(4)], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect(config={"threads": 1})
    for table in ("events", "customer"):
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.execute(ORACLES[name]).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in QUERIES[name](spark, str(tmp_path)).collect())
