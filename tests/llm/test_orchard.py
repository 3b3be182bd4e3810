"""Centroid clustering against plain assignment with unbounded integers."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from retailyze.llm import orchard
from retailyze.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, cluster string, _number int"


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v], [float(np.float32(x)) for x in v]) for i, v in rows if v is not None
            and len(v) == 64 and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    kept = [(i, [max(-orchard.LARGEST, min(orchard.LARGEST, x)) for x in q], v) for i, q, v in kept]
    order = sorted(kept, key=lambda r: ((r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else ""), r[2]))
    cents = [r[1] for r in order[:k]]

    def assign():
        return [min(((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(cents))) for _, q, _ in kept]

    for _ in range(rounds):
        got = assign()
        for n in range(len(cents)):
            mine = [q for (_, q, _), (_, c) in zip(kept, got) if c == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    top = (1 << 63) - 1
    got = assign()
    capped = [(min(d, top), c) for d, c in got]
    total = min(sum(d for d, _ in capped), top)
    return sorted(((-1 if i is None else i), c, d, min(sum(x for x, y in capped if y == c), top), total,
                   hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _, _), (d, c) in zip(kept, capped))


def result(df):
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"],
                   r["centroid_sha256"]) for r in df.collect())


def vectors(n=300, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.integers(-2, 3, 64) / 64 + rng.integers(0, 3)).tolist()) for i in range(n)]
    same = rows[5][1]
    rows += [(i, same) for i in range(400, 460)] + [(5, rows[6][1]), (5, same), (None, rows[8][1])]
    rows += [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [0.5] * 63 + [None]),
             (905, [0.5] * 63 + [float("nan")]), (906, [0.5] * 63 + [float("inf")]), (907, [float("-inf")] + [0.5] * 63)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_search_finds_the_nearest_with_ties(dims):
    rng = np.random.default_rng(dims)
    for _ in range(150):
        r = int(rng.integers(1, 6))
        c = rng.integers(-r, r + 1, (int(rng.integers(1, 20)), dims))
        x = rng.integers(-r, r + 1, (100, dims))
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        at, best = orchard.nearest(x, orchard.neighbour_lists(c.tolist()), int(rng.integers(0, len(c))))
        assert (at == d.argmin(1)).all() and (best == d.min(1)).all()


def test_query_against_plain_assignment(spark):
    rows = vectors()
    out = orchard.op13(frame(spark, rows))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result(out) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = vectors(40)
    rows += [(1000 + i, [float(10 ** (i % 12)) * (1 if j % 2 else -1) for j in range(64)]) for i in range(30)]
    rows += [(2000, [3e38] * 64), (2001, [-3e38] * 64)]
    assert result(orchard.op13(frame(spark, rows))) == brute(rows)


def test_few_rows_and_empty(spark):
    rows = vectors(10)[:6]
    assert result(orchard.op13(frame(spark, rows))) == brute(rows)
    assert orchard.op13(frame(spark, [])).count() == 0
    assert orchard.op13(frame(spark, [(1, None), (2, [1.0])])).count() == 0


def test_other_columns_pass_and_clashes_are_replaced(spark):
    df = frame(spark, vectors(20))
    out = orchard.assign(df, orchard.fit(df))
    assert out.columns == ["vec_id", "embedding", "_number", "cluster", "distance"]
    assert out.where("_number = 1").count() == out.count() > 0


def test_sql_twin(spark):
    sf = "/root/testdata/sf0.001"
    mine = result(orchard.op13(table(spark, sf, "embeddings")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    cols = "vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256"
    assert mine == sorted(con.execute(f"SELECT {cols} FROM ({orchard.ORACLE_SQL})").fetchall())
