"""Centroid clustering with Orchard's search for the nearest centroid.

Components are integers floor(64 * x), so distances, sums and means are exact and
don't depend on the order of rows. For every centroid the others are listed by
their distance from it. A vector starts at some centroid c at distance d and reads
c's list: a centroid that is closer (ties: of smaller number) becomes the new c and
its list is read from the start, centroids met before are marked and skipped. It
stops at the first list entry strictly beyond 2 d of c: by the triangle inequality
nothing from there on is closer or as close.

A round leaves each task as one row per centroid (count and component sums), so a
centroid that holds a third of all vectors is summed up before the shuffle. The
driver holds the k centroids and nothing else.
"""

from __future__ import annotations

import decimal
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .textstats import fresh

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Vectors of a search step (a task's memory).
SLICE_ROWS = 8192
#: Components from here on are searched with unbounded integers; beyond the second they count as it.
FAST, LARGEST = 1 << 22, 1 << 62
_LONG = (1 << 63) - 1


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Has the vector exactly ``dimensions`` components, none null, NaN or infinite?"""
    inf = F.lit(float("inf"))
    return F.coalesce((F.size(vector) == dimensions) & (F.size(F.array_compact(vector)) == dimensions)
                      & (F.array_max(vector) < inf) & (F.array_min(vector) > -inf), F.lit(False))


def quantized(values: np.ndarray) -> np.ndarray:
    """floor(64 x) of doubles, as 64-bit integers or, if large ones occur, as Python's."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < FAST:
        return scaled.astype(np.int64)
    whole = [max(-LARGEST, min(LARGEST, int(v))) for v in scaled.ravel()]
    return np.array(whole, dtype=object).reshape(scaled.shape)


def neighbour_lists(centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centroids, and for each all others by ascending distance (ties: by number)
    with these squared distances."""
    wide = any(abs(x) >= FAST for c in centroids for x in c)
    c = np.array(centroids, dtype=object if wide else np.int64)
    apart = ((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    order = np.array([[j for j in sorted(range(len(c)), key=lambda j: (apart[i][j], j)) if j != i]
                      for i in range(len(c))], np.int64).reshape(len(c), len(c) - 1)
    return c, order, np.take_along_axis(apart, order, axis=1)


def nearest(vectors: np.ndarray, lists: tuple, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid (ties: smallest
    number): Orchard's search for all vectors in step."""
    centroids, order, apart = lists
    n, k = len(vectors), len(centroids)
    if vectors.dtype == object or centroids.dtype == object:
        vectors = vectors.astype(object)

    def squared(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        d = vectors[rows] - centroids[which]
        return (d * d).sum(axis=1)

    at = np.full(n, start, np.int64)
    best = squared(np.arange(n), at)
    marked = np.zeros((n, k), bool)
    marked[:, start] = True
    place = np.zeros(n, np.int64)
    active = np.arange(n if k > 1 else 0)
    while len(active):
        here, p = at[active], place[active]
        other = order[here, p]
        inside = apart[here, p] <= 4 * best[active]
        place[active] += 1
        ask = inside.astype(bool) & ~marked[active, other]
        rows, which = active[ask], other[ask]
        marked[rows, which] = True
        d = squared(rows, which)
        closer = ((d < best[rows]) | ((d == best[rows]) & (which < at[rows]))).astype(bool)
        moved = rows[closer]
        at[moved], best[moved], place[moved] = which[closer], d[closer], 0
        active = active[inside.astype(bool)]
        active = active[place[active] < k - 1]
    return at, best


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return quantized(np.asarray(column.flatten(), np.float64).reshape(len(column), dimensions))


def _checked(df: DataFrame, vector: str, dimensions: int) -> DataFrame:
    return df.where(usable(F.col(f"`{vector}`"), dimensions))


def first_centroids(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS,
                    dimensions: int = DIMENSIONS, seed: int = 1) -> list[list[int]]:
    """The k kept vectors with the smallest sha256 of ``<seed>:<key>`` (null keys
    last; equal keys by their components), as integers; fewer if there are fewer."""
    text = F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string"))
    rows = _checked(df, vector, dimensions).select(
        F.sha2(text.cast("binary"), 256).alias("h"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    top = rows.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    return [[int(x) for x in quantized(np.array(r["v"]))] for r in top]


def assign(df: DataFrame, centroids: list[list[int]], vector: str = "embedding", cluster: str = "cluster",
           distance: str = "distance", dimensions: int = DIMENSIONS) -> DataFrame:
    """The kept rows of ``df`` with the number of the nearest centroid and the
    squared distance (one beyond 2^63 - 1 is given as that). Columns so named, in
    any case, are replaced; without centroids there are no rows."""
    added = {cluster.lower(), distance.lower()}
    df = df.drop(*[c for c in df.columns if c.lower() in added and c != vector])
    lists = neighbour_lists(centroids) if centroids else None
    shared = df.sparkSession.sparkContext.broadcast(lists)  # k centroids
    at, names = df.columns.index(vector), [*df.columns, cluster, distance]

    def run(batches):
        if shared.value is None:
            return
        for batch in batches:
            for a in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                number, d = nearest(_matrix(part.column(at), dimensions), shared.value)
                if d.dtype == object:
                    d = np.array([min(x, _LONG) for x in d], np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(number.astype(np.int32)), pa.array(d)], names)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return _checked(df, vector, dimensions).mapInArrow(run, f"{ddl}, `{cluster}` int, `{distance}` long")


def moved(df: DataFrame, centroids: list[list[int]], vector: str = "embedding",
          dimensions: int = DIMENSIONS) -> list[list[int]]:
    """Centroids after one round: componentwise floor(sum / count) of the vectors
    nearest to each; a centroid with no vector stays."""
    shared = df.sparkSession.sparkContext.broadcast(neighbour_lists(centroids))
    k = len(centroids)

    def run(batches):
        counts, sums = [0] * k, np.zeros((k, dimensions), dtype=object)
        for batch in batches:
            for a in range(0, len(batch), SLICE_ROWS):
                x = _matrix(batch.column(0).slice(a, SLICE_ROWS), dimensions)
                number, _ = nearest(x, shared.value)
                order = np.argsort(number, kind="stable")
                found, begin = np.unique(number[order], return_index=True)
                part = np.add.reduceat(x[order], begin, axis=0)
                for c, row, n in zip(found, part, np.diff([*begin, len(order)])):
                    counts[c] += int(n)
                    sums[c] += row.astype(object)
        rows = [c for c in range(k) if counts[c]]
        if rows:
            column = pa.array([[decimal.Decimal(int(x)) for x in sums[c]] for c in rows], pa.list_(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([counts[c] for c in rows], pa.int64()), column],
                                             ["c", "n", "s"])

    parts = _checked(df, vector, dimensions).select(F.col(f"`{vector}`").alias("v")).mapInArrow(
        run, "c int, n long, s array<decimal(38,0)>")
    rows = parts.groupBy("c").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(j))).alias(f"s{j}") for j in range(dimensions)])
    out = [list(c) for c in centroids]
    for r in rows.collect():  # k rows at most
        out[r["c"]] = [int(r[f"s{j}"]) // int(r["n"]) for j in range(dimensions)]
    return out


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
        dimensions: int = DIMENSIONS, seed: int = 1) -> list[list[int]]:
    """Final centroids. ``df`` is read ``rounds + 1`` times, so it should be a stored
    table. Rows with another number of components, a null or a non-finite one are
    left out; repeated rows count each; with fewer than k rows there are fewer
    centroids, with none there is none."""
    centroids = first_centroids(df, key, vector, k, dimensions, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(df, centroids, vector, dimensions)
    return centroids


def op13(vectors: DataFrame) -> DataFrame:
    """Clusters of all vectors: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256. Rows that aren't kept have no row here."""
    vectors = vectors.select("vec_id", "embedding")
    centroids = fit(vectors)
    found = cut_lineage(assign(vectors, centroids).drop("embedding"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # k rows
    total, largest = sum(int(r["own"]) for r in sums), lambda x: min(int(x), _LONG)
    rows = [(r["cluster"], largest(r["own"]), largest(total), hashlib.sha256(
        ",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in sums]
    (number,) = fresh(found, "_number")
    ends = vectors.sparkSession.createDataFrame(
        rows, f"{number} int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(ends), found["cluster"] == ends[number]).drop(number)


def _rounds_sql(rounds: int) -> str:
    """The assignments and means of all rounds, as common table expressions."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (SELECT k.rid, k.vec_id, k.q, c.c, list_sum(list_transform(list_zip(k.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
  FROM kept k CROSS JOIN c{r} c),
a{r} AS (SELECT rid, vec_id, q, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            parts.append(f"""p{r} AS (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS j FROM a{r}),
s{r} AS (SELECT c, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM p{r} GROUP BY c, j),
m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS q FROM s{r} GROUP BY c),
c{r + 1} AS (SELECT o.c, coalesce(m.q, o.q) AS q FROM c{r} o LEFT JOIN m{r} m ON o.c = m.c)""")
    return ",\n".join(parts)


#: DuckDB twin of ``op13``: plain nearest-centroid assignment.
ORACLE_SQL = f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q, embedding AS e
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
ordered AS (SELECT q, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, e) AS place FROM kept),
c0 AS (SELECT place - 1 AS c, q FROM ordered WHERE place <= {CENTROIDS}),
{_rounds_sql(ROUNDS)}
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN (SELECT c AS number, q FROM c{ROUNDS}) f ON a.c = f.number
"""
