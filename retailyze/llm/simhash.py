"""SimHash near-duplicates with deletion-variant signatures.

64-bit fingerprints that differ in at most ``max_bits`` bits are cut into so few
segments that one of them differs in at most one bit: 3 segments for up to 5
differing bits. For each segment, every copy of it with one bit blanked out is
indexed; two segments that differ in at most one bit share such a variant. Equal
variants bring candidates together, the whole fingerprints decide.

Only distinct fingerprints are indexed. Inside one variant the links are reported
as a spanning forest, not as all pairs, so groups of thousands of near copies
stay linear in size while every link still counts for the components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _ddl
from .common import cut_lineage
from .components import components
from .textstats import fresh

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints of one variant that a task compares at once; a variant with more
#: is cut into blocks, and every pair of blocks is compared by itself.
RUN_ROWS = 16_384
_HASH_CHUNK = 50_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash: a bit is 1 if set in over half of the shingles'
    XXH64. Fewer words than a shingle: the whole sequence; no word: 0."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        starts, ends = [0], [len(joined)]
    else:
        lens = np.fromiter(map(len, words), np.int64, n)
        stop = np.cumsum(lens + 1) - 1
        starts, ends = (stop - lens)[: n - shingle + 1].tolist(), stop[shingle - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for a in range(0, len(starts), _HASH_CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a:a + _HASH_CHUNK], ends[a:a + _HASH_CHUNK])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE,
                     keep_text: bool = True) -> DataFrame:
    """``df`` with ``out``: the fingerprint as a signed long. Null text: 0."""
    df = df.drop(out)
    names = [c for c in df.columns if keep_text or c != text]
    at = [df.columns.index(c) for c in names]
    from_text = df.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(from_text)
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), pa.array(fps.view(np.int64))], [*names, out])

    return df.mapInArrow(run, f"{_ddl(df.select(*[F.col(f'`{c}`') for c in names]))}, `{out}` long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs in at most one bit."""
    n = max_bits // 2 + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, max_bits: int, fp: str = "fp") -> DataFrame:
    """(key, fp): one row per blanked bit. The key holds the blanked bit's number
    (which names the segment too) and the segment's other bits."""
    x, each = F.col(fp), []
    for first, width in segments(max_bits):
        seg = F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else x
        for j in range(width):
            if width <= 56:
                each.append(seg.bitwiseAND(F.lit(~(1 << j))).bitwiseOR(F.lit((first + j) << width)))
            else:
                each.append(F.xxhash64(F.lit(j), seg.bitwiseAND(F.lit(~(1 << j) if j < 63 else (1 << 63) - 1))))
    return fps.select(F.explode(F.array(*each)).alias("key"), x.alias("fp"))


def forest(fps: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Links that connect distinct fingerprints exactly as all pairs within
    ``max_bits`` would: each is compared with those not reached yet."""
    rest, links = fps.view(np.uint64), []  # bitwise_count takes the absolute value of signed numbers
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                got = rest[near]
                links.append(np.stack([np.full(len(got), x), got]).view(np.int64))
                todo.extend(got)
                rest = rest[~near]
    return links


def _link_runs(max_bits: int, limit: int | None):
    """mapInArrow over rows sorted by (key..., fp): (a, b, key) rows, either a link or,
    with null b, a member of a variant that holds more than ``limit``."""

    def of(key: np.ndarray, fp: np.ndarray):
        out = []
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        for d in (1, 2):  # small runs: all their pairs at once
            ok = np.repeat((size > d) & (size <= 3), size)[: len(key) - d] if len(key) > d else np.zeros(0, bool)
            i = np.flatnonzero(ok & (key[d:] == key[:-d])) if len(ok) else np.zeros(0, np.int64)
            i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= max_bits]
            out.append(np.stack([fp[i], fp[i + d]]))
        for a, n in zip(first[size > 3], size[size > 3]):
            out += forest(fp[a:a + n], max_bits)
        return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)

    def rows(links: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1]), pa.nulls(links.shape[1], pa.int64())], ["a", "b", "key"])

    def members(key: int, fp: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(fp), pa.nulls(len(fp), pa.int64()), pa.array(np.full(len(fp), key))], ["a", "b", "key"])

    def run(batches):
        key, fp, large = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            k, f = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if large is not None:  # the rest of a variant that is too large already
                n = int(np.searchsorted(k, large, side="right"))
                if n:
                    yield members(large, f[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                large = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield from _cut(key[:last], fp[:last], limit, of, rows, members)
                key, fp = key[last:], fp[last:]
            if limit and len(key) > limit:
                large = int(key[0])
                yield members(large, fp)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield from _cut(key, fp, limit, of, rows, members)

    return run


def _cut(key, fp, limit, of, rows, members):
    """Links of whole runs; runs over the limit are passed on as members."""
    if limit:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        if (size > limit).any():
            for a, n in zip(first[size > limit], size[size > limit]):
                yield members(int(key[a]), fp[a:a + n])
            keep = np.repeat(size <= limit, size)
            key, fp = key[keep], fp[keep]
    if len(key):
        links = of(key, fp)
        if links.shape[1]:
            yield rows(links)


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = RUN_ROWS) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp) whose components are
    those of all pairs that differ in at most ``max_bits`` bits."""
    schema = "a long, b long, key long"
    index = variants(fps, max_bits).repartition("key").sortWithinPartitions("key", "fp")
    found = cut_lineage(index.mapInArrow(_link_runs(max_bits, limit), schema))
    links = found.where("b is not null").select("a", "b")
    large = found.where("b is null").select("key", F.col("a").alias("fp"))
    counts = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / limit).cast("int").alias("n"))
    if not counts.take(1):
        return links
    block = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("n")).cast("int")
    pairs = large.join(counts, "key").withColumn("x", block).withColumn(
        "y", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    pairs = pairs.select(F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("key"), "fp")
    rest = pairs.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_link_runs(max_bits, None), schema)
    return links.unionByName(rest.select("a", "b"))


def _rooted(docs: DataFrame, key: str, text: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(key, fp) of every row, and (fp, _first, _root, component_id) of every distinct
    fingerprint: its smallest key, the smallest fingerprint of its component, and the
    component's smallest key. Only _root is a component's own: keys may repeat or be null."""
    rows = cut_lineage(with_fingerprint(docs.select(F.col(key), F.col(text).cast("string").alias("_text")), "_text", "fp", shingle, keep_text=False))
    return rows, _roots(rows, key, max_bits)


def _roots(rows: DataFrame, key: str, max_bits: int) -> DataFrame:
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min(key).alias("_first")))
    stars = components(fingerprint_links(distinct.select("fp"), max_bits))
    rooted = distinct.join(stars, distinct["fp"] == stars["node"], "left").select(
        "fp", "_first", F.coalesce("root", "fp").alias("_root"))
    # written before it is joined back: the join's sides are then two plain
    # shuffles, and the rows of one large component are split over several tasks
    lowest = cut_lineage(rooted.groupBy("_root").agg(F.min("_first").alias("component_id")))
    return rooted.join(lowest, "_root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``key``, fp, component_id (the smallest key reachable
    over links of at most ``max_bits`` differing bits, itself included).

    Texts without a word share fingerprint 0 and link like any other. A null key
    is never a component's id unless all its keys are null. Equal rows stay.
    """
    rows, rooted = _rooted(docs, key, text, shingle, max_bits)
    return rows.join(rooted.select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key, a null
    key last, then the smallest fingerprint, then the smallest values of its columns
    from left to right, nulls first (of equal rows, one). Components of one key, or
    without any, each keep their row. Columns stay as they are; those that can't be
    ordered (maps) don't decide. Rows are fingerprinted once and kept with their
    fingerprint in the checkpoint folder."""
    fp, one, want, want_fp = fresh(docs, "_fp", "_one", "_want", "_want_fp")
    keyed = cut_lineage(with_fingerprint(docs, text, fp, shingle))
    rooted = _roots(keyed.select(F.col(f"`{key}`").alias("_key"), F.col(fp).alias("fp")), "_key", max_bits)
    ties = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    keepers = rooted.where(F.col("_first").eqNullSafe(F.col("component_id"))).groupBy("_root").agg(
        F.min("component_id").alias(want), F.min("fp").alias(want_fp)).drop("_root")
    same = F.col(key).eqNullSafe(F.col(want)) & (F.col(fp) == F.col(want_fp))
    return (keyed.join(keepers, same)
            .withColumn(one, F.row_number().over(Window.partitionBy(want, want_fp).orderBy(*ties)))
            .where(F.col(one) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
