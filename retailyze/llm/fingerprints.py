"""One-permutation MinHash document fingerprints, from DataFrame functions only.

Every shingle of five words is hashed once. The top byte of the hash names one
of 256 bins, a bin keeps its smallest hash, and the lowest 4 bits of that hash
(mixed with the bin's number, so that bins which borrow one hash don't agree or
differ all at once) are stored. A bin no shingle fell into borrows from the first occupied bin of its
own fixed random probe sequence (optimal densification): the sequence depends on
the bin alone, so two texts borrow alike, and different bins borrow from
independent places. The share of equal 4-bit values, corrected for the 1/16
that agree by chance, estimates the Jaccard similarity of the shingle sets.

A fingerprint is 16 longs of 16 bins each, or 256 hex digits.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import words
from .textstats import fresh

SHINGLE, BINS, BITS = 5, 256, 4
#: Probes of the fixed sequences before an empty bin ranks all occupied ones.
PROBES = 12
_LOW = (1 << 56) - 1
_NIBBLES = 0x1111111111111111


def _probes(seed: int = 6) -> list[Column]:
    rng = random.Random(seed)
    return [F.array(*[F.lit(rng.randrange(BINS)) for _ in range(BINS)]) for _ in range(PROBES)]


def with_fingerprint(df: DataFrame, text: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``out``: array of 16 longs. Fewer words than a shingle: the whole
    sequence is the only shingle. Null text or no word: all zero."""
    w, h, d, real, full = fresh(df, "_w", "_h", "_d", "_real", "_full")
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    df = df.select(*kept, F.transform(words(F.col(f"`{text}`").cast("string")), lambda x: F.xxhash64(x)).alias(w))
    W, n = F.col(w), F.size(w)
    shingles = F.when(n >= shingle, F.transform(
        F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(W, i + k) for k in range(shingle)]))).when(
        n > 0, F.array(F.xxhash64(W))).otherwise(F.array().cast("array<bigint>"))
    # one sentinel at the top of every bin: after sorting, each bin has a first element
    top = F.array(*[F.lit((b << 56) | _LOW) for b in range(-BINS // 2, BINS // 2)])
    df = df.withColumn(h, F.sort_array(F.concat(shingles, top))).drop(w)
    H = F.col(h)
    first = F.filter(H, lambda x, i: (i == 0) | (F.shiftright(F.get(H, i - 1), 56) != F.shiftright(x, 56)))
    df = df.withColumn(d, F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != F.lit(_LOW), x))).drop(h)
    D = F.col(d)
    df = df.withColumn(real, F.filter(F.transform(D, lambda x, j: F.struct(j.alias("j"), x.alias("x"))),
                                      lambda s: s["x"].isNotNull()))
    R = F.col(real)
    ranked = lambda j: F.array_min(F.transform(R, lambda s: F.struct(F.xxhash64(j, s["j"]), s["x"].alias("x"))))["x"]
    probes = _probes()
    df = df.withColumn(full, F.when(F.size(R) > 0, F.transform(D, lambda x, j: F.coalesce(
        x, *[F.get(D, F.get(p, j)) for p in probes], ranked(j))))).drop(d, real)
    df = df.withColumn(full, F.transform(F.col(full), lambda x, j: F.xxhash64(x, j)))
    X = F.col(full)
    per = 64 // BITS
    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // per - 1)), lambda i: F.aggregate(
        F.slice(X, i * per + 1, per), F.lit(0).cast("long"),
        lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x.bitwiseAND(F.lit((1 << BITS) - 1).cast("long")))))
    none = F.array_repeat(F.lit(0).cast("long"), BINS // per)
    return df.select(*kept, F.when(X.isNull(), none).otherwise(packed).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two fingerprints; 1 if they are equal."""

    def differing(x: Column, y: Column) -> Column:
        v = x.bitwiseXOR(y)
        any_bit = v
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(v, k))
        return F.bit_count(any_bit.bitwiseAND(F.lit(_NIBBLES)))

    off = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, x: acc + x)
    chance = 1.0 / (1 << BITS)
    same = F.lit(1.0) - off / float(BINS)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (same - chance) / (1.0 - chance)))


def hex_digits(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


#: Rows of an id range that is sorted together, and the most ranges there are.
RANGE_ROWS, MAX_RANGES = 256, 1 << 16


def with_next(spark: SparkSession, df: DataFrame, key: str, carried: dict[str, str], tie: Column) -> DataFrame:
    """``df`` with, for each ``carried`` name, the value of the next row in descending
    ``key`` order under the new name; the first row follows the last.

    Rows are sorted within key ranges of equal width (``MAX_RANGES`` at most, so
    the table of range heads has a proven bound). The first row of each range is
    also dealt to the range before it, whose last row needs it. Equal keys go by
    ``tie``; null keys come last.
    """
    n, low, high = df.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    low, high = (0, 0) if low is None else (low, high)
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    k, rng, donor, to, head, tb = fresh(df, "_k", "_range", "_donor", "_to", "_head", "_tie")
    place = F.coalesce(F.col(key).cast("decimal(20,0)"), F.lit(low - 1).cast("decimal(20,0)"))
    width = (high - low + 2) / ranges
    spread = F.floor((F.col(k) - F.lit(low - 1).cast("decimal(20,0)")).cast("double") / F.lit(float(width))).cast("long")
    heads = df.select(place.alias(k)).withColumn(rng, spread).groupBy(rng).agg(F.max(k).alias(head)).collect()
    heads = sorted(((r[rng], r[head]) for r in heads), reverse=True)
    follow = [(h, heads[i - 1][0]) for i, (_, h) in enumerate(heads)]  # the first head goes to the last range
    table = F.broadcast(spark.createDataFrame(follow, f"{head} decimal(20,0), {to} long"))
    rows = df.withColumns({k: place, tb: tie}).withColumn(rng, spread).join(table, F.col(k) == F.col(head), "left").drop(head)
    dealt = rows.withColumn(donor, F.explode(F.when(F.col(to).isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    dealt = dealt.withColumn(rng, F.when(F.col(donor) == 1, F.col(to)).otherwise(F.col(rng)))
    order = Window.partitionBy(rng).orderBy(donor, F.col(k).desc(), tb)
    out = dealt.withColumns({new: F.lead(old).over(order) for old, new in carried.items()}).where(F.col(donor) == 0)
    return out.drop(k, rng, donor, to, tb)


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and the likeness of each
    text to its edited text and to the next document's."""
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = with_fingerprint(docs, "text", "fp")
    pairs = with_next(spark, docs, "doc_id", {"text": "next_text", "fp": "next_fp"}, F.xxhash64("text"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    pairs = pairs.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    both = with_fingerprint(pairs, "edited", "edited_fp")
    return both.select("doc_id", "n_chars", "edited_sha256", hex_digits(F.col("fp")).alias("fingerprint"),
                       hex_digits(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
