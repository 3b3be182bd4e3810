"""Language identification by prediction with partial matching.

For each language a tree of byte contexts of order 0 to 3 holds how often each
byte followed. The probability of a byte follows the longest known context;
an unseen byte pays the context's escape probability (distinct followers
over followers plus distinct followers) and is looked up in the next shorter
context without the bytes already excluded, down to a uniform order -1 over
the 256 bytes. With the counts frozen, the code length of every (context,
byte) pair is a constant, so each tree becomes a table of its own; a text's
exact code length in a language is a sum of that table's entries. The shortest
code wins.

Trees are built one language a task from a bounded sample; only their tables
come to the driver and are broadcast (at most ``MAX_CONTEXTS`` times 257 numbers
and 257^3 context numbers a language; a Latin script takes 2 to 6 MB).
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_fold
from .textstats import fresh

ORDER = 3
#: Bounds of a language's training sample and of its contexts. A sample of Latin script
#: has some 10,000 contexts; one that had more than the bound would keep the most frequent.
SAMPLE_ROWS, SAMPLE_BYTES, MAX_CONTEXTS = 600, 1_500_000, 32_768
#: Documents over this share of the byte bound teach only where shorter ones are few.
LONG_SHARE = 20
_ROWS = 4096
CHUNK = 1 << 19
UNKNOWN = "und"


def training_sample(docs: DataFrame, folds: int = 5, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES,
                    key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language at most ``rows`` whole documents (in the order of a hash of the
    key) until ``size`` bytes are reached, from documents with a language whose
    crc32(key) mod ``folds`` is not 0. Documents of more than a twentieth of ``size``
    come last, so a language with twenty shorter candidates has twenty documents at
    least. Only (language, count) rows leave the executors; a hash threshold keeps
    the candidates few before they are ranked."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (crc_fold(key, folds) != 0)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(key), F.lit(10)).alias("h"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return known.select("lang", "text").limit(0)
    scale = 1 << 30
    limit = F.create_map(*[x for k, n in counts.items() for x in (
        F.lit(k), F.lit(min(scale, int(scale * (3.0 * rows + 50) / n))))])
    few = known.where(F.pmod("h", F.lit(scale)) < limit[F.col("lang")])
    ranked = Window.partitionBy("lang").orderBy(F.octet_length("text") * LONG_SHARE > size, "h", "text")
    few = few.withColumn("i", F.row_number().over(ranked)).where(F.col("i") <= rows)
    before = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    return few.withColumn("b", F.coalesce(before, F.lit(0))).where(F.col("b") < size).select("lang", "text")


def language_tree(texts: Sequence[str], order: int = ORDER, max_contexts: int = MAX_CONTEXTS) -> dict:
    """The frozen tree of one language as plain tables: code lengths by (context,
    byte class), the context of the last ``order`` byte classes, byte classes.
    Every language has its own contexts, whatever the others hold."""
    parts = [_folded(t) for t in texts]
    present = np.zeros(256, bool)
    for p in parts:
        present[p] = True
    lut = np.zeros(256, np.int64)
    lut[present] = np.arange(1, present.sum() + 1)
    base = int(present.sum()) + 1  # class 0: a byte this language never had, or before the text
    lut[65:91] = lut[97:123]
    s = np.concatenate([np.concatenate([np.zeros(order, np.int64), lut[p]]) for p in parts])

    def history(k: int) -> np.ndarray:
        key = np.zeros(len(s), np.int64)
        for j in range(k, 0, -1):
            key = key * base + np.concatenate([np.zeros(j, np.int64), s[:-j]])
        return key

    # contexts: all of order 0, then the most frequent of each order
    contexts: list[np.ndarray] = [np.zeros(1, np.int64)]
    full = s > 0
    for k in range(1, order + 1):
        full = full & (np.concatenate([np.zeros(k, np.int64), s[:-k]]) > 0)
        keys, n = np.unique(history(k)[full], return_counts=True)
        room = max(0, max_contexts - sum(map(len, contexts)))
        contexts.append(np.sort(keys[np.argsort(-n, kind="stable")[:room]]))
    first = np.cumsum([0, *map(len, contexts)])

    def place(k: int, keys: np.ndarray) -> np.ndarray:
        """Row of each context of order k, -1 if it isn't kept."""
        c = contexts[k]
        if not len(c):
            return np.full(len(keys), -1)
        i = np.minimum(np.searchsorted(c, keys), len(c) - 1)
        return np.where(c[i] == keys, first[k] + i, -1)

    cost = np.zeros((first[-1], base), np.float32)
    counts = np.zeros((first[-1], base), np.int32)
    for k in range(order + 1):
        row = place(k, history(k))
        ok = (row >= 0) & (s > 0)
        np.add.at(counts, (row[ok], s[ok]), 1)
    for k in range(order + 1):
        for at in range(0, len(contexts[k]), _ROWS):
            keys = contexts[k][at:at + _ROWS]
            mass = np.ones(len(keys))
            p = np.zeros((len(keys), base))
            alive = np.ones((len(keys), base), bool)
            alive[:, 0] = False
            for j in range(k, -1, -1):
                row = place(j, keys % base**j)
                c = np.where(row[:, None] >= 0, counts[np.maximum(row, 0)], 0) * alive
                total, kinds = c.sum(1), (c > 0).sum(1)
                div = np.maximum(total + kinds, 1)
                p += c * (mass / div)[:, None]
                mass = np.where(total > 0, mass * kinds / div, mass)
                alive &= c == 0
            rest = 256 - (base - 1 - alive.sum(1))
            each = (mass / np.maximum(rest, 1))[:, None]
            p = np.where(alive, each, p)
            p[:, 0] = each[:, 0]
            cost[first[k] + at:first[k] + at + len(keys)] = -np.log2(np.maximum(p, 1e-12))
    grid = np.arange(base**order)
    longest = np.zeros(len(grid), np.uint16 if first[-1] < 65536 else np.int32)
    for k in range(1, order + 1):
        row = place(k, grid % base**k)
        longest = np.where(row >= 0, row, longest).astype(longest.dtype)
    return {"cost": cost, "longest": longest, "lut": lut, "base": base, "order": order}


def build_tables(sample: Sequence[tuple[str, str]], order: int = ORDER, max_contexts: int = MAX_CONTEXTS) -> dict:
    """The trees of all languages of (language, text) rows."""
    langs = sorted({lang for lang, _ in sample})
    return {"langs": langs, "trees": [language_tree([t for k, t in sample if k == lang], order, max_contexts) for lang in langs]}


def _folded(text: str) -> np.ndarray:
    return np.frombuffer(text.encode().lower(), np.uint8)


def code_lengths(t: dict, offsets: np.ndarray, data: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Bits of each text (rows) in each language; ``offsets`` delimit the texts in
    the byte array ``data``. Works through ``chunk`` bytes at a time, so a very
    long text needs no more memory than a short one."""
    n = len(offsets) - 1
    bits = np.zeros((n, len(t["langs"])))
    begin, end = int(offsets[0]), int(offsets[-1])
    for a in range(begin, end, chunk):
        b = min(end, a + chunk)
        row = np.searchsorted(offsets, np.arange(a, b), side="right") - 1
        into = np.arange(a, b) - offsets[row]  # bytes of the same text before this one
        starts = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
        for li, tree in enumerate(t["trees"]):
            order, base = tree["order"], tree["base"]
            codes = tree["lut"][data[max(begin, a - order):b]]
            skip = a - max(begin, a - order)
            key = np.zeros(b - a, np.int64)
            for j in range(order, 0, -1):
                prev = codes[max(skip - j, 0):skip - j + b - a]
                prev = np.concatenate([np.zeros(b - a - len(prev), np.int64), prev])
                key = key * base + np.where(into >= j, prev, 0)
            each = tree["cost"][tree["longest"][key], codes[skip:]]
            bits[row[starts], li] += np.add.reduceat(each, starts, dtype=np.float64)
    return bits


def predict(df: DataFrame, tables: dict, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the language of the shortest code and its share among all
    languages' probabilities of the text. A null text, a text without a letter and
    a model without a language give ``und`` with score 0; ties go to the first
    language by name. Other columns stay; columns of these names are replaced,
    in whatever case they are written."""
    keep = [c for c in df.columns if c.lower() not in (lang.lower(), score.lower())]
    (letters,) = fresh(df, "_letters")
    df = df.select(*[F.col(f"`{c}`") for c in keep],
                   F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias(letters))
    shared = df.sparkSession.sparkContext.broadcast(tables)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != letters)

    def run(batches):
        t = shared.value
        names = np.array([*t["langs"], UNKNOWN], object)
        for batch in batches:
            texts = pc.fill_null(batch.column(keep.index(text)), "").cast(pa.large_binary())
            has = np.asarray(batch.column(len(keep)))
            n = len(texts)
            best, share = np.full(n, len(t["langs"])), np.zeros(n)
            if t["langs"] and n:
                offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
                data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
                bits = code_lengths(t, offsets, data)
                top = bits.argmin(1)
                p = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
                best, share = np.where(has, top, best), np.where(has, p, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(share)], [*keep, lang, score])

    return df.mapInArrow(run, f"{schema}, `{lang}` string, `{score}` double")


def learn_languages(docs: DataFrame, folds: int = 5, **bounds) -> dict:
    """Tables learned from the bounded sample of ``training_sample``, a language a task."""

    def tree(key, rows):
        made = language_tree(rows.column("text").to_pylist())
        return pa.table([pa.array([key[0].as_py()]), pa.array([pickle.dumps(made)], pa.binary())], ["lang", "tree"])

    trees = training_sample(docs, folds, **bounds).groupBy("lang").applyInArrow(tree, "lang string, tree binary")
    made = {r["lang"]: pickle.loads(r["tree"]) for r in trees.collect()}
    return {"langs": sorted(made), "trees": [made[k] for k in sorted(made)]}


def op10(docs: DataFrame, folds: int = 5) -> DataFrame:
    tables = learn_languages(docs, folds)
    return predict(docs.select("doc_id", "text"), tables).select(
        "doc_id", F.coalesce(crc_fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
