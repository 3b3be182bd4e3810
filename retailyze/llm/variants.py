"""Spelling variants: words one edit apart, by k-d trees over letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by at most
one up and one down, an L1 distance of at most two. So the words near a word are
looked for by range searches in trees over (length, letter counts), once for the
pair of lengths (L, L) and once for (L, L + 1); a search goes into a half-space
only if the one step up and the one step down that an edit allows can reach it.
What a search returns is verified letter by letter.

The same walk is made twice. A top tree, fitted on a bounded sample of words, deals
all words into cells: a word is stored in its own cell and asks in every cell an
edit can lead to, so the tree decides the balance and never the result. Inside a
cell, a task builds a tree over the distinct count vectors of each length and
searches it. Cells with more words than a task should hold (letter counts can't
part anagrams) are dealt into a grid of blocks. Tasks return one row per word:
number of near words found and the best of them, never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: Runs of letters; shortest word; least count; one in so many runs loses a letter; a form's least ratio.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, DROP_EVERY, RATIO = 7, 2, 31, 10
#: Dimensions: a-z, the letters from U+00C0 to U+00FF, and the length last.
_DIMS = 26 + 64 + 1
_PLACE = np.full(256, -1, np.int64)
_PLACE[97:123] = np.arange(26)
_PLACE[192:256] = 26 + np.arange(64)
#: Words of the sample for the top tree (those up to SAMPLE_LETTERS long), words of a cell, least and largest
#: number of cells, words and asking words of a block, vectors of a leaf, pairs compared in one step.
SAMPLE, SAMPLE_LETTERS, CELL_WORDS, MIN_CELLS, MAX_CELLS = 200_000, 64, 8192, 64, 32_768
BLOCK_WORDS, BLOCK_QUERIES, LEAF, STEP = 65_536, 262_144, 12, 200_000
#: Distinct words a task counts before it hands them on.
COUNTED = 300_000
STORED, SAME, LONGER, OWN, APART = range(5)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n): runs of letters of all whole texts, A-Z in lower case, with at least
    ``min_length`` code points and ``min_count`` occurrences.

    With h the unsigned crc32 of ``<key>:<run>`` (null key: nothing before the
    colon), a run whose h is divisible by ``drop_every`` loses its code point
    h % length first; 0 turns this off. Null and empty texts have no words, repeated
    rows count each, other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.col(f"`{text}`").cast("string").alias("t"))

    def run(batches):
        find, crc = re.compile(f"[{LETTERS}]{{{min_length},}}").findall, zlib.crc32
        counts: Counter = Counter()
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if not t:
                    continue
                found = find(t.lower().decode())
                if drop_every and found:
                    start = crc(f"{k}:".encode())
                    for i, w in enumerate(found):
                        h = crc(w.encode(), start)
                        if not h % drop_every:
                            at = h % len(w)
                            found[i] = w[:at] + w[at + 1:]
                counts.update(found)
                if len(counts) >= COUNTED:
                    yield _counted(counts, min_length)
                    counts = Counter()
        yield _counted(counts, min_length)

    parts = rows.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(counts: Counter, min_length: int) -> pa.RecordBatch:
    words = [w for w in counts if len(w) >= min_length]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], ["word", "n"])


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words on end (all below 256), and where each word starts."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return codes, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


def count_vectors(words: list[str]) -> np.ndarray:
    """Letter counts of each word, its length last."""
    codes, starts = letters(words)
    n, sizes = len(words), np.diff(starts)
    row = np.repeat(np.arange(n), sizes)
    flat = np.bincount(row * _DIMS + _PLACE[codes], minlength=n * _DIMS)
    out = flat.reshape(n, _DIMS)
    out[:, -1] = sizes
    return out.astype(np.int16 if not n or sizes.max() < 1 << 15 else np.int32)


def grow(points: np.ndarray, leaf_rows: int, leaves: int) -> tuple[dict, np.ndarray]:
    """k-d tree over ``points``: the dimension of largest variance is cut next to its
    median until a node has ``leaf_rows`` points, or ``leaves`` leaves exist (widest
    nodes first). The tree as arrays, and the leaf of each point."""
    dim, cut, left, right = [-1], [0], [-1], [-1]
    own = np.zeros(len(points), np.int64)
    todo, made = [(0, np.arange(len(points)))], 1
    while todo and made < leaves:
        todo.sort(key=lambda x: len(x[1]))
        node, rows = todo.pop()
        if len(rows) <= leaf_rows:
            break
        part = points[rows]
        spread = part.var(axis=0, dtype=np.float64)
        j = int(spread.argmax())
        if spread[j] == 0:
            continue
        values = np.sort(part[:, j])
        middle = values[len(values) // 2]
        # x <= cut goes left: the cut below or at the median that parts the rows more evenly
        below, upto = np.searchsorted(values, middle), np.searchsorted(values, middle, side="right")
        low = below and (upto == len(values) or abs(2 * below - len(values)) <= abs(2 * upto - len(values)))
        t = int(values[below - 1]) if low else int(middle)
        goes = part[:, j] <= t
        for side, kept in ((left, rows[goes]), (right, rows[~goes])):
            side[node] = len(dim)
            todo.append((len(dim), kept))
            own[kept] = len(dim)
            for a, v in ((dim, -1), (cut, 0), (left, -1), (right, -1)):
                a.append(v)
        dim[node], cut[node] = j, t
        made += 1
    tree = {k: np.array(v, np.int64) for k, v in (("dim", dim), ("cut", cut), ("left", left), ("right", right))}
    tree["leaf"] = np.where(tree["dim"] < 0, np.cumsum(tree["dim"] < 0) - 1, -1)
    return tree, tree["leaf"][own]


def walk(tree: dict, points: np.ndarray, up: bool, down: bool):
    """(row, leaf) for every leaf whose half-spaces a point reaches when one letter
    count may go up by one (``up``) and another down by one (``down``): a path is
    left as soon as it asks for a second step. Each leaf has one path, so no pair
    comes twice."""
    rows = np.arange(len(points))
    node = np.zeros(len(points), np.int64)
    risen = np.full(len(points), -1 if up else -2)  # the letter that went up; -2: none may
    fallen = np.full(len(points), -1 if down else -2)
    out_rows, out_leaves = [], []
    while len(rows):
        done = tree["leaf"][node] >= 0
        if done.any():
            out_rows.append(rows[done])
            out_leaves.append(tree["leaf"][node[done]])
            rows, node, risen, fallen = (x[~done] for x in (rows, node, risen, fallen))
        j, t = tree["dim"][node], tree["cut"][node]
        x = points[rows, j] + (risen == j).astype(np.int64) - (fallen == j)
        free = (j < _DIMS - 1) & (risen != j) & (fallen != j)
        right, left = x > t, x <= t
        rise = free & (risen == -1) & (x == t)
        fall = free & (fallen == -1) & (x == t + 1)
        r, f = right | rise, left | fall
        new_risen, new_fallen = np.where(rise, j, risen), np.where(fall, j, fallen)
        rows, node, risen, fallen = (np.concatenate(p) for p in (
            (rows[r], rows[f]), (tree["right"][node[r]], tree["left"][node[f]]),
            (new_risen[r], risen[f]), (fallen[r], new_fallen[f])))
    if not out_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_rows), np.concatenate(out_leaves)


class _Group:
    """Rows with equal count vectors, as classes: vectors, and members by class."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray):
        raw, width, number = np.ascontiguousarray(vectors).tobytes(), vectors.shape[1] * vectors.itemsize, {}
        of = np.array([number.setdefault(raw[i:i + width], len(number)) for i in range(0, len(raw), width)], np.int64)
        _, first = np.unique(of, return_index=True)
        order = np.argsort(of, kind="stable")
        self.vectors, self.members = vectors[first], rows[order]
        self.size = np.bincount(of, minlength=len(first))
        self.start = np.cumsum(self.size) - self.size


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [first, first + size): the number of each item's range, and the item."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]


def _chunks(weights: np.ndarray, most: int):
    """Ranges of rows with about ``most`` of weight, one row at least."""
    ends, a = np.cumsum(weights), 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def class_pairs(asked: _Group, stored: _Group, step: int):
    """Blocks of (asking class, stored class) whose counts are one edit apart: the
    range search. ``step`` is the difference of the lengths, 0 or 1."""
    tree, leaf = grow(stored.vectors, LEAF, len(stored.vectors))
    by_leaf = np.argsort(leaf, kind="stable")
    sizes = np.bincount(leaf, minlength=int(leaf.max()) + 1)
    starts = np.cumsum(sizes) - sizes
    used = np.flatnonzero((stored.vectors != 0).any(axis=0) | (asked.vectors != 0).any(axis=0))
    used = used[used < _DIMS - 1]
    small = np.int8 if max(stored.vectors.max(), asked.vectors.max()) < 64 else np.int32
    a, b = asked.vectors[:, used].astype(small), stored.vectors[:, used].astype(small)
    probe = asked.vectors.copy()
    probe[:, -1] += step
    for lo in range(0, len(probe), 20_000):
        row, found = walk(tree, probe[lo:lo + 20_000], True, step == 0)
        row += lo
        for x, y in _chunks(sizes[found], STEP):
            which, item = _spread(starts[found[x:y]], sizes[found[x:y]])
            q, d = row[x:y][which], by_leaf[item]
            hit = np.abs(b[d] - a[q]).sum(axis=1, dtype=np.int64) == 2 - step
            if hit.any():
                yield q[hit], d[hit]


def one_edit(codes: np.ndarray, starts: np.ndarray, q: np.ndarray, d: np.ndarray, length: int, step: int) -> np.ndarray:
    """Does word d (``length`` letters) differ from word q by exactly one replaced
    (``step`` 0) or one more letter (``step`` 1)?"""
    at = np.arange(length - step)
    a = codes[starts[q][:, None] + at]
    if step == 0:
        return (a != codes[starts[d][:, None] + at]).sum(axis=1) == 1
    b = codes[starts[d][:, None] + np.arange(length)]
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= length - 1


def search(words: list[str], n: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of near words found here and the row of the best one
    (largest n, then smallest in code-point order; -1: none).

    STORED and APART words answer; SAME rows ask for their own length, LONGER rows for
    one letter more; STORED words ask each other, OWN rows the APART ones of the same
    cell, each pair once."""
    vectors = count_vectors(words)
    codes, starts = letters(words)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
    by_rank = np.argsort(rank)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    size = vectors[:, -1]
    own, answers = (role == OWN) | (role == STORED), (role == STORED) | (role == APART)
    for length in np.unique(size[answers]):
        rows = np.flatnonzero(answers & (size == length))
        stored = _Group(rows, vectors[rows])
        for asking, step in ((own & (size == length), 0), ((role == SAME) & (size == length), 0),
                             ((role == LONGER) & (size == length - 1), 1)):
            rows = np.flatnonzero(asking)
            if not len(rows):
                continue
            asked = _Group(rows, vectors[rows])
            for qc, dc in class_pairs(asked, stored, step):
                for x, y in _chunks(asked.size[qc], STEP):
                    which, item = _spread(asked.start[qc[x:y]], asked.size[qc[x:y]])
                    for u, v in _chunks(stored.size[dc[x:y][which]], STEP):
                        one, other = _spread(stored.start[dc[x:y][which[u:v]]], stored.size[dc[x:y][which[u:v]]])
                        q, d = asked.members[item[u:v][one]], stored.members[other]
                        if own[rows[0]]:  # both ends ask: the better-ranked end counts
                            once = rank[q] < rank[d]
                            q, d = q[once], d[once]
                        size_of_step = max(1, 4 * STEP // int(length))
                        for k in range(0, len(q), size_of_step):
                            qs, ds = q[k:k + size_of_step], d[k:k + size_of_step]
                            ok = one_edit(codes, starts, qs, ds, int(length), step)
                            qs, ds = qs[ok], ds[ok]
                            near += np.bincount(qs, minlength=len(near)) + np.bincount(ds, minlength=len(near))
                            np.minimum.at(best, qs, rank[ds])
                            np.minimum.at(best, ds, rank[qs])
    found = best < len(words)
    return near, np.where(found, by_rank[np.where(found, best, 0)], -1)


def top_tree(vocabulary: DataFrame, cells: int | None = None) -> dict:
    """Tree that deals words into cells, from a sample of about SAMPLE words chosen by
    hash. Any tree gives the same result; this one gives cells of like size."""
    total = vocabulary.count()
    share = min(1.0, SAMPLE / max(1, total))
    some = vocabulary.where((F.char_length("word") <= SAMPLE_LETTERS)
                            & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) <= int(share * (1 << 30))))
    words = sorted(r[0] for r in some.select("word").collect())  # about SAMPLE words
    if cells is None:
        cells = max(min(MIN_CELLS, total // 256), min(total // CELL_WORDS, MAX_CELLS), 1)
    return grow(count_vectors(words), 1, cells)[0]


def _routes(words: list[str], tree: dict, split: dict):
    """(row, cell, role) of every copy of a word: stored in its cell, asking in each
    cell that an edit can reach (for its own length only in cells of a higher number,
    and in its own if that is split)."""
    points = count_vectors(words)
    row, home = walk(tree, points, False, False)
    cell = np.empty(len(words), np.int64)
    cell[row] = home
    apart = np.isin(home, list(split)) if split else np.zeros(len(home), bool)
    yield row[~apart], home[~apart], STORED
    yield row[apart], home[apart], APART
    yield row[apart], home[apart], OWN
    row, other = walk(tree, points, True, True)
    later = other > cell[row]
    yield row[later], other[later], SAME
    points[:, -1] += 1
    row, other = walk(tree, points, True, False)
    yield row, other, LONGER


def near_words(vocabulary: DataFrame, cells: int | None = None, block_words: int = BLOCK_WORDS,
               block_queries: int = BLOCK_QUERIES, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n of a vocabulary (word, n) without repeated words
    made of ``LETTERS``. n_near counts the words one edit away; form is the one of
    largest n (ties: smallest in code-point order) if that n is ``ratio`` times the
    word's n at least, else null. An empty vocabulary gives no rows."""
    vocabulary = vocabulary.select("word", "n")
    context = vocabulary.sparkSession.sparkContext
    tree = context.broadcast(top_tree(vocabulary, cells))  # at most 2 * MAX_CELLS nodes

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for a in range(0, len(batch), 10_000):
                for _, cell, role in _routes(batch.column(0).slice(a, 10_000).to_pylist(), tree.value, {}):
                    for c, k in zip(*np.unique(cell, return_counts=True)):
                        found[int(c), min(role, 1)] += int(k)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int32()),
                                              pa.array(list(found.values()), pa.int64())], ["cell", "role", "rows"])

    sizes = vocabulary.mapInArrow(count, "cell long, role int, rows long").groupBy("cell").agg(
        F.sum(F.when(F.col("role") == 0, F.col("rows"))).alias("stored"), F.sum(F.when(F.col("role") == 1, F.col("rows"))).alias("asking"))
    large = sizes.where((F.col("stored") > block_words) | (F.col("asking") > block_queries)).collect()  # MAX_CELLS rows at most
    split = {r["cell"]: (-(-r["stored"] // block_words), -(-((r["asking"] or 0) + r["stored"]) // block_queries)) for r in large}
    grid = context.broadcast(split)

    def route(batches):
        for batch in batches:
            for a in range(0, len(batch), 10_000):
                words, n = batch.column(0).slice(a, 10_000), batch.column(1).slice(a, 10_000)
                listed = words.to_pylist()
                for row, cell, role in _routes(listed, tree.value, grid.value):
                    i, j = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
                    for c in set(np.unique(cell).tolist()) & grid.value.keys():
                        at = np.flatnonzero(cell == c)
                        here, there = grid.value[c]
                        blocks, copies = (here, there) if role in (STORED, APART) else (there, here)
                        block = np.array([zlib.crc32(listed[k].encode()) % blocks for k in row[at]], np.int64)
                        block, copy = np.repeat(block, copies), np.tile(np.arange(copies), len(at))
                        more = [np.repeat(row[at], copies), np.full(len(block), c)] + ([block, copy] if role in (STORED, APART) else [copy, block])
                        row, cell, i, j = (np.concatenate([np.delete(x, at), y]) for x, y in zip((row, cell, i, j), more))
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                             pa.array(np.full(len(row), role, np.int32)), words.take(pa.array(row)), n.take(pa.array(row))],
                            ["cell", "i", "j", "role", "word", "n"])

    def find(group: pa.Table) -> pa.Table:
        words, n = group["word"].to_pylist(), group["n"].to_numpy()
        near, best = search(words, n, group["role"].to_numpy())
        rows = np.flatnonzero(near)
        form = pa.array([words[b] for b in best[rows]], pa.string())
        return pa.table({"word": pa.array([words[r] for r in rows], pa.string()), "n": pa.array(n[rows]), "n_near": pa.array(near[rows]),
                         "form": form, "form_n": pa.array(n[best[rows]])})

    routed = vocabulary.mapInArrow(route, "cell long, i int, j int, role int, word string, n long")
    found = routed.groupBy("cell", "i", "j").applyInArrow(find, "word string, n long, n_near long, form string, form_n long")
    none = F.lit(None)
    rows = found.unionByName(vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("string").alias("form"),
                                               none.cast("long").alias("form_n")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("w"))))
    merged = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    good = -F.col("b.m") >= ratio * F.col("n")
    return merged.select("word", "n", "n_near", F.when(good, F.col("b.w")).alias("form"), F.when(good, -F.col("b.m")).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) with root: the last word that forms lead to, the
    word itself where there is no form. Every step multiplies n, so chains are short
    and without circles; each round doubles the steps taken."""
    forms = cut_lineage(forms)
    links = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut_lineage(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        links = stepped.select("word", "root")
        if stepped.where(F.col("next").isNotNull()).isEmpty():
            break
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11(docs: DataFrame) -> DataFrame:
    """Spelling variants of all documents' words: word, form, root, n, n_near, form_n."""
    vocabulary = cut_lineage(word_counts(docs))
    return with_roots(near_words(vocabulary)).select("word", "form", "root", "n", "n_near", "form_n")
