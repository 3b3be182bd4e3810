"""Spelling variants against all pairs of a small vocabulary, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from retailyze.llm import variants


def brute_counts(rows):
    n = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    out = {}
    for w in n:
        close = sorted(((-n[v], v) for v in n if v != w and abs(len(v) - len(w)) < 2 and near(w, v)))
        form = close[0][1] if close and -close[0][0] >= 10 * n[w] else None
        out[w] = [form, len(close), n[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        r.append(root)
    return {(w, f, r, n[w], k, fn) for w, (f, k, fn, r) in out.items()}


def texts(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    parts = ["an", "the", "ing", "re", "on", "é", "ÿa", "st", "er"]
    base = ["".join(rng.choice(parts) for _ in range(rng.randint(3, 6))) for _ in range(60)]
    rows = []
    for i in range(400):
        line = []
        for _ in range(40):
            w = base[min(int(rng.expovariate(0.15)), 59)]
            if rng.random() < 0.05:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("anxé") + w[k:], w[:k] + rng.choice("anxé") + w[k + 1:]])
            line.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(line)))
    anagrams = ["".join(rng.sample("abcdefgh", 8)) for _ in range(150)]  # equal letter counts, many one letter off
    rows.append((500, " ".join(a + " " + a[:-1] + "z, " + a + "\n" + a[:-1] + "z" for a in anagrams)))
    rows += [(None, "seventh seventh 日本seventh×"), (None, None), (501, ""), (502, "x" * 40_000 + " " + "x" * 40_000),
             (503, "y" * 40_001 + "1" + "y" * 40_001 + "2" + "y" * 40_002 + "3" + "y" * 40_002), (504, " \n\t "),
             (505, "Éclairer éclairer Éclairer éclairer"), (505, "Éclairer éclairer Éclairer éclairer")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, t, 7) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)


def result(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_against_all_pairs(spark, rows):
    n = brute_counts(rows)
    expected = brute(n)
    assert any(e[1] for e in expected) and max(e[4] for e in expected) > 3
    found = variants.op11(docs_of(spark, rows))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.count() == len(expected)
    assert result(found) == expected


@pytest.mark.parametrize("cells,block_words,block_queries", [(1, 10_000, 10_000), (9, 10_000, 10_000), (30, 5, 7)])
def test_cells_and_blocks_do_not_change_the_result(spark, rows, cells, block_words, block_queries):
    n = brute_counts(rows)
    expected = {(w, f, c, k, fn) for w, f, _, c, k, fn in brute(n)}
    vocabulary = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    found = variants.near_words(vocabulary, cells, block_words, block_queries)
    assert sorted(map(str, expected)) == sorted(str((r["word"], r["form"], r["n"], r["n_near"], r["form_n"])) for r in found.collect())


def test_chains_lead_to_the_last_form(spark):
    words = [(f"word{chr(97 + i)}aaaa", f"word{chr(98 + i)}aaaa" if i < 9 else None) for i in range(10)]
    forms = spark.createDataFrame(words, "word string, form string")
    assert {r["root"] for r in variants.with_roots(forms).collect()} == {words[-1][0]}


def test_walk_reaches_every_leaf_an_edit_leads_to():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(7, 9))) for _ in range(600)})
    points = variants.count_vectors(words)
    tree, leaf = variants.grow(points, 4, 200)
    assert len(set(leaf.tolist())) > 40
    for step, down in ((0, True), (1, False)):
        asked = points.copy()
        asked[:, -1] += step
        row, found = variants.walk(tree, asked, True, down)
        reached = set(zip(row.tolist(), found.tolist()))
        assert len(reached) == len(row)
        diff = points[:, None, :-1] - points[None, :, :-1]  # stored - asked
        for d, q in np.argwhere((np.abs(diff).sum(2) == 2 - step) & (points[:, None, -1] - points[None, :, -1] == step)):
            assert (q, leaf[d]) in reached


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.op11(empty).count() == 0
    assert variants.op11(spark.createDataFrame([(1, None), (2, "short words only")], "doc_id long, text string")).count() == 0
