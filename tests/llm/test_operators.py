"""Every operator against a brute-force version, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from retailyze.llm import chat, components, fingerprints, langid, ngram_lm, packing, qda, rules, sharding, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(11)
VOCAB = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


def prose(n: int, rng: random.Random) -> str:
    return "".join(rng.choice(VOCAB) + rng.choice([" ", " ", " ", ". ", ",\n"]) for _ in range(n))


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = [(i, prose(rng.randint(1, 120), rng)) for i in range(60)]
    base = rows[7][1] + prose(200, rng)
    for i in range(60, 100):  # near copies: a few words changed
        words = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(VOCAB)
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "a b c"), (105, prose(9000, rng)),
             (106, "x" * 40_000), (107, "spam! " * 500), (108, "### $$$ %%% " * 50), (108, "### $$$ %%% " * 50),
             (109, rows[3][1]), (None, rows[4][1]), (None, None), (110, "Ünïcode ÀÉ 日本語 \x85\xa0 text " * 5)]
    return rows


ROWS = odd_rows()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][k % 3], "s", k, "clash", 0.5) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, _stats string, score double").repartition(5).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 0 if t and ("!" in t or "#" in t) else 1, 0) for i, t in ROWS if i is not None and i % 3] + [(5, None, 0), (999, 1, 0), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# ------------------------------------------------------------------ simhash
def simhash_brute(text, shingle=4):
    w = [m.encode().lower() for m in WORD.findall(text or "")]
    parts = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(fps, bits):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_components_by_brute_force(docs):
    fps = [simhash_brute(t) for _, t in ROWS]
    roots = linked(fps, 4)
    lowest = defaultdict(list)
    for (i, _), r in zip(ROWS, roots):
        if i is not None:
            lowest[r].append(i)
    want = sorted(((i if i is not None else -1), f"{f:016x}", min(lowest[r]) if lowest[r] else -1) for (i, _), f, r in zip(ROWS, fps, roots))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"] if r["component_id"] is not None else -1) for r in simhash.op2(docs).collect())
    assert got == want
    assert simhash.op2(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [4, 64, 100_000])
@pytest.mark.parametrize("max_bits", [1, 3, 4, 7])
def test_links_have_the_components_of_all_pairs(spark, limit, max_bits):
    rng = random.Random(limit + max_bits)
    fps = {rng.getrandbits(64) for _ in range(30)}
    centre = rng.getrandbits(64)
    for _ in range(150):
        x = centre
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), max_bits, limit).collect()
    at = {s: i for i, s in enumerate(signed)}
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= max_bits for r in found)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = sorted((find(at[r["a"]]), find(at[r["b"]])))
        parent[b] = a
    assert [find(i) for i in range(len(fps))] == linked(fps, max_bits)


def test_one_row_of_each_component_stays(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    want = {r["component_id"] for r in simhash.op2(docs).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(w for w in want if w is not None)


def test_components_under_one_key_or_none_each_keep_a_row(spark):
    a, b, c, d, e = (prose(150, random.Random(k)) for k in range(5))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (9, e), (3, e), (None, e)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(None, a), (None, b), (7, c), (7, d), (3, e)])


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(200)] + [(i, i + 1) for i in range(2000, 2090)] + [(None, 4), (3, 3)]
    stars = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges if None not in e for x in e})
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if None not in (a, b):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert {x: stars.get(x, x) for x in nodes} == {x: find(x) for x in nodes}


# -------------------------------------------------------------------- rules
def counts_brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            cover.update(range(i, i + 8))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_rule_counts_and_verdicts(docs, labels):
    out = rules.op3(docs, labels).collect()
    want = Counter((i, *counts_brute(t)) for i, t in ROWS)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out) == want
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)
    assert rules.op3(docs.limit(0), labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in rules.op3(docs, labels.limit(0)).collect())


def test_learned_list_separates_and_prunes(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        junk, noise = i % 6 == 0, rng.random()
        rows.append((i, 0 if junk else 1, rng.uniform(0.5, 1) if junk and i % 12 else rng.uniform(0, 0.3),
                     rng.uniform(0, 0.2) if junk and not i % 12 else rng.uniform(0.4, 1), noise))
    df = spark.createDataFrame(rows, "doc_id long, q int, symbols double, variety double, noise double")
    stats = {k: F.col(k) for k in ("symbols", "variety", "noise")}
    learned = rules.learn(df, stats, F.col("q"), F.col("doc_id"))
    assert learned and all(c.stat != "noise" for r in learned for c in r.conditions)
    wrong = df.select("q", rules.verdict(learned, stats).isNotNull().alias("rejects")).where("rejects = (q = 1)").count()
    assert wrong <= 6
    assert rules.learn(df.where("q = 1"), stats, F.col("q"), F.col("doc_id")) == []


# ---------------------------------------------------------------------- qda
def test_posterior_is_that_of_the_regularised_gaussians(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (80, 3)) @ np.array([[1, .5, 0], [0, 1, .2], [0, 0, 1]])])
    y = np.array([1] * 300 + [0] * 80)
    df = spark.createDataFrame([(int(c), *map(float, r)) for c, r in zip(y, x)], "y int, a double, b double, c double")
    cols = [F.col(k) for k in "abc"]
    model = qda.fit(df, cols, F.col("y"))
    got = np.array([r[0] for r in df.select(qda.posterior(model, cols)).collect()])
    scatter = {k: (x[y == k] - x[y == k].mean(0)).T @ (x[y == k] - x[y == k].mean(0)) for k in (0, 1)}
    common = (scatter[0] + scatter[1]) / len(x)
    log = {}
    for k, n in ((0, 80), (1, 300)):
        share = 1 - (1 - qda.POOLED) * n / (n + 6)
        cov = (1 - share) * scatter[k] / n + share * common
        cov = (1 - qda.RIDGE) * cov + qda.RIDGE * np.diag(np.diag(common))
        d = x - x[y == k].mean(0)
        log[k] = np.log(n / len(x)) - np.linalg.slogdet(cov)[1] / 2 - np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) / 2
    assert got == pytest.approx(1 / (1 + np.exp(log[0] - log[1])), abs=1e-9)


def test_classifier_on_odd_rows(docs, labels):
    out = qda.op5(docs, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    by_text = defaultdict(set)
    ids = dict(ROWS)
    for r in out:
        if r["doc_id"] is not None:
            by_text[ids[r["doc_id"]]].add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert {r["score"] for r in qda.op5(docs, labels.limit(0)).collect()} == {1.0}
    assert qda.op5(docs.limit(0), labels).count() == 0


# -------------------------------------------------------------- fingerprints
def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_estimate_likeness(spark, docs):
    out = fingerprints.op6(spark, docs).collect()
    order = sorted([(i, t or "") for i, t in ROWS if i is not None], key=lambda r: -r[0])
    assert len(out) == len(ROWS)
    unique = {i: k for k, (i, _) in enumerate(order) if [x for x, _ in order].count(i) == 1 and 0 < k < len(order) - 1}
    errors = []
    for r in out:
        if r["doc_id"] not in unique:
            continue
        k = unique[r["doc_id"]]
        text, after = order[k][1], order[k + 1][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text), shingles(edited)
        errors.append(abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert np.mean(errors) < 0.05 and max(errors) < 0.2
    same = {r["fingerprint"] for r in out if r["doc_id"] in (3, 109)}
    assert len(same) == 1
    assert fingerprints.op6(spark, docs.limit(0)).count() == 0
    one = fingerprints.op6(spark, docs.where("doc_id = 0")).first()
    assert one["near_next"] == 1.0  # a single document follows itself


def test_next_rows_over_clumped_keys(spark):
    ids = [*range(300), *range(10**12, 10**12 + 300), -5, 7 * 10**11]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "k long, t string")
    got = {r["k"]: r["n"] for r in fingerprints.with_next(spark, df, "k", {"t": "n"}, F.col("t")).collect()}
    order = sorted(ids, reverse=True)
    assert got == {k: f"t{order[(i + 1) % len(order)]}" for i, k in enumerate(order)}


# --------------------------------------------------------------------- lm
def test_base_scores_and_counts(docs):
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in ROWS if not held(i) for w in tokens(t))
    total, distinct = sum(c.values()), len(c)
    out = ngram_lm.op7(docs).collect()
    want = Counter()
    for i, t in ROWS:
        w = tokens(t)
        want[i, held(i), len(w), sum(c[x] > 0 for x in w), total, round(sum(math.log10((c[x] + 1) / (total + distinct + 1)) for x in w), 5)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in out) == want
    assert all(r["score"] < 0 for r in out)
    assert ngram_lm.op7(docs.limit(0)).count() == 0


def _backoff_model(train):
    """(log10 probability of a word after a history, all words), straight from the counts."""
    seqs = [[ngram_lm.START, *t, ngram_lm.END] for t in train]
    uni = Counter(w for s in seqs for w in s[1:])
    total, distinct = sum(uni.values()), len(uni)
    grams = Counter(tuple(s[i:i + n]) for n in (2, 3) for s in seqs for i in range(len(s) - n + 1))
    followers = defaultdict(dict)
    for g, n in grams.items():
        if n >= ngram_lm.MIN_COUNT:
            followers[g[:-1]][g[-1]] = n

    def times(ctx):
        return grams[ctx] if len(ctx) == 2 else len(train) if ctx == (ngram_lm.START,) else uni[ctx[0]]

    def prob(ctx, w):
        if not ctx:
            return (uni[w] or distinct) / (total + distinct)
        got = followers.get(ctx)
        if not got:
            return prob(ctx[1:], w)
        if w in got:
            return (got[w] - ngram_lm.DISCOUNT) / times(ctx)
        left = 1 - sum((c - ngram_lm.DISCOUNT) / times(ctx) for c in got.values())
        return left / (1 - sum(prob(ctx[1:], x) for x in got)) * prob(ctx[1:], w)

    def score(t):
        h, acc = (ngram_lm.START,), 0.0
        for w in [*t, ngram_lm.END]:
            acc += math.log10(prob(h[-2:], w))
            h += (w,)
        return acc

    return prob, score, uni, followers


def _lines(seed=8, words=600, texts=500):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(words)]
    lines = [[rng.choice(words) for _ in range(rng.randint(1, 9))] for _ in range(200)]
    out = [[w for _ in range(rng.randint(0, 4)) for w in rng.choice(lines)] for _ in range(texts)]
    return out + [["never", "seen"], [], [w for _ in range(300) for w in rng.choice(lines)]]


def test_brute_force_backoff_sums_to_one():
    prob, _, uni, followers = _backoff_model(_lines(3, 12, 120))
    assert len(followers) > 20
    for ctx in followers:
        assert sum(prob(ctx, w) for w in [*uni, "no such word"]) == pytest.approx(1.0, abs=1e-9)


@pytest.mark.parametrize("block_bytes, bucket_tokens", [(300, 100), (4000, 10**6), (10**7, 10**6)])
def test_every_repeated_ngram_is_an_arc_however_texts_are_cut(spark, block_bytes, bucket_tokens):
    texts = _lines()
    _, score, uni, _ = _backoff_model(texts[:400])
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Score string").repartition(3)
    out = ngram_lm.score_corpus(docs, F.col("doc_id") < 400, block_bytes=block_bytes, bucket_tokens=bucket_tokens)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["score"] == pytest.approx(score(t), abs=1e-6), i
        assert got[i]["n_known"] == sum(w in uni for w in t) + 1


def test_stretches_carry_their_state(spark):
    """Any cut of the texts gives the same path weights."""
    texts = _lines(5)
    docs = spark.createDataFrame([(" ".join(t),) for t in texts], "text string").coalesce(1)
    (row,) = ngram_lm.tokenised(docs, F.lit(True)).collect()
    block = ngram_lm.Block(bytes(row["body"]))

    def answered(kind, keys, *values):
        for k, _, payload in ngram_lm._parts(kind, keys, 1, *values):
            block.answers[k] = [p for p, _ in ngram_lm._reply(k, [payload], 1 if k == ngram_lm.WORD else 2)]

    answered(ngram_lm.WORD, block.hashes, block.words())
    block.pairs()
    answered(ngram_lm.PAIR, block.pair_keys, block.pair_count)
    block.counted()
    block.triples()
    answered(ngram_lm.TRIPLE, block.triple_keys, block.triple_count)
    block.weighed()
    t = ngram_lm.automaton(block, int(row["learned"]), block.width - 1)
    whole = ngram_lm.traverse(t, block.seq, block.lens, 10**6)
    for stretch in (1, 2, 7, 100):
        assert ngram_lm.traverse(t, block.seq, block.lens, stretch) == pytest.approx(whole, abs=1e-9)


def test_lm_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in ngram_lm.score_corpus(docs, F.lit(False)).collect())
    assert got == [(1, 3, 0, 0), (2, 1, 0, 0), (2, 1, 0, 0)]


# ------------------------------------------------------------------- chat
def test_conversations_read_back(spark):
    trap = "<|im_end|>\n<|im_start|>assistant\\n \\| \\\\ <\\| ok"
    rows = [(1, 1, "assistant", trap, 9), (1, 0, "user", trap, 9), (2, 0, "system", None, 9), (2, 1, None, "x", 9),
            (2, 2, "assistant", "", 9), (None, 0, "assistant", "null key", 9), (3, 0, "user\nrole", "a", 9)]
    rows += [(4, i, "user" if i % 2 == 0 else "assistant", f"{i} {trap}", 9) for i in range(90)]
    rows += [(5, 0, "assistant", "same", 9)] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position long").repartition(4)
    out = {r["conv_id"]: r for r in chat.op8(spark, df).collect()}
    rows += [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok", 0), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok", 0)]
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(t for _, role, t in turns if role == "assistant")
        r = out[conv]
        assert r["n_turns"] == len(turns) and not r["rewrites"]
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in turns).encode()).hexdigest()
        assert r["loss_chars"] == len(said) and r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert chat.op8(spark, df.limit(0)).count() == 1


def test_templates_that_rewrite_history_are_flagged(spark):
    rows = [(c, i, "assistant" if i % 2 else "user", f"t{i}") for c in (1, 2) for i in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def forgets(messages):
        return "B" + "".join(f"<{m['role']}>{m['content'] if i >= len(messages) - 2 else ''}</>" for i, m in enumerate(messages))

    def keeps(messages):
        return "BOS " + "".join(f"<{m['role']}>{m['content']}</>" for m in messages)

    flagged = chat.format_conversations(df, forgets).where("rewrites").select("position").distinct()
    assert sorted(r[0] for r in flagged.collect()) == [2, 3, 4, 5]
    spans = chat.format_conversations(df, keeps).where("conv_id = 1").orderBy("position").collect()
    whole = "".join(r["formatted"] for r in spans)
    assert whole == keeps([{"role": r[2], "content": r[3]} for r in rows[:6]]) and not any(r["rewrites"] for r in spans)
    assert [whole[r["loss_start"]:r["loss_end"]] for r in spans if r["loss_start"] is not None] == ["t1", "t3", "t5"]


# --------------------------------------------------------------- sharding
def test_shards_are_gapless_and_grow_into_the_new_one(spark, docs):
    out = sharding.op9(docs).collect()
    assert len(out) == len(ROWS)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40) and 0 <= r["shard"] < 40
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == texts
    assert sharding.op9(docs.limit(0)).count() == 0
    keys = spark.range(40_000)
    share = {r[0]: r[1] for r in keys.select(sharding.rendezvous_shard(F.col("id"), [1, 1, 2]).alias("s")).groupBy("s").count().collect()}
    assert share[2] == pytest.approx(20_000, rel=0.05) and share[0] == pytest.approx(10_000, rel=0.05)


# ------------------------------------------------------------------ langid
def ppm_bits(training: list[str], text: str, order: int, kept) -> float:
    """Code length by walking the escapes one context at a time."""
    counts = defaultdict(Counter)
    for t in training:
        b = t.encode().lower()
        for i, s in enumerate(b):
            for k in range(min(i, order) + 1):
                counts[b[i - k:i]][s] += 1
    bits, b = 0.0, bytes(x + 32 if 65 <= x <= 90 else x for x in text.encode())
    for i, s in enumerate(b):
        k = min(i, order)
        while k and b[i - k:i] not in kept:
            k -= 1
        p, out = 1.0, set()
        for j in range(k, -1, -1):
            seen = {x: n for x, n in counts[b[i - j:i]].items() if x not in out}
            total, kinds = sum(seen.values()), len(seen)
            if not kinds:
                continue
            if s in seen:
                p *= seen[s] / (total + kinds)
                break
            p *= kinds / (total + kinds)
            out |= set(seen)
        else:
            p /= 256 - len(out)
        bits -= math.log2(p)
    return bits


def test_code_lengths_by_brute_force():
    rng = random.Random(9)
    sample = [("xx", prose(60, rng)) for _ in range(6)] + [("yy", "".join(rng.choice("qrstuvwxyz é") for _ in range(300))) for _ in range(4)]
    tables = langid.build_tables(sample, max_contexts=100_000)
    kept = {t.encode().lower()[i - k:i] for _, t in sample for k in range(4) for i in range(k, len(t.encode()))}
    texts = ["", "a", prose(20, rng), "zZ é€!", sample[0][1], "Ωmega ABC"]
    data = np.frombuffer("".join(texts).encode() or b"", np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    for chunk in (7, 1 << 19):
        got = langid.code_lengths(tables, offsets, data, chunk)
        for t, row in zip(texts, got):
            for j, lang in enumerate(tables["langs"]):
                assert row[j] == pytest.approx(ppm_bits([x for k, x in sample if k == lang], t, 3, kept), rel=1e-4, abs=1e-3)


def test_languages_of_odd_rows(spark, docs):
    out = langid.op10(docs).collect()
    assert len(out) == len(ROWS)
    ids = dict(ROWS)
    for r in out:
        if r["doc_id"] is not None:
            letters = any(ch.isalpha() for ch in ids[r["doc_id"]] or "")
            assert (r["lang_pred"] in ("en", "de")) == letters and 0 <= r["score"] <= 1
    unlabelled = langid.op10(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    assert langid.op10(docs.limit(0)).count() == 0


def test_training_sample_is_bounded_and_reproducible(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('ab ', 20) as text", "if(id % 3 = 0, 'x', 'y') as lang")
    a = langid.training_sample(df, rows=50, size=2000).groupBy("lang").agg(F.count(F.lit(1)), F.sum(F.length("text"))).collect()
    assert len(a) == 2 and all(r[1] <= 50 and r[2] < 2000 + 60 for r in a)


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, docs, labels, tmp_dir):
    import corpus_pipeline
    docs.drop("n_words", "_stats", "score").write.parquet(f"{tmp_dir}/documents.parquet")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    given = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    rows = given
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        before = rows.count()
        stage(spark, rows, tmp_dir).write.parquet(f"{tmp_dir}/{k}")
        rows = spark.read.parquet(f"{tmp_dir}/{k}")
        after = rows.count()
        assert rows.columns == given.columns and 0 < after <= before, name
        assert after < before or name == "quality_classifier"  # the rules may leave it nothing to reject
    assert rows.where("doc_id in (100, 101, 102, 103, 104, 107, 108)").count() == 0
    packed = corpus_pipeline.run(spark, tmp_dir)
    assert {r[0] for r in packed.select("doc_id").collect()} == {r[0] for r in rows.select("doc_id").collect()}


def test_shards_keep_columns_named_like_helpers(spark):
    df = spark.createDataFrame([(i % 7, i, -i, i) for i in range(50)], "doc_id long, _mid long, _part long, _n long")
    out = sharding.shard_records(df)
    assert {"_mid", "_part", "_n"} <= set(out.columns)
    assert sorted((r["_mid"], r["_part"], r["_n"]) for r in out.collect()) == [(i, -i, i) for i in range(50)]


# --------------------------------------------------- round 3: bounds and clashes
def test_templates_that_look_far_back_are_flagged(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def last_40(messages):
        return "".join(f"<{m['role']}>{m['content']}</>" for m in messages[-40:])

    def numbered(messages):
        return f"({messages[0]['content'] if messages else ''})" + "".join(f"{i}:{m['content']};" for i, m in enumerate(messages))

    flagged = [r[0] for r in chat.format_conversations(df, last_40).where("rewrites").select("position").collect()]
    assert sorted(flagged) == list(range(40, 100))
    spans = chat.format_conversations(df, numbered).orderBy("position").collect()
    whole = numbered([{"role": r[2], "content": r[3]} for r in rows])
    assert [r["position"] for r in spans if r["rewrites"]] == [0]  # the empty prefix has no first turn to show
    assert whole.endswith("".join(r["formatted"] for r in spans[1:]))


def template(name):
    marked = chat.marked_turns

    def last_40(messages):
        return marked(messages[-40:])

    def numbered(messages):
        return f"({messages[0]['content'] if messages else ''})" + "".join(f"{i}:{m['content']};" for i, m in enumerate(messages))

    return {"last_40": last_40, "numbered": numbered, "marked": marked}[name]


def test_registered_chats_render_whole_prefixes(spark, monkeypatch):
    """A template that drops the turn 40 before the last one rewrites what it said."""
    rows = [(c, i, "assistant" if i % 2 else "user", f"t{i}") for c, n in ((1, 60), (2, 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = chat.format_conversations
    monkeypatch.setattr(chat, "format_conversations", lambda df, **kw: whole(df, render=template("last_40"), **kw))
    assert {r["conv_id"]: r["rewrites"] for r in chat.op8(spark, df).collect()} == {-1: False, 1: True, 2: False}


@pytest.mark.parametrize("name", ["marked", "last_40", "numbered"])
def test_long_chats_dealt_into_blocks(spark, monkeypatch, name):
    rows = [(c, i // 2, "assistant" if i % 3 else "user", f"{i}<|\\" * (i % 7)) for c, n in ((1, 70), (2, 6), (None, 55)) for i in range(n)]
    rows += [(3, 0, None, None)] * 50 + [(4, 0, "user", "x" * 5000), (4, 1, "assistant", ""), (4, 2, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spans = lambda: sorted((tuple(r) for r in chat.format_conversations(df, template(name)).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    alone, read = spans(), sorted(map(tuple, chat.op8(spark, df).collect()), key=str)
    dealt = []
    whole = chat._dealt
    monkeypatch.setattr(chat, "_dealt", lambda rows, *a: dealt.append(rows.select("conv_id").distinct().count()) or whole(rows, *a))
    monkeypatch.setattr(chat, "BLOCK_CHARS", 10_000)
    assert spans() == alone and dealt == [4]
    assert sorted(map(tuple, chat.op8(spark, df).collect()), key=str) == read
    monkeypatch.setattr(chat, "MAX_BLOCKS", 3)
    monkeypatch.setattr(chat, "BROADCAST_KEYS", 0)
    assert spans() == alone


def test_languages_dont_share_a_context_budget():
    rng = random.Random(4)
    big = [("big", prose(300, rng)) for _ in range(40)]
    small = [("small", "".join(rng.choice("αβγδεζηθ ") for _ in range(200))) for _ in range(2)]
    alone, both = langid.build_tables(small), langid.build_tables([*big, *small])
    assert both["langs"] == ["big", "small"]
    one, other = alone["trees"][0], both["trees"][1]
    assert all(np.array_equal(one[k], other[k]) for k in ("cost", "longest", "lut"))


def test_long_documents_teach_only_where_short_ones_are_few(spark):
    rows = [(i, "x" * 5000, "a") for i in range(50)] + [(100 + i, f"short {i}", "a") for i in range(50)] + [(999 + i, "y" * 9000, "b") for i in range(9)]
    got = langid.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=60, size=4000).collect()
    assert sum(r["lang"] == "a" and len(r["text"]) < 100 for r in got) >= 20
    assert sum(r["lang"] == "b" for r in got) == 1


def test_predict_replaces_columns_in_any_case(spark):
    df = spark.createDataFrame([("abc", 1, 2)], "text string, Score int, n int")
    out = langid.predict(df, langid.build_tables([("x", "abc abc")]))
    assert out.columns == ["text", "n", "lang_pred", "score"] and out.first()["lang_pred"] == "x"


def test_pack_keeps_columns_named_like_helpers(spark):
    df = spark.createDataFrame([(i, 1 + i * 37 % 4096, -i, 2 * i, 3 * i, 7) for i in range(300)],
                               "doc_id long, length long, _block long, _uid long, _fill long, offset long")
    out = packing.pack(df, block_rows=64)
    got = out.collect()
    assert {"_block", "_uid", "_fill"} <= set(out.columns)
    assert sorted((r["doc_id"], r["_block"], r["_uid"], r["_fill"]) for r in got) == [(i, -i, 2 * i, 3 * i) for i in range(300)]
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_rows_of_one_key_and_text_are_chosen_by_their_columns(spark):
    rows = [(7, "one two three four five", s, {"k": i}) for i, s in enumerate(["c", "a", "b"])] + [(8, None, "z", None), (8, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tags map<string, int>")
    for n in (1, 2, 5):
        kept = simhash.keep_one(df.repartition(n)).collect()
        assert sorted((r["doc_id"], r["source"] or "") for r in kept) == [(7, "a"), (8, "")]


def test_pipeline_stages_by_brute_force(spark, docs, labels, tmp_dir):
    import corpus_pipeline
    given = docs.drop("n_words", "_stats", "score")
    folder = f"{tmp_dir}/brute"
    given.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    odd = docs.withColumnsRenamed({"n_words": "_rules", "_stats": "_feats", "score": "_fp"})
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    kept = Counter((r["doc_id"], r["kept"]) for r in rules.op3(given, labels).collect())
    got = corpus_pipeline.quality_rules(spark, odd, folder)
    assert got.columns == odd.columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter({i: n for (i, k), n in kept.items() if k})
    good = Counter(r["doc_id"] for r in qda.op5(given, labels).collect() if r["score"] >= qda.THRESHOLD)
    assert Counter(r["doc_id"] for r in corpus_pipeline.quality_classifier(spark, odd, folder).collect()) == good
    roots = linked([simhash_brute(t) for _, t in rows], 4)
    least = {}
    for r, root in zip(rows, roots):
        rank = (r[0] is None, r[0] or 0, s - (1 << 64) if (s := simhash_brute(r[1])) >> 63 else s, key(r))
        least[root] = min(least.get(root, (rank, r)), (rank, r), key=lambda x: x[0])
    near = corpus_pipeline.near_duplicates(spark, odd, folder)
    assert near.columns == odd.columns
    assert sorted(map(key, ((r["doc_id"], r["text"]) for r in near.collect()))) == sorted(key(r) for _, r in least.values())
    packed = corpus_pipeline.best_fit_packing(spark, odd, folder)
    assert Counter(r["doc_id"] for r in packed.where("piece = 0").collect()) == Counter(i for i, _ in rows)
    empty = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and (name == "best_fit_packing" or out.columns == odd.columns)


def test_pipeline_leaves_no_tables(spark, docs, labels, tmp_dir):
    import corpus_pipeline
    from retailyze.session import ensure_checkpoint_dir
    folder = f"{tmp_dir}/left"
    docs.select("doc_id", "text", "lang", "source").write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    path = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark) + "/pipeline-*")
    assert not list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))
