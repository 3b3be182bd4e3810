"""Automaton encoding against the public tokenizer library."""

import hashlib

import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from retailyze.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TABLES = bpe.load(PATH)
ENCODE = bpe.batch_encoder(TABLES)

ODD = ["", " \n\t ", "ooo oooo ooooo aaaa", "Hello <|endoftext|>x<|ENDOFTEXT|> <|startoftext|>", "x" * 3000,
       "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ é ́a \xa0b\x1cc\x85d", "日本語 テキスト 😀😀 ①² it's IT'S we'Ve 123abc", "abc\x00def​ q",
       "Ωµªº ß ẞ ﬁ Å", "a" * 50 + " " + "!" * 77 + "###$$$", "<|endoftext|>" * 3, "a<|endoftext|", "\r\n\x0b\x0c x"]


def ids_of(texts):
    offsets, ids = ENCODE(pa.array(texts, pa.string()))
    return [ids[offsets[i]:offsets[i + 1]].tolist() for i in range(len(texts))]


def test_odd_texts_encode_like_the_library():
    assert ids_of(ODD) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text_encodes_like_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids_of(texts) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", max_size=30),
       st.permutations([("a", "b"), ("b", "c"), ("a", "a"), ("aa", "a"), ("ab", "c"), ("b", "bc"), ("aa", "aa")]))
def test_automaton_equals_merging_by_rank(word, order):
    """The accepted path is what applying the merges in order gives, whatever the
    order (merges whose parts don't exist yet never apply)."""
    ready, merges = {"a", "b", "c"}, []
    for a, b in order:
        if a in ready and b in ready and a + b not in ready:
            merges.append((a, b))
            ready.add(a + b)
    vocab = {s: i for i, s in enumerate(sorted(ready))}
    auto = bpe.compile_automaton(vocab, merges)
    parts = list(word)
    for a, b in merges:
        i, out = 0, []
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (a, b):
                out.append(a + b)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    labels = auto.pop("labels")
    t = auto | {"inner": labels, "last": labels, "longest": max(map(len, labels))}
    names = {i: s for s, i in vocab.items()}
    assert [names[i] for i in bpe.word_encoder(t)(word)] == parts if word else True


def test_operators_and_odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(50, None, "y"), (50, None, "y"), (None, "null key", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode(docs, PATH).collect()
    assert len(got) == len(rows) and all(r["ids"] == LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids for r in got)
    out = {r["doc_id"]: r for r in bpe.op4(docs, PATH).collect()}
    for i, t in enumerate(ODD):
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert out[50]["n_tokens"] == 0
    assert bpe.op4(docs.limit(0), PATH).count() == 0


def test_packing_places_every_token_once(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (91, "word " * 9000), (91, "word " * 9000), (None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "x")
    got = packing.op1(docs, PATH).collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    want = sum(len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r["length"] for r in got) == want
    pieces = sorted((r["piece"], r["start"], r["length"]) for r in got if r["doc_id"] == 91)
    assert pieces == sorted(2 * [(0, 0, 4096), (1, 4096, 4096), (2, 8192, 809)])
    assert packing.op1(docs.limit(0), PATH).count() == 0


def test_sum_of_squares_rule_by_brute_force():
    """Every placement has the smallest sum of squared gap counts of all choices."""
    import numpy as np
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 21, 60)
    bins, offsets, fill = packing.pack_lengths(lengths, 20)
    level = {}
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])

        def energy(state):
            gaps = [20 - f for f in state.values() if f < 20]
            return sum(gaps.count(g) ** 2 for g in set(gaps))

        choices = {b: energy({**level, b: f + s}) for b, f in level.items() if f + s <= 20}
        choices["new"] = energy({**level, len(level): s})
        took = int(bins[i]) if int(bins[i]) in level else "new"
        assert choices[took] == min(choices.values())
        level[int(bins[i])] = level.get(int(bins[i]), 0) + s
    assert sorted(level.values()) == sorted(fill.tolist()) and max(level.values()) <= 20


@pytest.mark.parametrize("rows_per_block", [8, 64])
def test_packing_rounds_close_open_bins(spark, rows_per_block):
    pieces = spark.range(400).selectExpr("id", "1 + (id * 37) % 97 as length")
    got = packing.pack(pieces, capacity=100, block_rows=rows_per_block).toPandas()
    total = got.groupby("sequence_id")["length"].sum()
    assert total.max() <= 100 and len(got) == 400 and got["id"].nunique() == 400
    assert len(total) <= 1.15 * got["length"].sum() / 100
