"""SentencePiece encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from retailyze.llm import pieces
from retailyze.llm.common import table
from retailyze.llm.queries import piece_model_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def tables():
    return pieces.load(piece_model_path())


ODD = [None, "", " ", "   ", " a", "a ", "a  b\t\n\r\n c", "▁", "▁▁a ▁", "<s></s><unk><0x0A>", "x" * 30_000, "-" * 700, " " * 300 + "z",
       "\x00\x7f", "日本語 한국어 ไทย 😀👩‍👩‍👧", "�", "ﬁ é", "don't re-do it.\nNow!?", "a" * 49, "=" * 97 + " b"]


def test_ids_and_texts_are_the_library_s(spark, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(3, ODD[4], "y", 2), (None, "null key", "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, decoded int").repartition(3)
    path = piece_model_path()
    both = pieces.decode(pieces.encode(docs, path), path)
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    out = both.collect()
    assert len(out) == len(rows)
    for r in out:
        expected = library.encode(r["text"] or "", add_eos=True)
        assert r["ids"] == expected
        assert r["decoded"] == library.decode(expected)


def test_random_strings_of_pieces(library, tables):
    rng, encode = random.Random(2), pieces.text_encoder(tables)
    for _ in range(4000):
        s = "".join(rng.choice(tables["names"]) if rng.random() < 0.7 else rng.choice(tables["inner"] + " \n▁日é")
                    for _ in range(rng.randint(0, 10)))
        s = s.replace("▁", " ") if rng.random() < 0.8 else s
        assert np.frombuffer(encode(s), "<u4").tolist() == library.encode(s), s


def test_pair_test_is_the_merging_of_both(tables):
    rng, names = random.Random(4), tables["names"]
    quick, slow = pieces.pair_test(tables), pieces.pair_test(tables | {"simple": [False] * len(names)})
    by_start: dict = {}
    for i, s in enumerate(names):
        by_start.setdefault(s[0], []).append(i)
    both = set()
    for _ in range(6000):
        a = rng.randrange(len(names))
        b = rng.choice(by_start.get(rng.choice("aeinrst"), [a]))
        both.add(quick(a, b))
        assert quick(a, b) == slow(a, b), (names[a], names[b])
    assert both == {True, False}


def test_merge_order_that_does_not_rise(tables):
    """Ranks chosen so that a good piece is reached only through a bad one."""
    rank = {"bc": 0, "ab": 1, "cd": 2, "abcd": 3, "abc": 50, "de": 4, "dd": 5, "ddd": 5}
    model = [("a", "b"), ("b", "c"), ("d", "d")]
    assert model and pieces.merge(list("abcd"), rank) == ["abcd"]
    names = ["a", "b", "c", "d", "e", "bc", "abc", "abcd", "de", "dd"]
    number = {s: i for i, s in enumerate(names)}
    left = [number.get(x, -1) for x in ["", "", "", "", "", "b", "a", "abc", "d", "d"]]
    right = [number.get(x, -1) for x in ["", "", "", "", "", "c", "bc", "d", "e", "d"]]
    t = {"names": names, "left": left, "right": right, "rank": rank,
         "simple": [True] * 6 + [True, False, True, False], "out": [[i] for i in range(len(names))],
         "ids": number, "byte": {}, "inner": "abcde"}
    encode = pieces.word_encoder(t)
    rng = random.Random(0)
    for _ in range(500):
        s = "".join(rng.choice("abcde") for _ in range(rng.randint(1, 9)))
        merged = pieces.merge(list(s), rank)
        if all(m in number for m in merged):
            assert [names[i] for i in encode(s)] == merged, s


def test_decoding_any_ids(spark, library):
    rng = random.Random(7)
    lists = [[rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), 1, 2, 28705]) for _ in range(rng.randint(0, 12))] for _ in range(400)]
    lists += [[], [2], [1, 28705], [28705, 28705], [13, 28705], [2, 28705, 264], [0, 264], [264, 0]]
    df = spark.createDataFrame(list(enumerate(lists)), "k int, ids array<int>").repartition(4)
    for r in pieces.decode(df, piece_model_path()).collect():
        assert r["decoded"] == library.decode(r["ids"]), r["ids"]
    strange = spark.createDataFrame([(0, [-1, 264, 99_999, None]), (1, None)], "k int, ids array<int>")
    assert [r["decoded"] for r in pieces.decode(strange, piece_model_path()).orderBy("k").collect()] == [library.decode([264]), ""]


def test_query_on_the_table(spark, library):
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = pieces.op12(docs, piece_model_path()).collect()
    assert len(out) == docs.count()
    for r in out:
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table(spark):
    assert pieces.op12(spark.createDataFrame([], "doc_id long, text string"), piece_model_path()).count() == 0
