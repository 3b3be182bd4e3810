"""SentencePiece encoding and decoding with a merge-type prefix table.

A merge-type model joins, again and again, the neighbouring pieces whose
concatenation is the best-scored piece (ties: leftmost). What it makes of a text
is the one sequence whose neighbours are all *compatible*: two pieces are, if the
merges of their concatenation stop at exactly these two. So every prefix of a text
has one last piece, and a table with one entry for each prefix is enough: at each
position the automaton's matches that end there are tried, and the one whose left
neighbour (the table's entry where the match starts) is compatible is stored.
Ids are recovered backwards from the last entry.

Compatibility is read off the merges that made both pieces, undone from the last
to the first along the border; where a piece is not made by merges of rising rank
the concatenation itself is merged. Both are kept by pair.

A text is cut only where no piece of the vocabulary reaches across. A character
without a piece becomes its UTF-8 bytes.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: SentencePiece's mark of a space, its piece types and the text of an unknown id.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_TEXT = " ⁇ "
#: Bounds of the per-worker memo tables (entries); they only save time.
MEMO_WORDS, MEMO_PAIRS, MEMO_LENGTH = 400_000, 1_000_000, 48
SLICE_BYTES = 4_000_000
_SHIFT = 24


def _varint(raw: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = raw[i]
        i += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, i
        shift += 7


def _fields(raw: bytes):
    """(number, value) of the fields of a protobuf message."""
    i = 0
    while i < len(raw):
        key, i = _varint(raw, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(raw, i)
        else:
            size, i = ({1: 8, 5: 4}[kind], i) if kind != 2 else _varint(raw, i)
            value, i = raw[i:i + size], i + size
        yield key >> 3, value


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id. Only what the method covers is accepted: merge
    type, no text normalisation, a space put in front, byte pieces."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, trainer, normal = [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            p = dict(_fields(value))
            pieces.append((p[1].decode(), struct.unpack("<f", p.get(2, bytes(4)))[0], p.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normal = dict(_fields(value))
    wanted = (trainer.get(3) == 2 and not trainer.get(24) and not normal.get(2) and normal.get(3, 1) == 1
              and not normal.get(4, 1) and normal.get(5, 1) == 1
              and {t for _, _, t in pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE}
              and sum(t == BYTE for _, _, t in pieces) == 256)
    if not wanted:
        raise ValueError("the model must be of merge type with byte pieces, identity normalizer and a space in front")
    return pieces


def merge(symbols: list[str], rank: dict[str, int], trace: list | None = None) -> list[str]:
    """The merges themselves, for short strings: lowest rank first, then leftmost."""
    s = list(symbols)
    while True:
        found = min(((rank[s[i] + s[i + 1]], i) for i in range(len(s) - 1) if s[i] + s[i + 1] in rank), default=None)
        if found is None:
            return s
        i = found[1]
        if trace is not None:
            trace.append((s[i], s[i + 1]))
        s[i:i + 2] = [s[i] + s[i + 1]]


def load(path: str) -> dict:
    """Plain tables of a model file, fit for a broadcast (their size is fixed):
    usable pieces with their last merge and rank, an id or the bytes' ids for each,
    and the text of every id."""
    model = read_model(path)
    scores = sorted({s for _, s, t in model if t == NORMAL}, reverse=True)
    order = {s: i for i, s in enumerate(scores)}
    ids = {p: i for i, (p, _, t) in enumerate(model) if t == NORMAL}
    rank = {p: order[s] for p, s, t in model if t == NORMAL and len(p) > 1}
    tied = {r for r, n in zip(*np.unique(list(rank.values()), return_counts=True)) if n > 1}
    byte = {int(p[3:-1], 16): i for i, (p, _, t) in enumerate(model) if t == BYTE}
    inner = sorted({c for p in rank for c in p})
    names, left, right, simple = [], [], [], []
    number: dict[str, int] = {}
    for s in [*sorted(set(inner) | {p for p in ids if len(p) == 1}), *sorted(rank, key=len)]:
        a = b = -1
        plain = True
        if len(s) > 1:
            trace: list[tuple[str, str]] = []
            if merge(list(s), rank, trace) != [s]:
                continue  # no text is ever encoded with it
            a, b = (number[x] for x in trace[-1])
            plain = simple[a] and simple[b] and rank[s] not in tied and all(
                rank.get(names[x], -1) < rank[s] for x in (a, b))
        number[s] = len(names)
        names.append(s)
        left.append(a)
        right.append(b)
        simple.append(plain)
    out = [[ids[s]] if s in ids else [byte[x] for x in s.encode()] for s in names]
    texts = [UNKNOWN_TEXT.encode() if t == UNKNOWN else b"" if t == CONTROL else bytes([int(p[3:-1], 16)])
             if t == BYTE else p.replace(MARK, " ").encode() for p, _, t in model]
    return {"names": names, "left": left, "right": right, "simple": simple, "rank": rank, "out": out,
            "ids": ids, "byte": byte, "inner": "".join(inner), "classes": char_classes(rank), "texts": texts,
            "spaced": [t == NORMAL and p.startswith(MARK) for p, _, t in model],
            "silent": [t == CONTROL for _, _, t in model],
            "end": next(i for i, (p, _, t) in enumerate(model) if t == CONTROL and p == "</s>"),
            "splits": not any(a != MARK and b == MARK for p in rank for a, b in zip(p, p[1:]))}


def char_classes(rank: dict[str, int]) -> list[str]:
    """Characters that pieces join to each other, directly or through others, the
    space mark apart: no piece reaches from one class into another."""
    parent: dict[str, str] = {}

    def root(c: str) -> str:
        while parent.setdefault(c, c) != c:
            c = parent[c]
        return c

    for piece in rank:
        chars = [c for c in piece if c != MARK]
        for a, b in zip(chars, chars[1:]):
            parent[root(a)] = root(b)
        if len(chars) == 1:
            root(chars[0])
    classes: dict[str, list[str]] = {}
    for c in sorted(parent):
        classes.setdefault(root(c), []).append(c)
    return sorted(("".join(c) for c in classes.values()), key=len, reverse=True)


def pair_test(t: dict):
    """Function (a, b) -> do the merges of a's and b's symbols stop at these two?"""
    names, left, right, simple, rank = t["names"], t["left"], t["right"], t["simple"], t["rank"]
    own = [rank.get(s, -1) for s in names]
    find = rank.get

    def compatible(a: int, b: int) -> bool:
        if names[a] + names[b] in rank:
            return False
        if not (simple[a] and simple[b]):
            return merge([*names[a], *names[b]], rank) == [names[a], names[b]]
        while True:
            ra, rb = own[a], own[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # a's last merge came last: what was there before had to be worse
                a = right[a]
                r = find(names[a] + names[b])
                if r is not None and r < ra:
                    return False
            else:  # a merge across the border stands left of b's own: it wins ties
                b = left[b]
                r = find(names[a] + names[b])
                if r is not None and r <= rb:
                    return False

    return compatible


def word_encoder(t: dict):
    """Function from a chunk (no piece reaches across its ends) to its ids."""
    import ahocorasick

    matches = ahocorasick.Automaton()
    for i, s in enumerate(t["names"]):
        matches.add_word(s, (i, len(s)))
    matches.make_automaton()
    compatible, pairs = pair_test(t), {}
    out, ids, byte = t["out"], t["ids"], t["byte"]
    size = [len(s) for s in t["names"]]
    known, find = pairs.get, matches.iter
    inner = set(t["inner"])

    def encode(s: str) -> list[int]:
        if len(s) == 1 and s not in inner:
            i = ids.get(s)
            return [i] if i is not None else [byte[b] for b in s.encode("utf-8", "replace")]
        last = [-1] * (len(s) + 1)
        for end, (piece, n) in find(s):
            end += 1
            if last[end] >= 0:
                continue
            if n == end:
                last[end] = piece
                continue
            p = last[end - n]
            ok = known(p << _SHIFT | piece)
            if ok is None:
                if len(pairs) >= MEMO_PAIRS:
                    pairs.clear()
                ok = pairs[p << _SHIFT | piece] = compatible(p, piece)
            if ok:
                last[end] = piece
        found, i = [], len(s)
        while i:
            found.append(last[i])
            i -= size[last[i]]
        if len(found) == 1:
            return out[found[0]]
        return [x for p in reversed(found) for x in out[p]]

    return encode


class _Memo(dict):
    """ids of chunks as little-endian 32-bit bytes; long chunks aren't kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, s: str) -> bytes:
        ids = array("I", self.encode(s)).tobytes()
        if len(s) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[s] = ids
        return ids


def text_encoder(t: dict):
    """Function from a text to its ids as little-endian 32-bit bytes."""
    if t["splits"]:  # marks and the run of one class behind them, marks alone, or any other character
        runs = "|".join(f"[{re.escape(c)}]+" for c in t["classes"])
        pattern = f"{MARK}*(?:{runs})|{MARK}+|."
    else:
        inner = re.escape(t["inner"])
        pattern = f"[{inner}]+|[^{inner}]"
    chunks = re.compile(pattern, re.DOTALL).findall
    memo = t.setdefault("memo", {})
    if not memo:
        memo["words"] = _Memo(word_encoder(t))
    ids = memo["words"].__getitem__

    def encode(text: str) -> bytes:
        return b"".join(map(ids, chunks(MARK + text.replace(" ", MARK)))) if text else b""

    return encode


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", end: bool = True) -> DataFrame:
    """``df`` with ``out``: the ids (array of int) of each whole text, the end id
    last if ``end``.

    Null and empty text: no ids but the end id. Repeated rows are encoded each;
    other columns pass through, one named ``out`` (in any case) is replaced. An
    empty table gives an empty result.
    """
    df = df.drop(*[c for c in df.columns if c.lower() == out.lower() and c != text])
    shared = df.sparkSession.sparkContext.broadcast(load(path))
    names = df.columns

    def run(batches):
        t = shared.value
        to_ids = text_encoder(t)
        tail = int(t["end"]).to_bytes(4, "little") if end else b""
        at = names.index(text)
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            for a, b in text_slices(texts, SLICE_BYTES):
                rows = [to_ids(x) + tail if x else tail for x in texts.slice(a, b - a).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(r) >> 2 for r in rows])]).astype(np.int32)
                ids = np.frombuffer(b"".join(rows), "<i4")
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, column], [*names, out])

    return df.mapInArrow(run, _ddl(df, f"`{out}` array<int>"))


def _each_bad_byte(e: UnicodeError):
    return "�" * (e.end - e.start), e.end


def _decoded(ids: np.ndarray, offsets: np.ndarray, tables: tuple) -> pa.Array:
    """Texts of lists of ids: byte runs are read as UTF-8, each byte that can't be
    is U+FFFD; the space put in front is taken off."""
    texts, spaced, silent = tables
    keep = (ids >= 0) & (ids < len(texts) - 1)
    code = np.where(keep, ids, len(texts) - 1)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts.take(pa.array(code))), b"")
    # the first id of a row that isn't silent: has it a space in front?
    loud = np.flatnonzero(~silent[code])
    first = np.searchsorted(loud, offsets[:-1])
    has = first < len(loud)
    place = loud[np.minimum(first, max(0, len(loud) - 1))] if len(loud) else np.zeros(len(first), np.int64)
    cut = has & (place < offsets[1:])
    if len(loud):
        cut &= spaced[code[place]]
    try:
        whole = joined.cast(pa.string())
    except pa.ArrowInvalid:
        codecs.register_error("each_bad_byte", _each_bad_byte)
        whole = pa.array([x.decode("utf-8", "each_bad_byte") for x in joined.to_pylist()], pa.string())
    return pc.if_else(pa.array(cut), pc.utf8_slice_codeunits(whole, 1), whole)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of each list of ids. Control ids are silent, an
    unknown id is the library's mark, ids outside the vocabulary and null ids add
    nothing; a null list: an empty text. A column named ``out`` is replaced."""
    df = df.drop(*[c for c in df.columns if c.lower() == out.lower() and c != ids])
    t = load(path)
    shared = df.sparkSession.sparkContext.broadcast((t["texts"], t["spaced"], t["silent"]))
    names = df.columns

    def run(batches):
        texts, spaced, silent = shared.value
        tables = (pa.array([*texts, b""], pa.binary()), np.array([*spaced, False]), np.array([*silent, True]))
        at = names.index(ids)
        for batch in batches:
            column = batch.column(at)
            size = max(1, 500_000 * len(column) // max(1, len(column.flatten())))
            for a in range(0, len(column), size):
                part = column.slice(a, size)
                part = pc.fill_null(part, []) if part.null_count else part
                flat = np.asarray(pc.fill_null(part.flatten(), -1)).astype(np.int64)
                offsets = np.asarray(part.offsets).astype(np.int64)
                decoded = _decoded(flat, offsets - offsets[0], tables)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, size).columns, decoded], [*names, out])

    return df.mapInArrow(run, _ddl(df, f"`{out}` string"))


def _ddl(df: DataFrame, added: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), added])


def op12(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text, decode the ids again, and report digests of both."""
    both = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
