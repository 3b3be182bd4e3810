"""BPE encoding and decoding with a tokenization automaton.

``compile_automaton`` turns an ordered merge list into a deterministic automaton
over token labels that accepts, for every string, exactly the token sequence
the merges produce. It starts from one state that loops on every symbol and
applies one merge gadget for each merge ``(u, v) -> uv``: the state entered by
``u`` is copied without its arc ``v``, all ``u`` arcs are redirected to the
copy, and every state with a ``u`` arc gets an arc ``uv`` to the state entered
by ``v``. All arcs with one label enter one state, so a state is named by the
label that enters it, and a copy is stored as "the state it was copied from,
minus one arc": one entry for each merge instead of a dense table.

Encoding a pre-split word is one left-to-right pass: every prefix has exactly
one accepted path, so the table keeps one state for each position and the next
position is found by looking for the one label that leaves an earlier state and
ends there. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import split_words, text_slices

#: Bounds of the per-task memo tables (entries); they only save time.
MEMO_WORDS, MEMO_PREFIXES, MEMO_ARCS, MEMO_PREFIX_LEN = 600_000, 400_000, 600_000, 24
SLICE_BYTES = 6_000_000
_FOREVER = 1 << 60
_SHIFT = 24


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level BPE files:
    the byte itself where it is printable, else the next free code from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    free = (b for b in range(256) if b not in table)
    return table | {b: chr(256 + i) for i, b in enumerate(free)}


def leaves(state: int, label: int, auto: dict) -> bool:
    """Has the state entered by label ``state`` an arc ``label``?

    ``removed[(y, x)]`` is the gadget that removed arc ``x`` from the state
    entered by ``y``. A state holds the removals of its own label and those of
    its right constituents made before it was copied; an arc exists where its
    left constituents existed when it was added.
    """
    removed, born, left, right = auto["removed"], auto["born"], auto["left"], auto["right"]
    y, before_y = state, _FOREVER
    while True:
        x, until_x = label, _FOREVER
        while True:
            k = removed.get(y << _SHIFT | x)
            if k is not None and k < before_y and k <= until_x:
                return False
            if left[x] < 0:
                break
            until_x, x = born[x], left[x]
        if right[y] < 0:
            return True
        before_y, y = born[y], right[y]


def compile_automaton(vocab: dict[str, int], merges: list[tuple[str, str]]) -> dict:
    """Automaton of a merge list as plain tables (small: one entry a merge), fit
    for a broadcast. A merge that can never apply adds nothing."""
    size = max(vocab.values()) + 1
    auto = {"removed": {}, "born": [0] * size, "left": [-1] * size, "right": [-1] * size}
    made = {a + b for a, b in merges}
    usable = {s for s in vocab if s not in made}
    for k, (a, b) in enumerate(merges, 1):
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        if a not in usable or b not in usable or not leaves(u, v, auto):
            continue
        auto["left"][w], auto["right"][w], auto["born"][w] = u, v, k
        auto["removed"][u << _SHIFT | v] = k
        usable.add(a + b)
    return auto | {"labels": {s: i for s, i in vocab.items() if s in usable}}


def load(path: str) -> dict:
    """Plain tables of a byte-level BPE tokenizer file (JSON): automaton, decoding
    labels, special tokens and the text of the file for its normalizer."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    spec = json.loads(raw)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    auto = compile_automaton(model["vocab"], merges)
    suffix = model.get("end_of_word_suffix") or ""
    labels = auto.pop("labels")
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    names = [""] * (max([*model["vocab"].values(), *special.values()]) + 1)
    for s, i in [*model["vocab"].items(), *special.items()]:
        names[i] = s
    inner = {s: i for s, i in labels.items() if not (suffix and s.endswith(suffix))}
    last = {s[: len(s) - len(suffix)]: i for s, i in labels.items() if s.endswith(suffix)}
    symbols = byte_symbols()
    return auto | {"inner": inner, "last": last, "names": names, "special": special, "file": raw,
                   "longest": max(map(len, [*inner, *last])), "symbols": [symbols[b] for b in range(256)]}


def reach(labels: dict[str, int], tail: int = 4) -> dict[str, int]:
    """Length of the longest label for each ending of ``tail`` symbols: no label
    of ``tail`` symbols or more ends otherwise."""
    out: dict[str, int] = {}
    for s in labels:
        if len(s) >= tail:
            out[s[-tail:]] = max(out.get(s[-tail:], 0), len(s))
    return out


def word_encoder(t: dict):
    """ids of one pre-split word given as byte symbols.

    The state after a prefix is the label that enters it. It is looked up by
    prefix (words share many) and filled in on demand: the one label that ends
    at the prefix's end and leaves the state of what stands before it.
    """
    inner, last, longest = t["inner"], t["last"], t["longest"]
    memo = t.setdefault("memo", {"arcs": {}, "prefixes": {}, "words": {}})
    arcs, prefixes = memo["arcs"], memo["prefixes"]
    inner_reach, last_reach = reach(inner).get, reach(last).get
    known, inner_get, last_get, seen = arcs.get, inner.get, last.get, prefixes.get

    def allowed(state: int, label: int) -> bool:
        if len(arcs) >= MEMO_ARCS:
            arcs.clear()
        r = arcs[state << _SHIFT | label] = leaves(state, label, t)
        return r

    def enter(prefix: str) -> int:
        """Label that enters the state after ``prefix``, shifted, and where it
        starts: one number, as millions of them are kept."""
        n = len(prefix)
        hit = inner_get(prefix)
        if hit is not None:
            hit <<= 5
        else:
            for j in range(max(1, n - inner_reach(prefix[-4:], 3)), n):
                x = inner_get(prefix[j:])
                if x is not None:
                    q = prefix[:j]
                    q = (seen(q) or enter(q)) >> 5
                    r = known(q << _SHIFT | x)
                    if r or r is None and allowed(q, x):
                        hit = x << 5 | j
                        break
        if len(prefixes) >= MEMO_PREFIXES:
            prefixes.clear()
        prefixes[prefix] = hit
        return hit

    def short(s: str) -> list[int]:
        x = last_get(s)
        if x is not None:  # a usable label is the accepted path of its own string
            return [x]
        n = len(s)
        for j in range(max(1, n - last_reach(s[-4:], 3)), n):
            x = last_get(s[j:])
            if x is not None:
                p = s[:j]
                e = seen(p) or enter(p)
                q = e >> 5
                r = known(q << _SHIFT | x)
                if r or r is None and allowed(q, x):
                    i = e & 31
                    if not i:
                        return [q, x]
                    out = [x, q]
                    while i:
                        e = seen(p := p[:i]) or enter(p)
                        i = e & 31
                        out.append(e >> 5)
                    out.reverse()
                    return out
        return []

    def long(s: str) -> list[int]:
        """The same pass with a table by position: no memory beyond it."""
        n = len(s)
        state, start = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            table = last if i == n else inner
            for j in range(max(0, i - longest), i):
                x = table.get(s[j:i])
                if x is None:
                    continue
                r = j == 0 or known(state[j] << _SHIFT | x)
                if r or r is None and allowed(state[j], x):
                    state[i], start[i] = x, j
                    break
        out, i = [], n
        while i > 0:
            out.append(state[i])
            i = start[i]
        out.reverse()
        return out

    return lambda s: short(s) if len(s) <= MEMO_PREFIX_LEN else long(s)


_PLAIN = regex.compile("[!-~À-ÖØ-öø-ÿ]*")
_PLAIN_SPLIT = regex.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def chunk_encoder(t: dict):
    """ids (little-endian 32-bit bytes) of a text without special tokens and
    without upper-case A-Z.

    A text of common letters is lower-cased and split here; any other text goes
    through the normalizer and pre-tokenizer that the file itself names.
    """
    encode = word_encoder(t)
    words, symbols = t["memo"]["words"], dict(enumerate(t["symbols"]))
    plain, find, own = _PLAIN.fullmatch, _PLAIN_SPLIT.findall, []

    def word(w: str) -> bytes:
        b = words.get(w)
        if b is None:
            if len(words) >= MEMO_WORDS:
                words.clear()
            s = w if w.isascii() else w.encode().decode("latin-1").translate(symbols)
            b = words[w] = array("I", encode(s)).tobytes()
        return b

    def ids(text: str) -> bytes:
        if text.isalpha() and text.isascii():
            return word(text)
        if plain(text):
            return b"".join(map(word, find(text.lower())))
        if not own:
            from tokenizers import Tokenizer
            own.append(Tokenizer.from_str(t["file"]))
        norm = own[0].normalizer.normalize_str(text)
        return b"".join(array("I", encode(w)).tobytes() for w, _ in own[0].pre_tokenizer.pre_tokenize_str(norm))

    return ids


def batch_encoder(t: dict):
    """Function from an Arrow text array to (offsets, ids): the ids of each whole
    text as the tokenizer file's own library gives them, special tokens added by
    nobody and recognised in the text. Null text: no ids."""
    word_ids = chunk_encoder(t)
    special = t["special"]
    marks = regex.compile("|".join(map(regex.escape, special))) if special else None

    def with_marks(text: str) -> np.ndarray:
        out, at = [], 0
        for m in marks.finditer(text):
            out += [word_ids(w.decode()) for w in text[at:m.start()].encode().lower().split()]
            out.append(np.array([special[m[0]]], "<u4").tobytes())
            at = m.end()
        out += [word_ids(w.decode()) for w in text[at:].encode().lower().split()]
        return np.frombuffer(b"".join(out), "<u4")

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        marked = np.zeros(len(texts), bool)
        for s in special:
            marked |= np.asarray(pc.match_substring(texts, s))
        plain = pc.if_else(pa.array(marked), pa.scalar("", texts.type), texts) if marked.any() else texts
        offsets, codes, distinct = split_words(plain)
        parts = [word_ids(w) for w in distinct.to_pylist()]
        lens = np.fromiter((len(p) >> 2 for p in parts), np.int64, len(parts))
        flat = np.frombuffer(b"".join(parts), "<u4")
        starts = np.cumsum(lens) - lens
        n = lens[codes]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.arange(total) - np.repeat(ends - n - starts[codes], n)] if total else np.zeros(0, "<u4")
        out = np.concatenate([[0], ends])[offsets]
        if marked.any():
            each = [with_marks(texts[i].as_py()) if marked[i] else ids[out[i]:out[i + 1]] for i in range(len(texts))]
            ids = np.concatenate(each)
            out = np.concatenate([[0], np.cumsum([len(e) for e in each])])
        return out, ids

    return encode


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the token ids (array of int) of each whole text.

    Null and empty text: an empty array. Other columns pass through as they
    are; a column named ``out`` is replaced. The tokenizer file is read once on
    the driver and broadcast (its size is fixed).
    """
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        to_ids = batch_encoder(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for a, b in text_slices(texts, SLICE_BYTES):
                offsets, ids = to_ids(texts.slice(a, b - a))
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, column], [*batch.schema.names, out])

    return df.mapInArrow(run, f"{_ddl(df)}, `{out}` array<int>" if df.columns else f"`{out}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the arc labels of the ids, joined by one space as the
    library joins them for a file without a decoder; special tokens stay. Ids
    outside the vocabulary add nothing; null ids: an empty text."""
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(load(path)["names"])

    def run(batches):
        names = pa.array([*shared.value, None], pa.string())
        known = len(names) - 1
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            size = max(1, 200_000 * len(column) // max(1, len(column.flatten())))
            for a in range(0, len(column), size):
                part = pc.fill_null(column.slice(a, size), []) if column.null_count else column.slice(a, size)
                flat = np.asarray(part.flatten())
                keep = (flat >= 0) & (flat < known)
                offsets = np.asarray(part.offsets) - part.offsets[0].as_py()
                labels = names.take(pa.array(np.where(keep, flat, known)))
                if not keep.all():
                    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
                    labels = labels.drop_null()
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), labels)
                text = pc.binary_join(lists, " ")
                yield pa.RecordBatch.from_arrays([*batch.slice(a, size).columns, text], [*batch.schema.names, out])

    return df.mapInArrow(run, f"{_ddl(df)}, `{out}` string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def op4(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text, decode the ids again, and report digests of both."""
    ids = encode(docs.select("doc_id", "text"), path).drop("text")
    both = decode(ids, path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
