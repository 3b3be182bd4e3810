"""Language-model scoring with a weighted backoff automaton.

Word, pair and triple counts come from all training documents. Every pair and triple
that occurs at least ``MIN_COUNT`` times is an arc of a deterministic automaton: a
state for each word and each such pair, arcs weighted with the discounted log
probability, and from each state a failure arc to its next shorter context, weighted
with the state's backoff. A text is read from left to right: an arc of the state that
is reached, else its failure arc and again, down to the root.

The automaton grows with the corpus and is nowhere whole. Texts are tokenised once,
into blocks (``BLOCK_BYTES`` of text). A block needs only the arcs of its own words,
so it asks for them: each of its distinct n-grams goes, with its count in the block's
training texts, to the bucket of its 64-bit hash; the bucket adds up the counts of all
blocks and answers every asker with the total. Four such exchanges carry words; pairs of
repeated words; triples of kept pairs, and what the followers of a word weigh; what the
followers of a pair weigh. An n-gram goes out once a block, so a very frequent one makes
as many entries as there are blocks, and buckets are cut by hash: their number grows with
the corpus, not their size. Asks and answers are packed arrays, one row a block and bucket.
What followers weigh travels as multiples of 2^-32, backoffs as multiples of 2^-27.

Then each block builds its part of the automaton and traverses its texts. The state
after a word depends on the last two words alone, so long texts are cut into stretches
(``STRETCH`` words) that find their state from the two words before them, and all
stretches of a block step together, a word at a time.

Words and triples are known by 56 bits of a hash: among n distinct ones, a count is
merged with another's with a probability of n / 2^56 (1 in 7 million at 10^10). The
answers to words number the repeated ones, and a pair of them is known by its two
numbers, exactly (beyond 2^28 numbers by a hash as above): the fewer words there are,
the shorter are the keys that travel.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, cut_lineage, split_words

#: An n-gram with fewer occurrences is no arc.
MIN_COUNT = 2
DISCOUNT = 0.5
#: Text of a block, tokens that a bucket stands for, words of a stretch.
BLOCK_BYTES, BUCKET_TOKENS, STRETCH = 10_000_000, 1_500_000, 512
#: The end token, and the start of a text as a context. No word holds a line break.
END, START = "\n", "\n\n"
#: Kinds of asks: counts of words, pairs and triples; followers of words and pairs.
WORD, PAIR, TRIPLE, AFTER_WORD, AFTER_PAIR = range(5)
_FIXED, _SHARE, _SPARE_BITS = float(1 << 27), float(1 << 32), 8
_ADDED = ("n_tokens", "n_known", "base_score", "score")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, bytes of equal weight together."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays)
    return np.array([len(raw), *map(len, arrays)], np.int64).tobytes() + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    head = np.frombuffer(blob, np.int64, len(types) + 1)
    if not head[0]:
        return [np.zeros(0, t) for t in types]
    raw = pa.decompress(blob[head.nbytes:], decompressed_size=int(head[0]), codec="zstd", asbytes=True)
    out, at = [], 0
    for n, t in zip(head[1:].tolist(), types):
        size = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += n * size
    return out


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a context's hash and a word's."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _spread(x: np.ndarray, bits: int) -> np.ndarray:
    """A permutation of the whole numbers below 2^bits, in the top bits of 64."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64(bits // 2)
    for odd in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        x = x * np.uint64(odd) & mask
        x = x ^ x >> half
    return x << np.uint64(64 - bits)


def tokenised(docs: DataFrame, train: Column, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, tokens, learned, docs, body): blocks of whole texts as word numbers. ``docs``
    holds the other columns, ``learned`` counts the tokens of training texts."""
    kept = [c for c in docs.columns if c != text and c.lower() not in _ADDED]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias("_text"),
                       F.coalesce(train, F.lit(False)).alias("_train"))
    at = len(kept)

    def run(batches):
        number, digest = TaskContext.get().partitionId() << 32, xxhash.xxh3_64_intdigest
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column(at).nbytes
            ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)).astype(np.int64) + 1)
            pieces = -(-size // block_bytes)
            cuts = np.unique(np.searchsorted(ends, ends[-1] * np.arange(1, pieces + 1) / pieces) + 1) if pieces else []
            for a, b in zip([0, *cuts[:-1]], cuts):
                part, n = batch.slice(a, b - a), b - a
                offsets, codes, distinct = split_words(part.column(at))
                hashes = np.fromiter((digest(w.encode()) for w in distinct.to_pylist()), np.uint64, len(distinct))
                # frequent words get small numbers, equally frequent ones stand by hash: both pack well
                order = np.lexsort((hashes, -np.bincount(codes, minlength=len(distinct))))
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                codes = rank[codes]
                hashes = np.append(hashes[order], np.array([digest(START.encode()), digest(END.encode())], np.uint64)) >> np.uint64(_SPARE_BITS)
                lens = np.diff(offsets) + 2
                seq = np.full(len(codes) + 2 * n, len(distinct) + 1, np.int32)
                seq[np.arange(len(codes)) + 2 * np.repeat(np.arange(n), lens - 2) + 1] = codes
                seq[np.cumsum(lens) - lens] = len(distinct)
                taught = np.asarray(part.column(at + 1).cast(pa.uint8()))
                others = pa.RecordBatch.from_arrays([part.column(i) for i in range(at)], kept) if at else pa.record_batch({})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, others.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(others)
                learned = int((lens - 1)[taught > 0].sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in ((number, pa.int64()), (int(lens.sum()) - n, pa.int64()), (learned, pa.int64()),
                                                   (sink.getvalue().to_pybytes(), pa.binary()),
                                                   (_pack(np.diff(hashes, prepend=np.uint64(0)), seq, lens.astype(np.int32), taught), pa.binary()))],
                    ["block", "tokens", "learned", "docs", "body"])
                number += 1

    return rows.mapInArrow(run, "block long, tokens long, learned long, docs binary, body binary")


class Block:
    """A block's n-grams, numbered as they appear, and the answers that it has got.
    ``number_bits``: bits of the numbers of repeated words (0: pairs go by hash)."""

    def __init__(self, body: bytes, got: list | None = None, number_bits: int = 0):
        self.number_bits = number_bits
        steps, seq, lens, taught = _unpack(body, np.uint64, np.int32, np.int32, np.uint8)
        self.hashes = np.cumsum(steps, dtype=np.uint64) << np.uint64(_SPARE_BITS)
        self.seq, self.lens = seq, lens.astype(np.int64)
        self.width = len(self.hashes)
        self.taught = np.repeat(taught > 0, lens)
        doc = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        self.inside = doc[1:] == doc[:-1]
        self.answers: dict[int, list[bytes]] = {}
        for part in sorted(got or [], key=lambda r: (r["kind"], r["bucket"])):
            self.answers.setdefault(part["kind"], []).append(part["payload"])

    def _answer(self, kind: int, keys: np.ndarray, as_type=np.int64, nth: int = 0) -> np.ndarray:
        """Answers of a kind, which stand in the order of their keys."""
        types = [np.int64, np.int64] if kind == WORD else [as_type]
        got = [_unpack(p, *types)[nth] for p in self.answers.get(kind, [])]
        out = np.zeros(len(keys), as_type)
        if got:
            out[np.argsort(keys, kind="stable")] = np.concatenate(got)
        return out

    def words(self) -> np.ndarray:
        """Occurrences of each word in the block's training texts."""
        return np.bincount(self.seq[self.taught], minlength=self.width)

    def pairs(self) -> None:
        """Pairs of words that both repeat in the corpus: no other pair does."""
        self.word_total = self._answer(WORD, self.hashes) >> 1
        self.often = self.word_total >= MIN_COUNT
        at = np.flatnonzero(self.inside & self.often[self.seq[:-1]] & self.often[self.seq[1:]])
        number, pairs = pd.factorize(self.seq[at].astype(np.int64) * self.width + self.seq[at + 1])
        self.a, self.b = pairs // self.width, pairs % self.width
        self.pair = np.full(len(self.seq), -1, np.int32)
        self.pair[at] = number
        self.pair_count = np.bincount(number[self.taught[at]], minlength=len(pairs))
        if self.number_bits:
            number = self._answer(WORD, self.hashes, nth=1).astype(np.uint64)
            self.pair_keys = _spread(number[self.a] << np.uint64(self.number_bits) | number[self.b], 2 * self.number_bits)
        else:
            self.pair_keys = _mixed(self.hashes[self.a], self.hashes[self.b])

    def counted(self) -> None:
        """Corpus counts of pairs; the kept pairs, renumbered."""
        self.pairs()
        total = self._answer(PAIR, self.pair_keys)
        kept = np.flatnonzero(total)
        place = np.full(len(total) + 1, -1, np.int32)  # the last one: not a pair
        place[kept] = np.arange(len(kept))
        self.pair = place[self.pair]
        self.a, self.b, self.pair_keys = self.a[kept], self.b[kept], self.pair_keys[kept]
        self.pair_total, self.pair_owned = total[kept] >> 1, (total[kept] & 1).astype(bool)

    def triples(self) -> None:
        """Triples of kept pairs: their first pair, last pair, last word."""
        at = np.flatnonzero((self.pair[:-1] >= 0) & (self.pair[1:] >= 0))
        number, triples = pd.factorize(self.pair[at].astype(np.int64) * self.width + self.seq[at + 2] if len(at) else np.zeros(0, np.int64))
        self.first, self.last_word = triples // self.width, triples % self.width
        self.second = np.zeros(len(triples), np.int64)
        self.second[number] = self.pair[at + 1]
        self.triple_count = np.bincount(number[self.taught[at]], minlength=len(triples))
        self.triple_keys = _mixed(self.pair_keys[self.first], self.hashes[self.last_word])
        self.triple_at, self.triple = at.astype(np.int32), number.astype(np.int32)

    def weighed(self) -> None:
        """Corpus counts of triples; the kept ones."""
        self.triples()
        total = self._answer(TRIPLE, self.triple_keys)
        arc = np.zeros(len(self.seq), bool)
        arc[self.triple_at[total[self.triple] > 0]] = True
        fails = (self.pair[:-2] >= 0) & self.inside[1:] & ~arc[:-2]
        self.fails = np.zeros(len(self.a), bool)
        self.fails[self.pair[:-2][fails]] = True
        kept = np.flatnonzero(total)
        self.first, self.second, self.last_word = self.first[kept], self.second[kept], self.last_word[kept]
        self.triple_total, self.triple_owned = total[kept] >> 1, (total[kept] & 1).astype(bool)
        del self.triple_at, self.triple, self.triple_keys, self.triple_count

    def contexts(self) -> np.ndarray:
        """Pairs whose failure arc is taken here, or about whose followers the block reports."""
        mask = self.fails.copy()
        mask[self.first[self.triple_owned]] = True
        return np.flatnonzero(mask)


def _parts(kind: int, keys: np.ndarray, buckets: int, *values: np.ndarray):
    """(kind, bucket, payload) of keys and their values, in the order of the keys."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], [v[order] for v in values]
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    keys = keys >> np.uint64(_SPARE_BITS)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, np.int64)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
        yield kind, int(bucket[a]), _pack(np.diff(keys[a:b], prepend=np.uint64(0)), *(v[a:b] for v in values))


def _followers(whole: np.ndarray, kept: np.ndarray, lower: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """What a block reports of the contexts ``at``, in whole numbers."""
    kept = np.rint(kept[at] / DISCOUNT).astype(np.int64)
    return [np.where(kept > 0, whole[at], 0), kept, np.rint(lower[at] * _SHARE).astype(np.int64)]


def _backoff(kept: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(1.0 - kept, 1e-9) / np.maximum(1.0 - lower, 1e-9))


def _reply(kind: int, blobs: list[bytes], least: int, bucket: int = 0, buckets: int = 1):
    """Answer to each blob of one bucket, and how many n-grams it is the first to name.
    Answers to words also number the repeated ones, frequent ones first."""
    counts = kind <= TRIPLE
    types = [np.uint64] + [np.int64] * (1 if counts else 3)
    parts = [_unpack(b, *types) for b in blobs]
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    values = [np.concatenate(c) for c in list(zip(*parts))[1:]]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    sums = [np.add.reduceat(v[order], first) for v in (values if counts else values[1:])]
    if counts:
        total = np.where(sums[0] >= least, sums[0], 0)
        answer = 2 * total[group] + (new & (total[group] > 0))  # the low bit: first to name it
    else:
        whole = np.maximum(np.maximum.reduceat(values[0][order], first), 1)
        back = np.where(sums[0] > 0, _backoff(sums[0] * DISCOUNT / whole, sums[1] / _SHARE), 0.0)
        answer = np.rint(back * _FIXED).astype(np.int32)[group]
    columns = [answer]
    if kind == WORD:
        number, repeated = np.zeros(len(total), np.int64), np.flatnonzero(total >= MIN_COUNT)
        number[repeated[np.argsort(-total[repeated], kind="stable")]] = np.arange(len(repeated)) * buckets + bucket
        columns.append(number[group])
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    back_to = np.argsort(order)
    for each in zip(*(np.split(c[back_to], cuts) for c in columns)):
        yield _pack(*each), int((each[0] & 1).sum()) if counts else 0


def _by_block(df: DataFrame, parts: int) -> DataFrame:
    """``df`` written by block: a later join on the block moves none of its rows again.
    An adaptive plan wouldn't tell how its rows are dealt."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut_lineage(df.repartition(parts, "block"))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def exchange(blocks: DataFrame, ask: Callable, buckets: int, number_bits: int = 0) -> DataFrame:
    """(block, kind, bucket, fresh, largest, payload): the answers to what ``ask(block)``
    yields. The first answer that names an n-gram of the training texts counts it in
    ``fresh``; ``largest`` is the largest number that it gives to a word."""

    def asked(row):
        asks = list(ask(_block(row, number_bits)))
        kinds, to, payloads = zip(*asks) if asks else ((), (), ())
        return pa.table([pa.array([row.column("block")[0].as_py()] * len(kinds), pa.int64()), pa.array(kinds, pa.int32()),
                         pa.array(to, pa.int64()), pa.array(payloads, pa.binary())], ["block", "kind", "bucket", "payload"])

    def replies(held):
        kind, bucket = held[0][1:3]
        given = _reply(kind, [h[3] for h in held], 1 if kind == WORD else MIN_COUNT, bucket, buckets)
        for (number, *_), (payload, fresh) in zip(held, given):
            largest = int(_unpack(payload, np.int64, np.int64)[1].max(initial=0)) if kind == WORD else 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([kind], pa.int32()), pa.array([bucket]), pa.array([fresh]), pa.array([largest]),
                 pa.array([payload], pa.binary())], ["block", "kind", "bucket", "fresh", "largest", "payload"])

    def answered(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][1:3] != row[1:3]:
                    yield from replies(held)
                    held = []
                held.append(row)
        if held:
            yield from replies(held)

    asks = blocks.groupBy("block").applyInArrow(asked, "block long, kind int, bucket long, payload binary")
    dealt = asks.repartition(buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket", "block")
    return dealt.mapInArrow(answered, "block long, kind int, bucket long, fresh long, largest long, payload binary")


def _with_answers(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    for i, part in enumerate(answers):
        each = part.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "payload")).alias(f"got{i}"))
        blocks = blocks.join(each.hint("merge"), "block", "left")  # answers grow with the corpus: no broadcast
    return blocks


def _block(row: pa.Table, number_bits: int) -> Block:
    """A task's blocks come one by one, as groups, so their number doesn't matter to its memory."""
    got = [x for name in row.column_names if name.startswith("got") for x in row.column(name)[0].as_py() or []]
    return Block(row.column("body")[0].as_py(), got, number_bits)


def automaton(block: Block, tokens: int, distinct: int) -> dict:
    """The block's part of the automaton. State 0 is the root, then come its words, then
    its kept pairs. An arc's key is its state times the number of words, plus its word."""
    width, c, whole = block.width, block.word_total, max(tokens + distinct, 1)
    pairs = 1 + width + np.arange(len(block.a))
    back = np.zeros(1 + width + len(pairs))
    often, followed = np.flatnonzero(block.often), block.contexts()
    back[1 + often] = block._answer(AFTER_WORD, block.hashes[often], np.int32) / _FIXED
    back[pairs[followed]] = block._answer(AFTER_PAIR, block.pair_keys[followed], np.int32) / _FIXED
    keys = np.concatenate([[-1], (1 + block.a) * width + block.b, pairs[block.first] * width + block.last_word])
    weights = np.concatenate([[0.0], np.log10((block.pair_total - DISCOUNT) / np.maximum(c[block.a], 1)),
                              np.log10((block.triple_total - DISCOUNT) / block.pair_total[block.first])])
    to = np.concatenate([[0], pairs, pairs[block.second]])
    order = np.argsort(keys)
    return {"width": width, "keys": keys[order], "weights": weights[order], "to": to[order], "back": back,
            "fail": np.concatenate([np.zeros(1 + width, np.int64), 1 + block.b]),
            "root": np.log10(np.where(c > 0, c, max(distinct, 1)) / whole)}


def step(t: dict, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after a word each, and the weights of the arcs and failure arcs taken."""
    weight, after = np.zeros(len(state)), 1 + word.astype(np.int64)
    open_ = np.flatnonzero(state)
    state = state[open_]
    weight_of_root = np.ones(len(word), bool)
    while len(open_):
        key = state * t["width"] + word[open_]
        at = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
        hit = t["keys"][at] == key
        done, arc = open_[hit], at[hit]
        weight[done] += t["weights"][arc]
        after[done] = t["to"][arc]
        weight_of_root[done] = False
        open_, state = open_[~hit], state[~hit]
        weight[open_] += t["back"][state]
        state = t["fail"][state]
        open_, state = open_[state > 0], state[state > 0]
    weight[weight_of_root] += t["root"][word[weight_of_root]]
    return after, weight


def traverse(t: dict, seq: np.ndarray, lens: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Weight of each text's path from its start state. ``seq`` holds the texts' words one
    text after the other, each with START before and END behind; ``lens`` their lengths."""
    first = np.cumsum(lens) - lens
    cuts = -(-(lens - 1) // stretch)
    of = np.repeat(np.arange(len(lens)), cuts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = first[of] + 1 + nth * stretch
    size = np.minimum(stretch, first[of] + lens[of] - begin)
    order = np.argsort(-size, kind="stable")
    of, begin, size, nth = of[order], begin[order], size[order], nth[order]
    state = 1 + seq[begin - 1].astype(np.int64)
    later = np.flatnonzero(nth)
    state[later], _ = step(t, 1 + seq[begin[later] - 2].astype(np.int64), seq[begin[later] - 1])
    total = np.zeros(len(of))
    for i in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -i, side="left"))
        state[:n], weight = step(t, state[:n], seq[begin[:n] + i])
        total[:n] += weight
    return np.bincount(of, weights=total, minlength=len(lens))


def score_corpus(docs: DataFrame, train: Column, text: str = "text", block_bytes: int = BLOCK_BYTES,
                 bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, n_known, train_tokens, base_score and
    score; the rows where ``train`` holds teach.

    A null or empty text is its end token. Equal rows get their own result each, columns
    named like the added ones are replaced, an empty table gives an empty result.
    Without a training row every word is unseen. A text stays whole in its block.
    """
    docs = docs.drop("train_tokens")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _by_block(tokenised(docs, train, text, block_bytes), parts)
    all_tokens, tokens = (x or 0 for x in blocks.agg(F.sum("tokens"), F.sum("learned")).first())
    buckets = max(spark.sparkContext.defaultParallelism, -(-all_tokens // bucket_tokens))

    bodies, answers = blocks.select("block", "body"), []

    def ask_words(block: Block):
        yield from _parts(WORD, block.hashes, buckets, block.words())

    answers.append(_by_block(exchange(bodies, ask_words, buckets), parts))
    named, largest = (x or 0 for x in answers[0].agg(F.sum("fresh"), F.max("largest")).first())
    distinct = max(0, named - 1)  # START is no token
    bits = max(1, largest.bit_length())
    bits = bits if 2 * bits <= 64 - _SPARE_BITS else 0

    def ask_pairs(block: Block):
        block.pairs()
        yield from _parts(PAIR, block.pair_keys, buckets, block.pair_count)

    answers.append(_by_block(exchange(_with_answers(bodies, answers), ask_pairs, buckets, bits), parts))
    whole = max(tokens + distinct, 1)

    def ask_triples(block: Block):
        block.counted()
        block.triples()
        yield from _parts(TRIPLE, block.triple_keys, buckets, block.triple_count)
        mine = block.pair_owned
        a, b = block.a[mine], block.b[mine]
        kept = np.bincount(a, weights=block.pair_total[mine] - DISCOUNT, minlength=block.width)
        lower = np.bincount(a, weights=block.word_total[b] / whole, minlength=block.width)
        at = np.flatnonzero(block.often)
        yield from _parts(AFTER_WORD, block.hashes[at], buckets, *_followers(block.word_total, kept, lower, at))

    answers.append(_by_block(exchange(_with_answers(bodies, answers), ask_triples, buckets, bits), parts))

    def ask_followers(block: Block):
        block.counted()
        block.weighed()
        mine = block.triple_owned
        first, second = block.first[mine], block.second[mine]
        n = len(block.a)
        kept = np.bincount(first, weights=block.triple_total[mine] - DISCOUNT, minlength=n)
        p = (block.pair_total[second] - DISCOUNT) / np.maximum(block.word_total[block.a[second]], 1)
        lower = np.bincount(first, weights=p, minlength=n)
        at = block.contexts()
        yield from _parts(AFTER_PAIR, block.pair_keys[at], buckets, *_followers(block.pair_total, kept, lower, at))

    answers.append(exchange(_with_answers(bodies, answers), ask_followers, buckets, bits))
    kept = [c for c in docs.columns if c != text and c.lower() not in _ADDED]
    norm = math.log10(tokens + distinct + 1)

    def run(row):
        block = _block(row, bits)
        block.counted()
        block.weighed()
        t = automaton(block, tokens, distinct)
        del block.pair, block.inside, block.taught, block.answers, block.a, block.b, block.pair_keys
        path = traverse(t, block.seq, block.lens)
        del t
        c, n = block.word_total[block.seq], block.lens - 1
        first = np.cumsum(block.lens) - block.lens
        c[first] = 0  # START is no token
        base = np.add.reduceat(np.log10(c + 1.0), first) - n * norm
        got_known = np.add.reduceat((c > 0).astype(np.int64), first)
        with pa.ipc.open_stream(row.column("docs")[0].as_buffer()) as stream:
            (part,) = stream
        return pa.table([*part.columns, pa.array(n), pa.array(got_known), pa.array(np.full(len(n), tokens)),
                         pa.array(base), pa.array(path)], [*kept, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in kept]).schema.fields]
    return _with_answers(blocks.select("block", "docs", "body"), answers).groupBy("block").applyInArrow(
        run, ", ".join([*fields, "n_tokens long, n_known long, train_tokens long, base_score double, score double"]))


def op7(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of all documents; those whose crc32(doc_id) mod ``folds`` is ``held``
    (or whose doc_id is null) teach nothing."""
    fold = F.coalesce(crc_fold("doc_id", folds), F.lit(held))
    return score_corpus(docs.select("doc_id", "text"), fold != held).select(
        "doc_id", (fold == held).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
