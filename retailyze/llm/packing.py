"""Sum-of-squares packing of token sequences.

Documents become pieces of at most ``capacity`` tokens; only longer documents
are cut. A piece of length s goes into the open bin (or a new one) for which the
sum over residual gaps of (number of open bins with that gap) squared becomes
smallest: with N(g) bins of gap g, moving one from g to g - s changes the sum by
``1 - 2 N(g) + 1 + 2 N(g - s)``, filling one up exactly by ``1 - 2 N(g)``, opening
one by ``1 + 2 N(capacity - s)``. Ties go to the smallest gap. Pieces are placed in
decreasing length.

Pieces are dealt into blocks of a bounded number of rows, each packed by one
task; what stands in bins that a block left poorly filled is dealt again into
fewer blocks, round by round, so the open ends of many blocks close each other.
Only ids and lengths move, never texts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import cut_lineage, text_slices
from .textstats import fresh

CAPACITY = 4096
#: Rows of a block (a task's memory), fill below which a bin is packed again, rounds.
BLOCK_ROWS, GOOD_FILL, ROUNDS = 8192, 0.998, 4


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32.

    A document's ids are its tokens and then ``end_id``, so a null or empty text
    is one piece of length 1. A key that occurs twice is two documents. An empty
    table gives no pieces.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bpe.load(path))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        to_ids = bpe.batch_encoder(shared.value)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in text_slices(texts, bpe.SLICE_BYTES):
                offsets, ids = to_ids(texts.slice(a, b - a))
                raw, rows = memoryview(np.ascontiguousarray(ids)).cast("B"), []
                for i in range(b - a):
                    first, stop = 4 * int(offsets[i]), 4 * int(offsets[i + 1])
                    for k, at in enumerate(range(first, stop + 1, 4 * capacity)):
                        part = raw[at:min(at + 4 * capacity, stop)]
                        last = len(part) < 4 * capacity  # the end id has room here
                        crc = zlib.crc32(end, zlib.crc32(part)) if last else zlib.crc32(part)
                        rows.append((a + i, k, (at - first) >> 2, (len(part) >> 2) + last, crc))
                row, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)], names)

    return docs.mapInArrow(run, f"doc_id {key_type}, piece int, start long, length long, ids_crc32 long")


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of each length (1 to capacity), and each bin's fill."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_bins = np.zeros(capacity + 1, np.int64)  # N(g); N(0) stays 0: full bins don't count
    members: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    never = np.int64(1) << 60
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        change = np.where(open_bins[s:capacity] > 0, 2 * open_bins[:capacity - s] - 2 * open_bins[s:capacity] + 2, never)
        if len(change):
            change[0] -= 1  # an exact fit leaves no open bin behind
        g = s + int(change.argmin()) if len(change) else capacity
        if not len(change) or change[g - s] > (2 * open_bins[capacity - s] + 1 if s < capacity else 0):
            g, b = capacity, len(fill)
            fill.append(0)
        else:
            b = members[g].pop()
            open_bins[g] -= 1
        bins[i], offsets[i] = b, fill[b]
        fill[b] += s
        if g > s:
            members[g - s].append(b)
            open_bins[g - s] += 1
    return bins, offsets, np.array(fill, np.int64)


def _block_packer(kept: list[str], length: str, fill_name: str, capacity: int, level: int):
    def run(key, pdf):
        bins, offsets, fill = pack_lengths(pdf[length].to_numpy(np.int64), capacity)
        first = (level << 56) + (int(key[0]) << 32)
        return pdf[kept].assign(**{"sequence_id": first + bins, "offset": offsets, fill_name: fill[bins]})

    return run


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS,
         good_fill: float = GOOD_FILL, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with sequence_id and offset (gapless from 0 in each sequence).

    ``length`` must be 1 to ``capacity``; equal rows are packed each for itself,
    ties in length go by row order. Input columns named like the two added ones are
    replaced, all others stay. An empty table gives an empty result. ``pieces`` is
    read once, before this returns.
    """
    pieces = pieces.drop("sequence_id", "offset")
    uid, filled, block = fresh(pieces, "_uid", "_fill", "_block")
    tagged = cut_lineage(pieces.withColumn(uid, F.monotonically_increasing_id()))
    kept = tagged.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.schema.fields)
    schema += f", sequence_id long, offset long, `{filled}` long"
    todo, done, n = tagged, [], tagged.count()
    for r in range(rounds):
        blocks = max(1, -(-n // block_rows))

        run = _block_packer(kept, length, filled, capacity, r)
        dealt = todo.withColumn(block, F.pmod(F.xxhash64(uid, F.lit(r)), F.lit(blocks)))
        packed = dealt.groupBy(block).applyInPandas(run, schema)
        if blocks == 1 or r == rounds - 1:
            done.append(packed)
            break
        packed = cut_lineage(packed)
        good = F.col(filled) >= int(good_fill * capacity)
        done.append(packed.where(good))
        todo = packed.where(~good).select(*[F.col(f"`{c}`") for c in kept])
        n = todo.count()
        if not n:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop(uid, filled)


def op1(docs: DataFrame, path: str) -> DataFrame:
    """All pieces of all documents, packed."""
    return pack(token_pieces(docs, path)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
