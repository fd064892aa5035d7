"""Best-fit packing of token sequences with Martello-Toth dominance reduction.

Pieces of one length can stand for one another, so the instance is a count for each length from 1 to the
capacity: a table whose size does not depend on the corpus. On it

1. the reduction fixes sequences that some best packing must hold. For the longest unplaced length, a set
   with it dominates all others if it fills the sequence exactly with one partner; or is the length alone
   when nothing fits beside it; or with the longest fitting partner when no two others fit together; or with
   the longest fitting partner when that is at least as long as any fitting two and no three fit;
2. best fit places what remains, longest first, each into the fullest open sequence that takes it.

The result is a list of patterns (lengths in a sequence) with multiplicities, and from that, for each length,
ranges of ranks with their sequence and offset. Ranks of the pieces come from counts per (length, share),
with the shares of a length dealt out by hash, so a length that a third of all pieces have is no single task.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import materialize, table, texts
from valuemark.llm.encoders import encoder

CAPACITY = 2048
SHARE_ROWS = 20_000

Pattern = tuple[tuple[int, ...], int]


def _largest(counts: np.ndarray, most: int) -> int:
    """The greatest length up to ``most`` with a piece left, or 0."""
    found = np.flatnonzero(counts[1 : most + 1])
    return int(found[-1]) + 1 if len(found) else 0


def _best_two(counts: np.ndarray, room: int) -> int:
    """The greatest sum of two pieces within ``room``, or 0."""
    sizes = np.flatnonzero(counts[: room + 1])
    best, hi = 0, len(sizes) - 1
    for lo in range(len(sizes)):
        while hi >= lo and sizes[lo] + sizes[hi] > room:
            hi -= 1
        if hi < lo:
            break
        k = hi if hi > lo or counts[sizes[lo]] > 1 else -1
        if k >= 0:
            best = max(best, int(sizes[lo] + sizes[k]))
    return best


def _smallest_sum(counts: np.ndarray, n: int) -> int:
    """Sum of the n smallest pieces, or a number beyond every capacity when there are fewer."""
    total = 0
    for size in np.flatnonzero(counts):
        take = min(n, int(counts[size]))
        total += take * int(size)
        n -= take
        if not n:
            return total
    return 1 << 40


def reduced(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fix dominating sets, longest piece first; ``counts`` keeps what stays open.

    A rule that holds goes on holding while its partner lasts, since sums of the smallest pieces only rise and
    the best two only fall as pieces leave. So each set is fixed as often as its pieces allow at once, and there
    are at most two patterns a length, however many pieces there are.
    """
    fixed: list[Pattern] = []

    def fix(sizes: tuple[int, ...], times: int) -> None:
        fixed.append((sizes, times))
        for s in sizes:
            counts[s] -= times

    changed = True
    while changed:
        changed = False
        for size in range(capacity, 0, -1):
            while counts[size]:
                rest = counts.copy()
                rest[size] -= 1
                room = capacity - size
                partner = _largest(rest, room)
                most = int(counts[size]) // 2 if partner == size else int(min(counts[size], counts[partner]))
                if not partner:  # nothing fits beside it
                    fix((size,), 1 if size <= room else int(counts[size]))
                elif partner == room:  # an exact pair
                    fix((size, partner), most)
                elif _smallest_sum(rest, 2) > room:  # at most one fits
                    fix((size, partner), most)
                elif _smallest_sum(rest, 3) > room and partner >= _best_two(rest, room):  # at most two fit, one is better
                    fix((size, partner), most)
                else:
                    break
                changed = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Longest first, each piece into the fullest open sequence with room; equal sequences are handled at once."""
    open_: dict[int, list[list]] = {}  # room -> [pattern, times]
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            room = min((r for r in open_ if r >= size), default=None)
            if room is None:
                each = capacity // size
                full, extra = divmod(left, each)
                for k, times in ((each, full), (extra, 1)):
                    if k and times:
                        open_.setdefault(capacity - k * size, []).append([(size,) * k, times])
                break
            pattern, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
            each = room // size
            full = min(times, left // each)
            if full:
                open_.setdefault(room - each * size, []).append([pattern + (size,) * each, full])
                left -= full * each
            if full < times and left:
                open_.setdefault(room - left * size, []).append([pattern + (size,) * left, 1])
                full, left = full + 1, 0
            if full < times:
                open_.setdefault(room, []).append([pattern, times - full])
    return [(p, t) for parts in open_.values() for p, t in parts]


def plan(counts: np.ndarray, capacity: int) -> list[Pattern]:
    counts = counts.astype("i8").copy()
    fixed = reduced(counts, capacity)
    return fixed + best_fit(counts, capacity)


def places(patterns: list[Pattern], capacity: int) -> list[tuple[np.ndarray, ...]]:
    """For each length: starts of its rank ranges, first sequence of each range, offset in the sequence."""
    found: list[list] = [[] for _ in range(capacity + 1)]
    ranks, sequence = [0] * (capacity + 1), 0
    for sizes, times in patterns:
        offset = 0
        for s in sizes:
            found[s].append((ranks[s], sequence, offset))
            ranks[s] += times
            offset += s
        sequence += times
    return [tuple(np.array(c, "i8") for c in zip(*f)) if f else (np.zeros(0, "i8"),) * 3 for f in found]


def _placed(batches, book):
    found = book.value
    for b in batches:
        length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
        sequence, offset = np.zeros(len(length), "i8"), np.zeros(len(length), "i8")
        for size in np.unique(length):
            own = length == size
            starts, first, at = found[size]
            k = np.searchsorted(starts, rank[own], "right") - 1
            sequence[own], offset[own] = first[k] + rank[own] - starts[k], at[k]
        keep = [b.column(i) for i, n in enumerate(b.schema.names) if n != "rank"]
        names = [n for n in b.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every row of ``pieces`` (with doc_id, piece and length from 1 to ``capacity``) with its sequence_id and offset.

    ``pieces`` should be a written table; other columns are carried along. No rows give no rows.
    """
    spark = pieces.sparkSession
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    counted = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, "i8")
    for r in counted:
        counts[r.length] = r["count"]
    shares = max(1, -(-int(counts.sum()) // SHARE_ROWS))
    share = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares))
    sizes = pieces.groupBy("length", share.alias("share")).agg(F.count("*").alias("n"))
    before = sizes.select("length", "share", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "share").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("share", share).withColumn("nth", F.row_number().over(own)).join(before, ["length", "share"])
    ranked = ranked.select(*[F.col(c) for c in pieces.columns], (F.col("before") + F.col("nth") - 1).alias("rank"))
    book = spark.sparkContext.broadcast(places(plan(counts, capacity), capacity))
    return ranked.mapInArrow(functools.partial(_placed, book=book), f"{kinds}, sequence_id long, offset long")


def _cut(batches, tokenizer: str, end_id: int, capacity: int, with_ids: bool):
    enc = encoder(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    for b in batches:
        rows = []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            ids = enc.ids(text) + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                rows.append((doc_id, piece, at // 4, len(part) // 4, part if with_ids else zlib.crc32(part)))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary() if with_ids else pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], ["doc_id", "piece", "start", "length", "ids" if with_ids else "ids_crc32"])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length and ids (binary, little-endian u32; or only their crc32) of every document's pieces.

    A document's ids end with ``end_id``, so a null or empty text has one piece of length 1. Rows that repeat
    an id are documents of their own.
    """
    last = "ids binary" if with_ids else "ids_crc32 long"
    return texts(docs).mapInArrow(functools.partial(_cut, tokenizer=tokenizer, end_id=end_id, capacity=capacity, with_ids=with_ids), f"doc_id long, piece int, start long, length long, {last}")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places; texts are encoded once, the pieces are a written table."""
    return pack(materialize(token_pieces(docs, tokenizer, 0, capacity, with_ids), "pieces"), capacity)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), CAPACITY, with_ids=False)
