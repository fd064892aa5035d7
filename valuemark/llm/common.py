"""What several corpus operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Hashable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.session import discard, fresh_path, materialize, shared_dir, table

__all__ = ["discard", "fresh_path", "held_out", "kept_rows", "laid_out", "materialize", "row_starts", "shared_dir", "sliced", "table", "texts", "unused", "worker_state"]


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text, null text as empty; other columns, whatever their names, are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened until no column has them, whatever its case."""
    taken, found = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        found.append(n)
    return found


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def task_count(spark: SparkSession, total: int, each: int) -> int:
    return max(1, -(-total // each))


_STATE: dict[str, Any] = {}


def worker_state(owner: Hashable, make: Callable[[], Any] | None = None) -> Any:
    """What a Python worker keeps from task to task (a cache, a tokenizer), made when first asked for.

    Workers outlive the stages of a job. Only the last owner's state stays: the first task of another one gives
    the memory back, so that stages of a pipeline do not add up.
    """
    if _STATE.get("owner") != owner:
        had = "value" in _STATE
        _STATE.clear()
        _STATE["owner"] = owner
        if had:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass
    if make and "value" not in _STATE:
        _STATE["value"] = make()
    return _STATE.get("value")


def sliced(batches, rows: int = 256):
    """Arrow batches cut down, so that a task holds the Python strings of few texts at a time; for tasks that keep no state."""
    worker_state(None)
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def laid_out(lists: pa.Array, numbers: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Rows of words as rows of their unsigned 32-bit numbers, each different word looked up once.

    ``numbers`` gives the numbers of each of a list of different words. Returned are all rows' numbers one after the other, where
    each row begins (and the last one ends), the place of each word in the list of different ones, and that list.
    """
    coded = lists.flatten().dictionary_encode()
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    parts = numbers(words)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    first, n = np.cumsum(size) - size, size[at]
    ends = np.concatenate([[0], np.cumsum(n)])
    flat = np.frombuffer(b"".join(parts), "<u4")[np.repeat(first[at] - ends[:-1], n) + np.arange(ends[-1])]
    return flat, ends[row_starts(lists)], at, words


def row_starts(lists: pa.Array) -> np.ndarray:
    """Where each row of a list array begins in its flattened values, and where the last one ends; a null row is empty."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype("i8")


def _kept(batches, decide: Callable[[list[str]], np.ndarray], at: int):
    for b in sliced(batches):
        found = [t or "" for t in b.column(at).to_pylist()]
        yield b.filter(pa.array(decide(found), pa.bool_()))


def kept_rows(docs: DataFrame, decide: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """Rows whose whole text (null as empty) ``decide`` keeps; columns, whatever their names, stay as they are."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # a dot in a name would not reach Python
    return plain.mapInArrow(functools.partial(_kept, decide=decide, at=docs.columns.index("text")), plain.schema).toDF(*docs.columns)
