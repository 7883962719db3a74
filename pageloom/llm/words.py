"""Words, word hashes and batch helpers shared by the operators that run numpy inside tasks.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``. ``bytes.split`` cuts UTF-8 at exactly
those six bytes, so texts travel as binary columns and are never decoded just to find words.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

#: Odd 64-bit multipliers of the mixing step.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xC2B2AE3D27D4EB4F)


class Shared:
    """A broadcast value with a name of its own, by which workers know what they have built from it."""

    def __init__(self, spark: SparkSession, value: object):
        self.name, self._broadcast = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self._broadcast.value

    def drop(self) -> None:
        """Remove the copies of executors and driver; no task may need the value any more."""
        self._broadcast.destroy()


_in_turn: Callable[[], None] | None = None


def take_turn(drop: Callable[[], None] | None = None) -> None:
    """Say that this worker now works for the operator whose store ``drop`` empties; the one before loses its store.

    Workers outlive queries, so a pipeline's workers would otherwise end up with the stores of all its operators.
    """
    global _in_turn
    if _in_turn is not None and _in_turn != drop:
        _in_turn()
    _in_turn = drop


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return x ^ (x >> np.uint64(32))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of 64-bit names."""
    return mix(mix(a) * MIX_B + b)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Name of every run of ``k`` words; of the whole text if it has fewer words, nothing if it has none."""
    if len(hashes) == 0:
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for j in range(1, k):
        out = combine(out, hashes[j : j + n])
    return out


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate rows from shared storage, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(name: str) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of a batch as tuples of Python values, one at a time."""
    columns = [batch.column(name) for name in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def packed(frame: DataFrame, column: str) -> DataFrame:
    """The frame with the bytes of ``column`` compressed one by one, as it is about to be shuffled."""
    def run(found):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in found:
            at = batch.schema.names.index(column)
            yield batch.set_column(at, column, pa.array([pack(t.as_py()) for t in batch.column(at)], pa.binary()))

    return frame.mapInArrow(run, frame.schema)


def batches(records: Iterable[tuple], schema: pa.Schema, size: int = 4000, weight: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows, cut earlier once their byte and list values pass ``weight``."""
    held: list[tuple] = []
    heavy = 0
    for record in records:
        held.append(record)
        heavy += sum(len(v) for v in record if isinstance(v, (bytes, str, list, np.ndarray)))
        if len(held) >= size or heavy >= weight:
            yield _batch(held, schema)
            held, heavy = [], 0
    if held:
        yield _batch(held, schema)
    pa.default_memory_pool().release_unused()


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)
