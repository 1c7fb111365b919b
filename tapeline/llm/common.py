"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import materialise, shared_dir  # noqa: F401

#: Rows in one Arrow batch of whole texts: bounds a worker's memory when texts are long.
BATCH_ROWS = 1000

#: Bytes of text in one Arrow batch, so that a batch of very long texts has few rows.
BATCH_BYTES = 16 << 20

#: The white space of the word rule `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"

#: For each byte, whether it belongs to a word, and its lower case (A-Z only).
IN_WORD = np.ones(256, bool)
IN_WORD[[32, *range(9, 14)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Longer words are hashed one by one.
LONG_WORD = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batches to at most `rows` rows and about BATCH_BYTES: a smaller setting of the caller's stays."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).removesuffix("b")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all UTF-8 bytes, offsets) of a string column; a null counts as empty. No copy is made unless there are nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


_held: dict = {}


def worker_memory(name=None, make=None):
    """What a worker process keeps between tasks of one operator, made when first asked for.

    Python workers live on from one operator's tasks to the next one's: whatever other operators kept is let go, and so is what those left that keep nothing.
    """
    if name not in _held:
        _held.clear()
        release_memory()
        _held[name] = make() if make else None
    return _held[name]


def release_memory() -> None:
    """Gives back to the system what this process no longer holds: in the driver, arrays of an earlier step would stay reserved beside Spark's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums of hashes become evenly spread keys."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_spans(data: np.ndarray, off: np.ndarray, in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of the words of texts that lie one behind the other in `data`; in_word tells for each byte whether it belongs to a word."""
    inside = in_word[data]
    start, last = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = off[:-1] < off[1:]
    start[off[:-1][full]] = inside[off[:-1][full]]
    last[off[1:][full] - 1] = inside[off[1:][full] - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """A view of the 8 bytes from each place on as one little-endian number; `data` is followed by zeros."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    return np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 9,), (1,))


#: Masks of the lowest 0 to 8 bytes.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word with A-Z in lower case, words before each text). Words of up to 8 bytes never collide with their likes."""
    starts, ends, before = word_spans(data, off)
    low = LOWER[data]
    eight = eight_bytes(low)
    size = ends - starts
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rest = np.flatnonzero(size <= LONG_WORD)
    done = 0
    while len(rest):
        part = eight[starts[rest] + done] & LOW_BYTES[np.minimum(size[rest] - done, 8)]
        h[rest] = mix64(h[rest] + part)
        done += 8
        rest = rest[size[rest] > done]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(low[starts[i] : ends[i]].tobytes())
    return h, before
