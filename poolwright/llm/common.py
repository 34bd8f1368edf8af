"""Helpers shared by the training-data operators: table reads, Arrow text buffers, word spans."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright.session import materialize

#: Words are runs of anything but ASCII white space (fixed by the query contracts).
WORD_RE = r"[^\x20\x09-\x0D]+"
#: doc_id that stands for a null one inside the operators: it sorts after every real id.
NULL_ID = (1 << 63) - 1
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``; survives the loss of executors."""
    return materialize(df)


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null ids give null."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(mod)


def crc_of(doc_id) -> int | None:
    return None if doc_id is None else zlib.crc32(str(int(doc_id)).encode())


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``limit`` text bytes (one long row may exceed it)."""
    n = batch.num_rows
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64) + 16)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows back to back, and the row offsets (n + 1). Null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return buf, o - o[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of every row, and the row's first word (n + 1 entries).

    ``outside`` flags the byte values that part words. Words never cross rows, as a boundary is put at every row start.
    """
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~outside[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] |= inside[heads]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    finishes[tails] |= inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_bytes(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


_RNG = np.random.Generator(np.random.PCG64(20240607))
#: a random 64-bit value per byte and an odd multiplier: the polynomial word hash below
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_MUL = int(_RNG.integers(0, 1 << 62)) * 4 + 1
_INV = pow(_MUL, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(p, dtype=np.uint64)
        _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans hash alike wherever they stand.

    Prefix sums of a polynomial in an odd multiplier modulo 2**64, shifted back by its inverse.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = len(buf)
    with np.errstate(over="ignore"):
        acc = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buf] * _powers(_MUL, n), out=acc[1:])
        return mix((acc[ends] - acc[starts]) * _powers(_INV, n + 1)[starts] + (ends - starts).astype(np.uint64))


def words_array(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """All words of ``buf`` (as by ``word_spans``) as an Arrow binary array: what isn't white space, in order."""
    offs = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offs[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(buf[~_SPACE[buf]])])


#: rows of a few numbers that may be broadcast: some tens of MB
FEW_ROWS = 1_000_000


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """``df``, a checkpoint of a few numbers a row, for a broadcast join if it is counted to be small; as it is else."""
    return F.broadcast(df) if df.count() <= FEW_ROWS else df


#: rows of a few numbers that a task takes at least
TASK_ROWS = 100_000


def tasks_for(rows: int) -> int:
    """Tasks that so many rows of a few numbers are worth: every task leaves files of its own, in a shuffle as in a
    checkpoint, so a small table in many partitions is mostly file ends. Without effect on large tables."""
    return max(1, -(-rows // TASK_ROWS))


def stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    """Write the rows as Parquet under ``spark.checkpoint.dir`` and read them back: a checkpoint that is
    compressed, for large intermediate tables. With the folder, which ``discard`` removes."""
    from uuid import uuid4

    from poolwright.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """As ``stored_at``; like checkpoints, the files stay until that folder is cleared."""
    return stored_at(df)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove what ``stored_at`` wrote, once no frame that is still to be run reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
