"""Vectorised text helpers that run inside Spark tasks on Arrow batches.

Texts of a batch are handled as one byte buffer with offsets, in slices of a few MB, so memory
follows the slice (or the longest single text), never the partition.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 18
U64 = np.uint64
_M = 0x9E3779B97F4A7C13  # odd, 3 mod 8
_POWERS: dict[str, np.ndarray] = {}
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
                 "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2"}


def _bytes(value: str) -> int:
    digits = value.strip().lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(digits[-1:], 0)
    return int(digits[:-1] if unit else digits) << unit


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package and give freed memory back, bound the Arrow batches they
    get, and name the shared checkpoint folder."""
    from ..session import ensure_checkpoint_dir
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, env.get("PYTHONPATH")) if p)
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    if _bytes(spark.conf.get(BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    ensure_checkpoint_dir(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back as Parquet: lineage is
    cut, a lost executor costs nothing that was written, and readers prune columns."""
    import uuid
    spark = df.sparkSession
    prepare(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/llm-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def clean_up(spark: SparkSession) -> None:
    """Delete the tables that :func:`materialize` wrote; call it when no result is read any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    while _WRITTEN:
        path = hadoop.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def beside(columns: list[str], *new: str) -> list[str]:
    """The columns that stay beside result columns: those of the same name, in any case, are replaced."""
    return [c for c in columns if c.lower() not in {n.lower() for n in new}]


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return table


#: Words ``[^\x20\x09-\x0D]+``.
BLANKS = separators((0x20, 0x20), (0x09, 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (n + 1, from 0) of an Arrow text or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges [a, b) of about ``limit`` bytes; a longer text is a slice of its own."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b
        a = b


def text_slices(column, limit: int = SLICE_BYTES):
    """(first row, byte buffer, offsets) for each slice of a column."""
    buf, off = text_buffer(column)
    for a, b in slices(off, limit):
        yield a, buf[off[a]:off[b]], off[a:b + 1] - off[a]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 4096)
        inverse = U64(pow(_M, -1, 2**64))
        for key, base in (("up", U64(_M)), ("down", inverse)):
            p = np.full(size, base, U64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def span_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums for :func:`span_hash` (mod 2**64, position-weighted)."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end): depends on its values and length, not on its place."""
    _, down = _powers(len(sums))
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _TABLE[buf]


def word_spans(buf: np.ndarray, off: np.ndarray, table: np.ndarray):
    """Start and end byte of each word, and word offsets per document (n + 1)."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~table[buf]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~word[:-1]
    starts = np.flatnonzero(word & (before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~word[1:]
    ends = np.flatnonzero(word & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(span_sums(byte_values(buf)), starts, ends)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (len(x) - w + 1 of them)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    step = 1
    while step * 2 <= w:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:n], x[w - step:w - step + n]) if step < w else x[:n]


MIN_BLOCK = 1 << 20


def leftmost_min(x: np.ndarray, w: int) -> np.ndarray:
    """Index of the smallest of every ``w`` consecutive hashes, by their upper 36 bits; the leftmost of
    equal ones.  The same bits decide however many values there are."""
    bits = U64(28)  # for the place within a block
    out = np.empty(max(len(x) - w + 1, 0), np.int64)
    for a in range(0, len(out), MIN_BLOCK):
        part = x[a:a + MIN_BLOCK + w - 1]
        low = sliding_min((part >> bits << bits) | np.arange(len(part), dtype=U64), w)
        out[a:a + MIN_BLOCK] = (low & ((U64(1) << bits) - U64(1))).astype(np.int64) + a
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated [start, start + count) integer ranges."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(at - starts, counts)


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans [start, end), in order."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], s[1:] > reach[:-1])))
    return list(zip(s[new].tolist(), reach[np.append(new[1:], len(s)) - 1].tolist(), strict=True))


def hashed_grams(buf: np.ndarray, off: np.ndarray, dim: int, table: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """(texts, dim) float32 counts of the hashed byte n-grams of each text, its bytes mapped by
    ``table``; ``dim`` is a power of two.  Grams of blanks alone do not count."""
    n_docs, shift = len(off) - 1, np.uint32(33 - dim.bit_length())
    x = table[buf].astype(np.uint32)
    size = np.diff(off)
    doc = np.repeat(np.arange(n_docs, dtype=np.int64) * dim, size)
    left = np.repeat(off[1:], size) - np.arange(len(buf))
    total = np.zeros(n_docs * dim, np.int64)
    for n in sizes:
        m = max(len(buf) - n + 1, 0)
        g, blank = np.full(m, n, np.uint32), np.ones(m, bool)
        for j in range(n):
            part = x[j:j + m]
            g = g * np.uint32(0x01000193) + part
            blank &= part == 32
        g = ((g ^ (g >> np.uint32(15))) * np.uint32(2654435761)) >> shift
        ok = (left[:m] >= n) & ~blank
        total += np.bincount(doc[:m][ok] + g[ok], minlength=n_docs * dim)
    return total.reshape(n_docs, dim).astype(np.float32)


def row_slices(column, rows: int, limit: int = SLICE_BYTES):
    """Like :func:`text_slices`, with at most ``rows`` texts each."""
    for a, buf, off in text_slices(column, limit):
        for lo in range(0, len(off) - 1, rows):
            part = off[lo:lo + rows + 1]
            yield a + lo, buf[part[0]:part[-1]], part - part[0]


class Rows:
    """Collects output rows and yields record batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = 2 << 20):
        self.schema, self.limit = schema, limit
        self._clear()

    def _clear(self):
        self.columns, self.size = [[] for _ in self.schema], 0

    def add(self, size: int, *values) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.size += size + 64

    def take(self, last: bool = False):
        if self.size >= self.limit or last and self.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema)
            self._clear()


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, schema.field(k).type)
         for k, c in ((f.name, columns[f.name]) for f in schema)], schema=schema)
