"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into ``d + 1`` segments on a ring, d being the largest allowed distance.
By the pigeonring principle two fingerprints within d bits have a segment from which every chain of l
consecutive segments differs in at most l * d / (d + 1) bits, that is in l - 1 bits (whole numbers).
The join key is the chain of two: the first segment exact, the second with at most one bit changed,
which the one side lists.  Within a key the longer chains prune candidates before the full Hamming
check.  The number of keys is fixed per fingerprint, so work grows with the distinct fingerprints.

Copies with one fingerprint are one vertex.  Within a key only a spanning set of the links is emitted
(the components are the same), and a key with more than ``hot_key`` rows is dealt out again by its
chain of three segments; there only 64 - 3 segments' bits are left free, which bounds the group.

Defined results: null and empty texts, and texts without words, have fingerprint zero and are linked
like any other; texts with fewer words than a shingle are one shingle; rows that repeat an id, or have
none, are documents of their own (a component is named by the smallest id in it, null only if it has
no other); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import anchors as A
from . import textops as T
from .components import connected_components

BITS = 64


def shingle_hashes(buf: np.ndarray, off: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of the word shingles of each text, and shingle offsets per text."""
    buf = T.LOWER[buf]
    ws, we, woff = T.word_spans(buf, off, T.BLANKS)
    size = we - ws
    start = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[start + size] = False
    joined[inside] = buf[~T.BLANKS[buf]]
    n = np.diff(woff)
    shingles = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    first = T.ranges(woff[:-1], shingles)
    last = first + np.repeat(np.minimum(n, shingle), shingles) - 1
    raw = joined.tobytes()
    a, b = start[first].tolist(), (start[last] + size[last]).tolist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(raw.__getitem__, map(slice, a, b)), repeat(42)),
                         T.U64, len(a))
    return hashes, np.concatenate(([0], np.cumsum(shingles)))


def majority(hashes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits set in over half the hashes of each text; zero for none."""
    out = np.zeros(len(off) - 1, T.U64)
    some = np.flatnonzero(np.diff(off))
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, off[some], axis=0, dtype=np.int64)
        over = 2 * ones > np.diff(off)[some, None]
        out[some] = np.packbits(over, axis=1, bitorder="little").view(T.U64).ravel()
    return out


def fingerprints(keyed: DataFrame, shingle: int) -> DataFrame:
    """(_k, fp, _row) of every document."""
    schema = S.StructType([S.StructField("_k", S.LongType()), S.StructField("fp", S.LongType()),
                           keyed.schema["_row"]])

    def scan(batches):
        for b in batches:
            found = [majority(*shingle_hashes(buf, off, shingle)) for _, buf, off in T.text_slices(b.column(1))]
            if found:
                fp = pa.array(np.concatenate(found).view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), fp, b.column(2)], names=schema.names)

    return keyed.select("_k", "_t", "_row").mapInArrow(scan, schema)


class Ring:
    """Segments of a fingerprint for distance ``d``."""

    def __init__(self, d: int):
        if not 1 <= d <= 15:
            raise ValueError("the distance is 1 to 15")
        self.d, self.m = d, d + 1
        edge = [BITS * i // self.m for i in range(self.m + 1)]
        self.shift, self.width = edge[:-1], [b - a for a, b in zip(edge, edge[1:], strict=False)]

    def segment(self, fp: np.ndarray, i: int) -> np.ndarray:
        i %= self.m
        return (fp >> T.U64(self.shift[i])) & T.U64((1 << self.width[i]) - 1)

    def key(self, i: int, parts: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(parts[0]), i + 1, T.U64)
        for x in parts:
            h = T.mix(h * T.U64(0x9E3779B97F4A7C15) + x)
        return h

    def rows(self, fp: np.ndarray):
        """(segment, key, listed, index into fp) for each segment; ``listed`` rows have one bit of the second
        segment set that is clear in the fingerprint (so a pair meets from its one side only)."""
        at = np.arange(len(fp))
        for i in range(self.m):
            first, second = self.segment(fp, i), self.segment(fp, i + 1)
            yield i, self.key(i, [first, second]), np.zeros(len(fp), bool), at
            for bit in range(self.width[(i + 1) % self.m]):
                clear = np.flatnonzero((second >> T.U64(bit)) & T.U64(1) == 0)
                yield (i, self.key(i, [first[clear], second[clear] | T.U64(1 << bit)]),
                       np.ones(len(clear), bool), clear)

    def long_rows(self, fp: np.ndarray, i: int):
        """The same with the chain of three, its last two segments within two bits: the listed side
        changes one or two bits of them, at most one of these in the second segment."""
        at = np.arange(len(fp))
        a, b, c = (self.segment(fp, i + j) for j in range(3))
        wb, wc = self.width[(i + 1) % self.m], self.width[(i + 2) % self.m]
        yield i, self.key(i, [a, b, c]), np.zeros(len(fp), bool), at
        flips_b = [0] + [1 << x for x in range(wb)]
        one_c = [1 << x for x in range(wc)]
        two_c = [x | y for j, x in enumerate(one_c) for y in one_c[:j]]
        for fb in flips_b:
            for fc in ([0] + one_c) if fb else (one_c + two_c):
                yield i, self.key(i, [a, b ^ T.U64(fb), c ^ T.U64(fc)]), np.ones(len(fp), bool), at

    def near(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The pigeonring chains, then the full check."""
        diff = x ^ y
        parts = [np.bitwise_count(self.segment(diff, i)) for i in range(self.m)]
        ok = np.zeros(len(x), bool)
        for i in range(self.m):
            total, chain = np.zeros(len(x), np.int64), np.ones(len(x), bool)
            for length in range(1, self.m + 1):
                total += parts[(i + length - 1) % self.m]
                chain &= total * self.m <= length * self.d
            ok |= chain
        ok[ok] = np.bitwise_count(diff[ok]) <= self.d
        return ok


_ROWS = pa.schema([("key", pa.int64()), ("listed", pa.bool_()), ("fp", pa.int64()), ("k", pa.int64()),
                   ("i", pa.int32())])
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
PAIRS = 1 << 20


def _deal(ring: Ring):
    def deal(batches):
        for b in batches:
            fp, k = b.column(0).to_numpy().view(T.U64), b.column(1).to_numpy()
            yield from _row_batches(ring.rows(fp), fp, k)
    return deal


def _deal_long(ring: Ring):
    def deal(batches):
        for b in batches:
            fp, k, i = b.column(0).to_numpy().view(T.U64), b.column(1).to_numpy(), b.column(2).to_numpy()
            for segment in np.unique(i).tolist():
                x, y = fp[i == segment], k[i == segment]
                yield from _row_batches(ring.long_rows(x, segment), x, y)
    return deal


def _row_batches(rows, fp, k):
    for i, key, listed, at in rows:
        if len(at):
            yield T.batch(_ROWS, key=key.view(np.int64), listed=listed, fp=fp[at].view(np.int64), k=k[at],
                          i=np.full(len(at), i, np.int32))


def _link(ring: Ring):
    """Spanning links of every key; its rows are together and sorted with the unlisted first."""
    def links(fp, k, listed):
        n = int((~listed).sum())
        if n == 0 or len(fp) < 2:
            return
        if n * len(fp) <= 4096:  # small: all its links
            x, y = np.divmod(np.arange(n * len(fp)), len(fp))
            x, y = x[y > x], y[y > x]
            ok = ring.near(fp[x], fp[y])
            yield k[x[ok]], k[y[ok]]
            return
        open_ = np.ones(len(fp), bool)  # large: a spanning forest, by breadth
        for root in range(n):
            if not open_[root]:
                continue
            open_[root] = False
            front = [root]
            while front:
                x = front.pop()
                others = np.flatnonzero(open_ if not listed[x] else open_ & ~listed)
                hit = others[ring.near(np.full(len(others), fp[x]), fp[others])]
                if len(hit):
                    yield np.full(len(hit), k[x]), k[hit]
                    open_[hit] = False
                    front += hit.tolist()

    def run(batches):
        for t in A.grouped((pa.RecordBatch.from_arrays([b.column("key"), b.column("listed"), b.column("fp"),
                                                        b.column("k")], names=["h", "listed", "fp", "k"])
                            for b in batches), 4 << 20):
            h, k, listed = (t.column(c).to_numpy() for c in ("h", "k", "listed"))
            fp = t.column("fp").to_numpy().view(T.U64)
            edge = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True])))
            a, size = edge[:-1], np.diff(edge)
            base = np.add.reduceat(~listed, a, dtype=np.int64)
            small = (size > 1) & (base > 0) & (base * size <= 256)
            row = T.ranges(a[small], base[small])  # each unlisted row with every later row of its key
            end = np.repeat(a[small] + size[small], base[small])
            later = end - row - 1
            for lo in range(0, len(row), PAIRS // 256):
                r, n = row[lo:lo + PAIRS // 256], later[lo:lo + PAIRS // 256]
                x, y = np.repeat(r, n), T.ranges(r + 1, n)
                ok = ring.near(fp[x], fp[y])
                if ok.any():
                    yield T.batch(_LINKS, u=k[x[ok]], v=k[y[ok]])
            for lo, n in zip(a[(base * size > 256) & (size > 1)], size[(base * size > 256) & (size > 1)], strict=True):
                s = slice(lo, lo + n)
                for u, v in links(fp[s], k[s], listed[s]):
                    yield T.batch(_LINKS, u=u, v=v)
    return run


def links(vertices: DataFrame, d: int, hot_key: int) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``d`` bits; vertices are (fp, k), each
    fingerprint once."""
    ring = Ring(d)
    rows = "key long, listed boolean, fp long, k long, i int"

    found = vertices.select("fp", "k").mapInArrow(_deal(ring), rows)
    counted = found.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_key)
    hot = T.materialize(counted.select("key"))
    plain = found
    if ring.m > 2 and hot.limit(1).count():
        plain = found.join(hot, "key", "left_anti")
        wanted = found.join(hot, "key").select("fp", "k", "i").distinct()
        plain = plain.unionByName(wanted.mapInArrow(_deal_long(ring), rows))
    together = plain.repartition("key").sortWithinPartitions("key", "listed")
    return together.select("key", "listed", "fp", "k").mapInArrow(_link(ring), "u long, v long").distinct()


def _labelled(keyed: DataFrame, shingle: int, distance: int, hot_key: int) -> DataFrame:
    """(_k, fp, _row, c): c is the smallest key of the component."""
    row = T.materialize(fingerprints(keyed, shingle))
    vertices = T.materialize(row.groupBy("fp").agg(F.min("_k").alias("k")))
    comp = connected_components(links(vertices, distance, hot_key))
    named = T.materialize(vertices.join(comp, F.col("k") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "k").alias("c")))
    return row.join(named, "fp").select("_k", "fp", "_row", "c")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, hot_key: int = 20_000) -> DataFrame:
    """(the columns of ``docs`` but the text, fingerprint, component_id, first): ``component_id`` is the
    smallest id reachable over links of at most ``distance`` bits, ``first`` marks one row of each
    component.  A column of ``docs`` named like one of these gives way to it."""
    keyed, by_id = A.keyed(docs, id_col, text_col)
    out = _labelled(keyed, shingle, distance, hot_key)
    if by_id:
        out = out.withColumn("component_id", F.col("c"))
    else:
        out = T.materialize(out)
        out = out.join(out.groupBy("c").agg(F.min(f"_row.`{id_col}`").alias("component_id")), "c")
    cols = [F.col(f"_row.`{c}`").alias(c)
            for c in T.beside(docs.columns, text_col, "fingerprint", "component_id", "first")]
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select(*cols, fingerprint, "component_id", (F.col("_k") == F.col("c")).alias("first"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                distance: int = 3, hot_key: int = 20_000) -> DataFrame:
    """``docs`` with the first row of each component."""
    keyed, _ = A.keyed(docs, id_col, text_col)
    gone = T.materialize(_labelled(keyed, shingle, distance, hot_key).where("_k <> c").select("_k"))
    kept = keyed.join(gone, "_k", "left_anti")
    return kept.select(*[(F.col("_t") if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")
