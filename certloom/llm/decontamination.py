"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  The smallest
hash of the k-word grams of every window of ``size`` words is its fingerprint; a document window that
equals an item window has the same fingerprint at the same place, so joining document and item
fingerprints and extending each hit to the windows around it, compared word by word with the items'
distinct windows, finds every shared span of ``size`` words or more.  Items with fewer words are one
window, found by their whole hash.  Work and memory are linear in the text and in the items, however
many items share a passage; a long text is scanned in pieces, the last words of one carried to the next.

The items' fingerprints are broadcast in shards of at most ``max_shard_bytes`` of item text (measured
first); a larger benchmark takes more shards, each a pass over the documents, with the same result.
Documents are never shuffled.

Defined results: null and empty texts have no words, hit nothing and are not contaminated; items without words
are ignored; an item without an id goes by the empty string, rows that repeat an item id count as one item;
every document row is judged by itself, repeated rows alike; an empty benchmark hits nothing; other columns
pass through whatever their names, but one named like a result column gives way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T
from .pieces import text_pieces

CUT = T.NOT_ALNUM[T.LOWER]  # bytes that are in no word, before lower-casing
SHARE = 20  # contaminated: SHARE * n_hit >= n_words


def words_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word offsets per text."""
    buf = T.LOWER[buf]
    ws, we, woff = T.word_spans(buf, off, T.NOT_ALNUM)
    return T.word_hashes(buf, ws, we), woff


def winnow(values: np.ndarray, woff: np.ndarray, size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and fingerprint of every window of ``size`` words: its smallest k-gram hash."""
    if len(values) < size:
        return np.zeros(0, np.int64), np.zeros(0, T.U64)
    at = np.arange(len(values) - k + 1)
    grams = T.span_hash(T.span_sums(values), at, at + k)
    places = T.leftmost_min(grams, size - k + 1)
    s = T.ranges(woff[:-1], np.maximum(np.diff(woff) - size + 1, 0))
    return s, grams[places[s]]


def _find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in ``sorted_hashes`` (distinct), -1 for others."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == hashes, at, -1)


class ItemIndex:
    """Fingerprints and distinct windows of one shard of items, and the items that hold each window."""

    def __init__(self, ids: list[str], texts: list[str | None], size: int, k: int):
        self.size, self.k = size, k
        buf, off = T.text_buffer(pa.array(texts, pa.string()))
        self.words, off = words_of(buf, off)
        self.ids = ids
        s, fingerprints = winnow(self.words, off, size, k)
        self.fingerprints = np.unique(fingerprints)
        length = np.diff(off)
        short = np.flatnonzero((length > 0) & (length < size))
        self.short = np.unique(length[short]).tolist()
        starts = np.concatenate((s, off[short]))
        n = np.concatenate((np.full(len(s), size), length[short]))
        hashes = T.span_hash(T.span_sums(self.words), starts, starts + n)
        self.windows, first, window = np.unique(hashes, return_index=True, return_inverse=True)
        self.at = starts[first]
        held = np.unique(window * max(len(ids), 1) + (np.searchsorted(off, starts, "right") - 1))
        self.items = (held % max(len(ids), 1)).astype(np.int32)
        self.edges = np.searchsorted(held // max(len(ids), 1), np.arange(len(self.windows) + 1))

    def items_of(self, windows: np.ndarray) -> list[str]:
        """Ids of the items that hold any of the windows."""
        w = np.unique(windows)
        items = self.items[T.ranges(self.edges[w], self.edges[w + 1] - self.edges[w])]
        return [self.ids[i] for i in np.unique(items)]

    def _equal(self, values, sums, starts, n):
        """Starts of the spans of ``n`` words that equal a window, and that window, compared word by word."""
        window = _find(self.windows, T.span_hash(sums, starts, starts + n))
        starts, window = starts[window >= 0], window[window >= 0]
        same = np.ones(len(starts), bool)
        for j in range(n):
            same &= values[starts + j] == self.words[self.at[window] + j]
        return starts[same], starts[same] + n, window[same]

    def hits(self, values, woff):
        """(first word, end word, window) of every occurrence of a window.  Each fingerprint that an item
        has too is extended to the windows around it that have it, and these are looked up among the items'
        distinct windows: at most one hit a window and length, however many items hold it."""
        s, fingerprints = winnow(values, woff, self.size, self.k)
        new = np.ones(len(s), bool)
        new[1:] = fingerprints[1:] != fingerprints[:-1]
        known = _find(self.fingerprints, fingerprints[new]) >= 0
        sums = T.span_sums(values)
        out = [self._equal(values, sums, s[known[np.cumsum(new) - 1]], self.size)]
        for n in self.short:
            s = T.ranges(woff[:-1], np.maximum(np.diff(woff) - n + 1, 0))
            out.append(self._equal(values, sums, s, n))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Found:
    """What one text, scanned in one or several pieces, shares with the items."""

    def __init__(self):
        self.n, self.spans, self.windows, self.tail = 0, [], np.zeros(0, np.int64), np.zeros(0, T.U64)

    def add(self, s, e, windows) -> None:
        self.spans += T.merge_spans(s, e)
        self.windows = np.union1d(self.windows, windows)

    def piece(self, values, index: ItemIndex) -> None:
        """The next words of the text, after the last ones of the piece before, with which they may be a window."""
        values, base = np.concatenate((self.tail, values)), self.n - len(self.tail)
        s, e, windows = index.hits(values, np.array([0, len(values)]))
        self.add(s + base, e + base, windows)
        self.n, self.tail = base + len(values), values[max(len(values) - index.size + 1, 0):].copy()

    def state(self, index: ItemIndex | None, before: dict | None) -> dict:
        if not self.spans:
            return before or {"n": self.n, "items": [], "spans": []}
        names, spans = set(index.items_of(self.windows)), self.spans
        if before:
            names.update(before["items"])
            spans = spans + [(x["s"], x["e"]) for x in before["spans"]]
        spans = T.merge_spans(*np.array(spans).T)
        return {"n": self.n, "items": sorted(names), "spans": [{"s": x, "e": y} for x, y in spans]}


def _shard_indexes(benchmark: DataFrame, item_col: str, text_col: str, size: int, k: int, max_shard_bytes: int):
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("i"),
                             F.col(f"`{text_col}`").alias("t")).where(
                                 F.octet_length("t") > 0).distinct()  # copies would meet in one shard
    total = items.agg(F.sum(F.octet_length("t") + F.octet_length("i") + 16)).first()[0] or 0
    n = -(-total // max_shard_bytes)
    for shard in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == shard) if n > 1 else items
        rows = part.collect()  # at most about max_shard_bytes, by the sum above
        yield ItemIndex([r.i for r in rows], [r.t for r in rows], size, k)


SPANS = S.ArrayType(S.StructType([S.StructField("s", S.LongType()), S.StructField("e", S.LongType())]))
_SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", size: int = 13, k: int = 5,
                       max_shard_bytes: int = 16 << 20, out_col: str = "contamination") -> DataFrame:
    """``docs`` plus a struct column ``contamination``: ``n_words``, ``n_hit`` (words inside a shared
    window), ``items`` (ids of the items hit, sorted as strings), ``spans`` (word ranges hit) and
    ``contaminated``."""
    T.prepare(docs.sparkSession)
    k = min(k, size)
    state = S.StructType([S.StructField("n", S.LongType()), S.StructField("items", S.ArrayType(S.StringType())),
                          S.StructField("spans", SPANS)])
    row_type = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")).schema["r"].dataType
    schema = S.StructType([S.StructField("_row", row_type), S.StructField("_s", state)])
    state_type = pa.struct([("n", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _SPANS)])

    def scan_with(shared):
        def scan(batches):
            index = shared.value if shared else ItemIndex([], [], size, k)
            for b in batches:
                before = b.column(2).to_pylist() if b.num_columns > 2 else [None] * b.num_rows
                out, long_text = [], None
                for a, last, buf, off in text_pieces(b.column(1), CUT):
                    values, woff = words_of(buf, off)
                    if long_text or not last:
                        long_text = long_text or Found()
                        long_text.piece(values, index)
                        if last:
                            out.append(long_text.state(index, before[a]))
                            long_text = None
                        continue
                    s, e, window = index.hits(values, woff)
                    doc = np.searchsorted(woff, s, "right") - 1
                    order = np.argsort(doc, kind="stable")
                    s, e, window, doc = s[order], e[order], window[order], doc[order]
                    edges = np.searchsorted(doc, np.arange(len(woff)))
                    for i in range(len(woff) - 1):
                        found, lo, hi = Found(), edges[i], edges[i + 1]
                        found.n = int(woff[i + 1] - woff[i])
                        if lo < hi:
                            found.add(s[lo:hi] - woff[i], e[lo:hi] - woff[i], window[lo:hi])
                        out.append(found.state(index, before[a + i]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, state_type)], names=["_row", "_s"])
        return scan

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    d = docs.select(row, F.col(f"`{text_col}`").alias("_t"))
    done = None
    for index in _shard_indexes(benchmark, item_col, item_text_col, size, k, max_shard_bytes):
        if done is not None:
            done = T.materialize(done)
            d = done.select("_row", F.col(f"_row.`{text_col}`").alias("_t"), "_s")
        done = d.mapInArrow(scan_with(docs.sparkSession.sparkContext.broadcast(index)), schema)
    if done is None:
        done = d.mapInArrow(scan_with(None), schema)
    n_hit = F.aggregate("_s.spans", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"])
    out = done.select("_row", "_s", n_hit.alias("_hit"))
    found = F.struct(F.col("_s.n").alias("n_words"), F.col("_hit").alias("n_hit"), F.col("_s.items").alias("items"),
                     F.col("_s.spans").alias("spans"),
                     ((F.col("_hit") > 0) & (SHARE * F.col("_hit") >= F.col("_s.n"))).alias("contaminated"))
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in T.beside(docs.columns, out_col)], found.alias(out_col))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    c = "contamination"
    return find_contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", f"{c}.n_words", f"{c}.n_hit", F.size(f"{c}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"), f"{c}.contaminated")
