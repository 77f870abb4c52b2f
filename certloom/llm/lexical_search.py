"""Ranked lexical search over bit-sliced Bloom signatures.

**Index** (:func:`build_index`).  A document is a set of entries (term, level): the term occurs at
least ``LEVELS[level]`` times.  Documents with a similar number of entries form a block; each has a
Bloom signature of about ``BITS`` bits an entry, and a block stores the signatures transposed: one
bitmap over its documents for each signature bit, with each document's length and highest term count.
The index knows no query and covers every document that has a term.

**Search** (:func:`search`).  The bitmaps of a term's entries, ANDed, hold every document that has the
entry and a few that do not, so they bound the term's count from above; the weighted sum of those
bounds over an item's terms bounds the document's score from above.  A first probe takes each item's
``k`` highest bounds, whose exact scores give a score that the ``k`` best must reach; a second probe
lists every document whose bound reaches it, and all of these are scored exactly from their texts.
What is left out is proven to score less, so the result is exact.

The items are taken in shards of at most ``max_shard_bytes`` of text (queries, their weights and the
first probe's ``k`` documents an item are bounded by that); the index is built once.

Defined results: null and empty texts have no terms, never match, and count nowhere; an item without
terms has no rows; rows that repeat an item id are one item per distinct text; rows that repeat a
document id are ranked each by itself; a null id is an id that sorts first; other columns do not
matter, whatever their names; empty tables give an empty result.  Texts of any length are read in
pieces; a single word is held whole.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T
from .pieces import text_pieces

LEVELS = (1, 2, 3, 4, 6, 9, 16, 32)
BITS, HASHES, BLOCK = 10, 3, 1024
MAX_WIDTH = 1 << 23     # bits of one signature; a fuller one bounds more loosely, never wrongly
BLOCK_BITS = 1 << 23    # bits of one block, unless a single document has more
ITEM_GROUP = 64
U64 = np.uint64
#: Terms are ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``, A-Z lower-cased.
BREAKS = T.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


# ------------------------------------------------------------------ terms
def _pairs(doc: np.ndarray, h: np.ndarray, n: np.ndarray):
    """Distinct (doc, hash) in order, with the sums of ``n``."""
    order = np.lexsort((h, doc))
    doc, h, n = doc[order], h[order], n[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return doc[at], h[at], np.add.reduceat(n, at) if len(at) else n


def term_counts(column):
    """(first row, terms of each text, then for each distinct term of each text: text, hash, count)."""
    waiting: list = []
    for a, last, buf, off in text_pieces(column, BREAKS):
        starts, ends, at = T.word_spans(buf, off, BREAKS)
        h, size = T.word_hashes(T.LOWER[buf], starts, ends), np.diff(at)
        doc = np.repeat(np.arange(len(size)), size)
        part = (size, *_pairs(doc, h, np.ones(len(h), np.int64)))
        if last and not waiting:
            yield a, *part
            continue
        waiting.append(part)
        if last:
            size, doc, h, n = (np.concatenate(x) for x in zip(*waiting, strict=True))
            yield a, np.array([size.sum()]), *_pairs(doc, h, n)
            waiting = []


# ------------------------------------------------------------------ index
def entry_hashes(h: np.ndarray, level: int) -> np.ndarray:
    return T.mix(h ^ U64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))


def positions(entries: np.ndarray, width) -> np.ndarray:
    """(HASHES, entries) signature bits; one width, or one for each entry."""
    step = (entries >> U64(32)) | U64(1)
    width = np.asarray(width, U64)
    return np.stack([(entries + U64(i) * step) % width for i in range(HASHES)]).astype(np.int64)


def signature_width(entries: int) -> int:
    """Bits for that many entries; powers of two of it, so that blocks fill up."""
    return min(BITS << max(3, int(entries - 1).bit_length()), MAX_WIDTH)


def _signatures(doc, h, tf, width):
    """Packed signatures of the texts, one after the other."""
    start = np.cumsum(width) - width
    flags = np.zeros(int(width.sum()), bool)
    for level, least in enumerate(LEVELS):
        on = tf >= least
        d = doc[on]
        flags[positions(entry_hashes(h[on], level), width[d]) + start[d]] = True
    return np.packbits(flags), start // 8


def _slices(rows: list[np.ndarray], width: int) -> bytes:
    """Signatures of a block -> one bitmap over its documents for each bit."""
    out = np.empty((width, (len(rows) + 7) // 8), np.uint8)
    packed = np.stack(rows)
    step = max(1, (1 << 24) // (8 * len(rows)))
    for lo in range(0, packed.shape[1], step):
        bits = np.unpackbits(packed[:, lo:lo + step], axis=1)
        out[lo * 8:lo * 8 + bits.shape[1]] = np.packbits(bits.T, axis=1)
    return out.tobytes()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block, stored: width, n_docs, n_terms, slices, and per document its id, number of terms and
    highest term count.  One scan, no shuffle; it is about a byte and a half for each distinct term."""
    T.prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    schema = S.StructType([
        S.StructField("width", S.IntegerType()), S.StructField("n_docs", S.LongType()),
        S.StructField("n_terms", S.LongType()), S.StructField("slices", S.BinaryType()),
        S.StructField("ids", S.ArrayType(id_type)), S.StructField("lengths", S.ArrayType(S.LongType())),
        S.StructField("most", S.ArrayType(S.LongType()))])

    def scan(batches):
        pending: dict[int, list] = {}

        def block(width, ids_type):
            ids, size, most, rows = zip(*pending.pop(width), strict=True)
            return pa.RecordBatch.from_arrays([
                pa.array([width], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([sum(size)], pa.int64()),
                pa.array([_slices(list(rows), width)], pa.binary()), pa.array([list(ids)], pa.list_(ids_type)),
                pa.array([list(size)], pa.list_(pa.int64())), pa.array([list(most)], pa.list_(pa.int64()))],
                names=schema.names)

        ids_type = None
        for b in batches:
            ids_type = b.column(0).type
            for a, size, doc, h, tf in term_counts(b.column(1)):
                entries = sum(np.bincount(doc[tf >= least], minlength=len(size)) for least in LEVELS)
                width = np.array([signature_width(int(n)) for n in entries], np.int64)
                packed, start = _signatures(doc, h, tf, width)
                at = np.searchsorted(doc, np.arange(len(size) + 1))
                for i in np.flatnonzero(size).tolist():
                    w = int(width[i])
                    row = packed[start[i]:start[i] + w // 8].copy()
                    rows = pending.setdefault(w, [])
                    rows.append((b.column(0)[a + i].as_py(), int(size[i]), int(tf[at[i]:at[i + 1]].max()), row))
                    if len(rows) >= min(BLOCK, max(1, BLOCK_BITS // w)):
                        yield block(w, ids_type)
        for width in list(pending):
            yield block(width, ids_type)

    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"))
    return T.materialize(d.mapInArrow(scan, schema))


# ------------------------------------------------------------------ items
class Items:
    """A shard of items: each one's distinct terms (as places in ``terms``) and how often it has them."""

    def __init__(self, rows):
        self.ids = [i for i, _ in rows]
        found = [np.zeros(0, U64)] * len(rows)
        times = [np.zeros(0, np.int64)] * len(rows)
        for a, size, doc, h, n in term_counts(pa.array([t for _, t in rows], pa.string())):
            at = np.searchsorted(doc, np.arange(len(size) + 1))
            for i in range(len(size)):
                found[a + i], times[a + i] = h[at[i]:at[i + 1]], n[at[i]:at[i + 1]]
        self.terms = np.unique(np.concatenate([*found, np.zeros(0, U64)]))
        self.places = [np.searchsorted(self.terms, h) for h in found]
        self.times = times
        self.weights = np.zeros(len(self.terms), np.int64)
        self.n_docs = self.n_terms = 0

    def weigh(self, df: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are terms, and their places."""
        if not len(self.terms):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return self.terms[at] == h, at

    def norm(self, size: np.ndarray) -> np.ndarray:
        """A document's m."""
        return 75 + 25 * size * self.n_docs // self.n_terms

    def groups(self):
        """(items, their distinct terms, each item's places among these, weights times counts)."""
        for lo in range(0, len(self.ids), ITEM_GROUP):
            which = [i for i in range(lo, min(lo + ITEM_GROUP, len(self.ids))) if len(self.places[i])]
            if which:
                terms = np.unique(np.concatenate([self.places[i] for i in which]))
                yield which, terms, [np.searchsorted(terms, self.places[i]) for i in which], [
                    (self.weights[self.places[i]] * self.times[i]).astype(float) for i in which]


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def block_bounds(items: Items, width: int, n: int, slices: bytes, size: np.ndarray, most: np.ndarray):
    """(items, (items, documents) upper bounds of the scores) of a block, group by group."""
    bitmaps = np.frombuffer(slices, np.uint8).reshape(width, -1)
    m = items.norm(size)
    for which, terms, places, weights in items.groups():
        total = np.zeros((len(terms), n))
        live, rows, below = None, np.arange(len(terms)), np.zeros(n, np.int64)
        for level in range(len(LEVELS)):
            p = positions(entry_hashes(items.terms[terms[rows]], level), width)
            has = reduce(np.bitwise_and, (bitmaps[p[i]] for i in range(HASHES)))
            live = has if live is None else has & live
            some = live.any(axis=1)
            live, rows = live[some], rows[some]
            if not len(rows):
                break
            top = np.minimum(LEVELS[level + 1] - 1, most) if level + 1 < len(LEVELS) else most
            value = np.maximum(saturation(top, m), below)
            total[rows] += np.unpackbits(live, axis=1, count=n) * (value - below)
            below = value
        yield which, np.stack([w @ total[p] for p, w in zip(places, weights, strict=True)])


def _blocks(batches):
    for b in batches:
        for width, n, slices, ids, size, most in zip(*(b.column(i) for i in range(6)), strict=True):
            yield (width.as_py(), n.as_py(), slices.as_buffer(), ids.values, np.array(size.as_py(), np.int64),
                   np.array(most.as_py(), np.int64))


def _blocks_of(index: DataFrame) -> DataFrame:
    return index.select("width", "n_docs", "slices", "ids", "lengths", "most")


# ------------------------------------------------------------------ search
def _best(rows: DataFrame, score: str, k: int) -> DataFrame:
    """Each item's ``k`` highest rows, ranked; a hot item is cut in parts first."""
    order = [F.col(score).desc(), F.col("_id").asc()]
    part = F.pmod(F.xxhash64("_id"), F.lit(64))
    first = Window.partitionBy("_item", "_part").orderBy(*order)
    rows = rows.withColumn("_part", part).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order))).where(
        F.col("rank") <= k).drop("_part")


def _document_frequencies(docs: DataFrame, items) -> np.ndarray:
    schema = pa.schema([("t", pa.int32()), ("n", pa.int64())])

    def scan(batches):
        shard = items.value
        total = np.zeros(len(shard.terms), np.int64)
        for b in batches:
            for _, _, _, h, _ in term_counts(b.column(0)):
                known, at = shard.lookup(h)
                total += np.bincount(at[known], minlength=len(total))
        t = np.flatnonzero(total)
        yield T.batch(schema, t=t.astype(np.int32), n=total[t])

    out = np.zeros(len(items.value.terms), np.int64)
    for t, n in docs.select("_t").mapInArrow(scan, "t int, n long").groupBy("t").agg(F.sum("n")).collect():  # a shard's terms
        out[t] = n
    return out


def _first_probe(index: DataFrame, items, k: int) -> DataFrame:
    """(_item, _id): the documents of each item's highest bounds."""
    id_type = index.schema["ids"].dataType.elementType
    schema = S.StructType([S.StructField("_item", S.IntegerType()), S.StructField("_id", id_type),
                           S.StructField("bound", S.DoubleType())])

    def scan(batches):
        best: dict[int, list] = {}
        kind = None
        for width, n, slices, ids, size, most in _blocks(batches):
            kind = ids.type
            for which, bounds in block_bounds(items.value, width, n, slices, size, most):
                top = np.argsort(-bounds, axis=1)[:, :k]
                for i, row, at in zip(which, bounds, top, strict=True):
                    mine = best.get(i, [])
                    floor = mine[-1][0] if len(mine) == k else 0.0
                    new = [(float(row[j]), ids[int(j)].as_py()) for j in at if row[j] > floor]
                    if new:
                        best[i] = sorted(mine + new, key=lambda x: -x[0])[:k]
        if best:
            item, pair = zip(*[(i, x) for i, rows in best.items() for x in rows], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array([x[1] for x in pair], kind),
                                              pa.array([x[0] for x in pair])], names=schema.names)

    return _best(_blocks_of(index).mapInArrow(scan, schema), "bound", k).select("_item", "_id")


def _second_probe(index: DataFrame, items, least: np.ndarray) -> DataFrame:
    """(_id, _items): every document whose bound reaches ``least``, with the items it may be among."""
    id_type = index.schema["ids"].dataType.elementType
    schema = S.StructType([S.StructField("_id", id_type), S.StructField("_items", S.ArrayType(S.IntegerType()))])

    def scan(batches):
        for width, n, slices, ids, size, most in _blocks(batches):
            item, doc = [], []
            for which, bounds in block_bounds(items.value, width, n, slices, size, most):
                i, d = np.nonzero(bounds >= least[which][:, None])
                item.append(np.array(which, np.int32)[i])
                doc.append(d)
            if not doc:
                continue
            item, doc = np.concatenate(item), np.concatenate(doc)
            order = np.argsort(doc, kind="stable")
            found, at = np.unique(doc[order], return_index=True)
            if len(found):
                lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(doc)), pa.int32()), pa.array(item[order]))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(found)), lists], names=schema.names)

    found = _blocks_of(index).mapInArrow(scan, schema)
    # rows that repeat an id are one key, with at most a shard's items
    return found.select("_id", F.explode("_items").alias("_item")).groupBy("_id").agg(
        F.collect_set("_item").alias("_items"))


def exact_scores(items: Items, column, wanted):
    """(row, item, score) arrays for the texts of a column, each against its wanted items."""
    n_terms = max(len(items.terms), 1)
    for a, size, doc, h, tf in term_counts(column):
        known, at = items.lookup(h)
        keys, tf = doc[known] * n_terms + at[known], tf[known]
        lists = [wanted[a + i].as_py() or [] for i in range(len(size))]
        row = np.repeat(np.arange(len(size)), [len(x) for x in lists])
        item = np.array([i for x in lists for i in x], np.int64)
        if not len(item) or not len(keys):
            continue
        order = np.argsort(keys)
        keys, tf = keys[order], tf[order]
        count = np.array([len(items.places[i]) for i in item])
        pair = np.repeat(np.arange(len(item)), count)
        place = np.concatenate([items.places[i] for i in item])
        value = np.concatenate([items.weights[items.places[i]] * items.times[i] for i in item])
        want = row[pair] * n_terms + place
        spot = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        on = keys[spot] == want
        m = items.norm(size)[row[pair[on]]]
        score = np.zeros(len(item), np.int64)
        np.add.at(score, pair[on], value[on] * saturation(tf[spot[on]], m))
        yield a + row, item, score


def _rescore(docs: DataFrame, wanted: DataFrame, items, k: int) -> DataFrame:
    """(_item, _id, score) of the documents' wanted items, each task's ``k`` best an item."""
    schema = S.StructType([S.StructField("_item", S.IntegerType()), docs.schema["_id"],
                           S.StructField("score", S.LongType())])
    pairs = docs.join(wanted.withColumnRenamed("_id", "_wid"), F.col("_id").eqNullSafe(F.col("_wid"))).select(
        "_id", "_t", "_items")

    def order(x):
        return -x[0], x[1] is not None, x[1]

    def scan(batches):
        best: dict[int, list] = {}
        kind = None
        for b in batches:
            kind = b.column(0).type
            for row, item, score in exact_scores(items.value, b.column(1), b.column(2)):
                on = score > 0
                row, item, score = row[on], item[on], score[on]
                by = np.argsort(item, kind="stable")
                cut = np.flatnonzero(np.diff(item[by])) + 1
                for part in np.split(by, cut) if len(by) else []:
                    s = score[part]
                    if len(s) > k:
                        part = part[s >= np.partition(s, len(s) - k)[len(s) - k]]
                    mine = best.setdefault(int(item[part[0]]), [])
                    mine += [(int(score[j]), b.column(0)[int(row[j])].as_py()) for j in part]
                    if len(mine) > 8 * k:
                        mine[:] = sorted(mine, key=order)[:k]
        if best:
            rows = [(i, x) for i, mine in best.items() for x in sorted(mine, key=order)[:k]]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in rows], pa.int32()), pa.array([x[1] for _, x in rows], kind),
                pa.array([x[0] for _, x in rows], pa.int64())], names=schema.names)

    return _best(pairs.mapInArrow(scan, schema), "score", k)


def search(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", max_shard_bytes: int = 4 << 20,
           index: DataFrame | None = None) -> DataFrame:
    """Each item's ``k`` best documents: (item id, rank from 1, document id, score).  ``index``: an index
    of these documents, if there is one."""
    spark = docs.sparkSession
    T.prepare(spark)
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"))
    q = queries.select(F.col(f"`{item_col}`").alias("i"), F.col(f"`{item_text_col}`").alias("t")).where(
        "t is not null").distinct()
    result = S.StructType([S.StructField(item_col, q.schema["i"].dataType), S.StructField("rank", S.IntegerType()),
                           S.StructField(id_col, d.schema["_id"].dataType), S.StructField("score", S.LongType())])
    total = q.agg(F.coalesce(F.sum(F.octet_length("t") + 64), F.lit(0))).first()[0]
    index = build_index(d, "_id", "_t") if index is None else index
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    shards = -(-total // max_shard_bytes)
    out = None
    for s in range(shards if n_docs else 0):
        rows = [tuple(r) for r in q.where(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == s).collect()]  # about max_shard_bytes
        items = Items(rows)
        if not len(items.terms):
            continue
        items.weigh(_document_frequencies(d, spark.sparkContext.broadcast(items)), n_docs, n_terms)
        shared = spark.sparkContext.broadcast(items)
        first = _first_probe(index, shared, k).groupBy("_id").agg(F.collect_set("_item").alias("_items"))
        seeds = _rescore(d, F.broadcast(first), shared, k)  # at most k documents for each item of the shard
        least = np.ones(len(rows))
        for r in seeds.groupBy("_item").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).collect():
            if r.n == k:
                least[r["_item"]] = r.s
        best = _rescore(d, _second_probe(index, shared, least), shared, k)
        names = spark.createDataFrame([(n, i) for n, i in enumerate(items.ids)], S.StructType([
            S.StructField("_item", S.IntegerType()), S.StructField("_name", q.schema["i"].dataType)]))
        got = best.join(F.broadcast(names), "_item").select(
            F.col("_name").alias(item_col), "rank", F.col("_id").alias(id_col), "score")
        out = got if out is None else out.unionByName(got)
    return spark.createDataFrame([], result) if out is None else out


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
