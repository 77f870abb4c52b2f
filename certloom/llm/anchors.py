"""Winnowed anchors: the shared way to find repeated windows of a corpus.

A window is ``size`` consecutive tokens (bytes or words) of one document.  Its anchor is the
smallest hash of its ``k``-token grams; consecutive windows with one anchor form a *run*.  Equal
windows have equal anchors, so every repeat of a window lies in runs with the same anchor hash and
nothing else need be compared.  A run row is small (hashes and a place); texts move only where two
different runs share an anchor.

Steps, each one Spark job over all documents:

1. count anchors (map-side combined); keep those that occur more than once;
2. join the runs with them (a plain shuffle join, which AQE splits on hot anchors);
3. group the joined runs by (anchor, content hash): equal runs need no text;
4. fetch the text of one run per content, where an anchor has several contents, and compare them in
   ``match``, group by group (groups over ``hot_group`` contents are anchored again by longer grams
   and dealt out anew, so no task gets an unbounded group);
5. turn the repeated windows into token spans per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T

LEVELS = 4  # times that windows of a hot anchor are anchored again
MAX_RUN = 256  # windows in one row; longer runs (periodic text) are cut, their pieces share the anchor


class Windows:
    """How a document is cut into windows: ``unit`` is "byte" or "word"."""

    def __init__(self, unit: str, size: int, k: int):
        self.unit, self.size, self.k = unit, size, k

    def tokens(self, buf, off):
        """Token starts, ends (bytes), token offsets per document, and token values."""
        if self.unit == "byte":
            return None, None, off, T.byte_values(buf)
        ws, we, woff = T.word_spans(buf, off, T.BLANKS)
        return ws, we, woff, T.word_hashes(buf, ws, we)

    def slices(self, column, limit: int = T.SLICE_BYTES):
        """(first row, first token, byte buffer, offsets): the slices of a column.  A text longer than
        ``limit`` comes in pieces that overlap, so that each of its windows is whole in just one."""
        for a, buf, off in T.text_slices(column, limit):
            if len(off) > 2 or len(buf) <= limit:
                yield a, 0, buf, off
                continue
            for first, part in self._pieces(buf, limit):
                yield a, first, part, np.array([0, len(part)])

    def _pieces(self, buf, limit):
        if self.unit == "byte":
            for lo in range(0, max(len(buf) - self.size + 1, 1), limit):
                yield lo, buf[lo:lo + limit + self.size - 1]
            return
        lo, first, reach = 0, 0, limit
        while True:
            hi = lo + reach
            while hi < len(buf) and not T.BLANKS[buf[hi]]:
                at = np.flatnonzero(T.BLANKS[buf[hi:hi + limit]])
                hi += int(at[0]) if len(at) else limit
            hi = min(hi, len(buf))
            ws, _, _ = T.word_spans(buf[lo:hi], np.array([0, hi - lo]), T.BLANKS)
            if hi < len(buf) and len(ws) < self.size:
                reach *= 2
                continue
            yield first, buf[lo:hi]
            if hi == len(buf):
                return
            done = len(ws) - self.size + 1
            lo, first, reach = lo + int(ws[done]), first + done, limit

    def runs(self, buf, off):
        """(document index, packed place, anchor, content hash) of each run.  The place holds the first
        window within the document, whether the anchor gram recurs in the run (periodic text may repeat
        a window there), and the number of windows."""
        ws, we, toff, values = self.tokens(buf, off)
        n, size, k = len(values), self.size, self.k
        empty = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, T.U64)] * 2
        if n < size:
            return empty
        at = np.arange(n - k + 1)
        grams = T.span_hash(T.span_sums(values), at, at + k)
        if self.unit == "word":  # rare grams make better anchors: prefer long ones
            length = np.minimum(we[k - 1:] - ws[:n - k + 1], 255).astype(T.U64)
            grams = ((T.U64(255) - length) << T.U64(56)) | (grams >> T.U64(8))
        lowest = T.leftmost_min(grams, size - k + 1)
        counts = np.maximum(np.diff(toff) - size + 1, 0)
        s = T.ranges(toff[:-1], counts)
        if not len(s):
            return empty
        place = lowest[s]
        v = grams[place]
        moved = np.ones(len(s), bool)
        moved[1:] = place[1:] != place[:-1]
        new = np.ones(len(s), bool)
        new[1:] = (v[1:] != v[:-1]) | (s[1:] != s[:-1] + 1)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(s)))
        again = np.add.reduceat(moved, first, dtype=np.int64) > 1
        if length.max() > MAX_RUN:
            pieces = -(-length // MAX_RUN)
            extra = T.ranges(np.zeros(len(first), np.int64), pieces) * MAX_RUN
            length = np.minimum(np.repeat(length, pieces) - extra, MAX_RUN)
            first, again = np.repeat(first, pieces) + extra, np.repeat(again, pieces)
        start = s[first]
        doc = np.searchsorted(toff, start, "right") - 1
        lane = T.span_sums(T.mix(values ^ T.U64(0xA5A5A5A5A5A5A5A5)))
        seg = T.span_hash(lane, start, start + length + size - 1)
        relative = start - toff[doc]
        return doc, (relative << 16) | (again.astype(np.int64) << 15) | length, v[first], seg

    def cut(self, buf, off, doc, start, n) -> list[bytes]:
        """The text of each run of ``n`` windows from window ``start`` of its document."""
        raw, end = buf.tobytes(), start + n + self.size - 1
        if self.unit == "byte":
            base = off[doc]
            return [raw[i:j] for i, j in zip((base + start).tolist(), (base + end).tolist(), strict=True)]
        ws, we, woff = T.word_spans(buf, off, T.BLANKS)
        first, last = ws[woff[doc] + start], we[woff[doc] + end - 1]
        return [raw[i:j] for i, j in zip(first.tolist(), last.tolist(), strict=True)]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(_k long, _t text, _row struct of the other columns), and whether ``_k`` is the id: it is where
    ids are unique integers; else all rows get keys in the order (id, text)."""
    T.prepare(docs.sparkSession)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    d = docs.select(F.col(f"`{id_col}`").alias("_k"), F.col(f"`{text_col}`").alias("_t"), rest.alias("_row"))
    integer = dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint")
    if integer:
        ids = docs.select(F.col(f"`{id_col}`").alias("_k")).groupBy("_k").count()
        if ids.where((F.col("count") > 1) | F.col("_k").isNull()).limit(1).count() == 0:
            return d.withColumn("_k", F.col("_k").cast("long")), True
    return T.materialize(d.orderBy(F.col("_k").asc_nulls_first(), "_t").withColumn(
        "_k", F.monotonically_increasing_id())), False


def scan_runs(docs: DataFrame, how: Windows, full: bool, across_documents: bool = False) -> DataFrame:
    """One row per run; without ``full`` only the anchor and what counts it: the document, or 2 for
    an anchor that recurs in its run and 1 for another."""
    schema = pa.schema([("h", pa.int64())] + ([("seg", pa.int64()), ("k", pa.int64()), ("p", pa.int64())]
                                               if full else [("k", pa.int64())]))
    ddl = "h long, seg long, k long, p long" if full else "h long, k long"

    def scan(batches):
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for a, first, buf, off in how.slices(b.column(1)):
                doc, place, h, seg = how.runs(buf, off)
                if len(h):
                    cols = {"h": h.view(np.int64)}
                    if full:
                        cols |= {"k": keys[a + doc], "seg": seg.view(np.int64), "p": place + (first << 16)}
                    else:
                        cols["k"] = keys[a + doc] if across_documents else 1 + (place >> 15 & 1)
                    yield T.batch(schema, **cols)

    return docs.select("_k", "_t").mapInArrow(scan, ddl)


def pack(docs: DataFrame) -> DataFrame:
    """Documents with the text compressed, so that it crosses shuffles small."""
    row = docs.schema["_row"].dataType

    def shrink(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            text = b.column(1).cast(pa.large_binary())
            out = pa.array([z.compress(x.as_buffer()) if x.is_valid else None for x in text], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), out, b.column(2)], names=["_k", "_z", "_row"])

    schema = S.StructType([S.StructField("_k", S.LongType()), S.StructField("_z", S.BinaryType()),
                           S.StructField("_row", row)])
    return docs.select("_k", "_t", "_row").mapInArrow(shrink, schema)


def unpack(z) -> bytes:
    return b"" if z is None else zstandard.ZstdDecompressor().decompress(z)


def repeated_runs(docs: DataFrame, how: Windows, across_documents: bool) -> DataFrame:
    """(h, seg, k, p): every run whose anchor also occurs elsewhere (in another document)."""
    counted = scan_runs(docs, how, False, across_documents).groupBy("h")
    if across_documents:
        often = counted.agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a < b")
    else:
        often = counted.agg(F.sum("k").alias("a")).where("a > 1")
    often = T.materialize(often.select("h"))
    return T.materialize(scan_runs(docs, how, True).join(often, "h"))


def _shared(g: DataFrame) -> DataFrame:
    """(h, n_seg) of the anchors with several contents, or one that may repeat a window in itself."""
    recurs = F.max(F.shiftright("p", 15).bitwiseAND(F.lit(1)))
    return g.groupBy("h").agg(F.count("*").alias("n_seg"), recurs.alias("r")).where("n_seg > 1 or r > 0")


def contents(runs: DataFrame, hot_group: int) -> tuple[DataFrame, DataFrame]:
    """One row per (h, seg): copies and first place; and those whose anchor has other contents."""
    g = runs.groupBy("h", "seg").agg(F.count("*").alias("c"), F.min(F.struct("k", "p")).alias("f"))
    g = T.materialize(g.select("h", "seg", "c", "f.k", "f.p"))
    per = T.materialize(_shared(g))  # read back, so that AQE may split this join on a hot anchor
    return g, g.join(per, "h").withColumn("hot", F.col("n_seg") > hot_group)


def fetch(docs_packed: DataFrame, wanted: DataFrame, how: Windows) -> DataFrame:
    """Text of the wanted runs: (h, seg, k, p, hot, body)."""
    per_doc = wanted.groupBy(F.col("k").alias("_k")).agg(
        F.collect_list(F.struct("h", "seg", "p", "hot")).alias("w"))  # bounded by the document's length
    schema = pa.schema([("h", pa.int64()), ("seg", pa.int64()), ("k", pa.int64()), ("p", pa.int64()),
                        ("hot", pa.bool_()), ("body", pa.binary())])

    def cut(batches):
        rows = T.Rows(schema)
        for b in batches:
            for key, z, w in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                buf = np.frombuffer(unpack(z.as_py()), np.uint8)
                h, seg, p, hot = (w.values.field(i).to_pylist() for i in range(4))
                place = np.array(p)
                bodies = how.cut(buf, np.array([0, len(buf)]), np.zeros(len(p), np.int64), place >> 16, place & 0x7FFF)
                for row in zip(h, seg, p, hot, bodies, strict=True):
                    rows.add(len(row[4]), row[0], row[1], key, *row[2:])
                yield from rows.take()
        yield from rows.take(last=True)

    joined = docs_packed.select("_k", "_z").join(per_doc.hint("shuffle_hash"), "_k")
    return joined.select("_k", "_z", "w").mapInArrow(
        cut, "h long, seg long, k long, p long, hot boolean, body binary")


GROUP_SCHEMA = pa.schema([("h", pa.int64()), ("seg", pa.int64()), ("a", pa.int32()), ("b", pa.int32()),
                          ("earlier", pa.bool_())])
GROUP_DDL = "h long, seg long, a int, b int, earlier boolean"


def grouped(batches, limit: int):
    """Whole groups of a stream sorted by ``h``, as tables of about ``limit`` bytes or one group."""
    kept, size = [], 0
    for b in batches:
        if b.num_rows:
            kept.append(b)
            size += b.nbytes
        if size >= limit:
            t = pa.Table.from_batches(kept).combine_chunks()
            h = t.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1], "left"))
            if cut:
                yield t.slice(0, cut)
            t = t.slice(cut)
            kept, size = t.to_batches(), t.nbytes if cut else 0
    if kept:
        t = pa.Table.from_batches(kept).combine_chunks()
        if t.num_rows:
            yield t


def compare(bodies: DataFrame, match, how: Windows, by_document: bool, hot_group: int, level: int = 0) -> DataFrame:
    """(h, seg, w): windows [a, b) of a content that also occur in another content of the same anchor;
    ``earlier`` says that one of those comes first (in an earlier document, if ``by_document``)."""
    bodies = T.materialize(bodies)
    cold = bodies.where(~F.col("hot")).select("h", "seg", "k", "p", "body")
    found = cold.repartition("h").sortWithinPartitions("h", "k", "p").mapInArrow(match, GROUP_DDL)
    found = found.groupBy("h", "seg").agg(F.collect_list(F.struct("a", "b", "earlier")).alias("w"))  # <= MAX_RUN
    if level < LEVELS and bodies.where("hot").limit(1).count():
        found = found.unionByName(_compare_finer(bodies.where("hot"), match, how, by_document, hot_group, level + 1))
    return found


def _compare_finer(hot: DataFrame, match, how: Windows, by_document: bool, hot_group: int, level: int) -> DataFrame:
    """The same for anchors with more contents than one task should get: their windows are anchored
    again by longer grams, which fewer contents share (at the last level by the whole window, so that a
    group is one window's copies).  Equal stretches are again compared once and copies only counted."""
    finer = Windows(how.unit, how.size, how.k + (how.size - how.k) * level // LEVELS)
    names = ("h", "seg", "k", "p")
    schema = pa.schema([(c, pa.int64()) for c in (*names, "h2", "seg2", "o", "q")] + [("body", pa.binary())])

    def split(batches):
        for b in batches:
            for a, buf, off in T.text_slices(b.column(4)):
                doc, place, h2, seg2 = finer.runs(buf, off)
                if len(h2):
                    cols = {c: b.column(i).to_numpy()[a + doc] for i, c in enumerate(names)}
                    start = place >> 16
                    at = ((cols["p"] >> 16) + start) << 16 | (place & 0xFFFF)
                    yield T.batch(schema, **cols, h2=h2.view(np.int64), seg2=seg2.view(np.int64), o=start, q=at,
                                  body=finer.cut(buf, off, doc, start, place & 0x7FFF))

    rows = T.materialize(hot.select(*names, "body").mapInArrow(
        split, "h long, seg long, k long, p long, h2 long, seg2 long, o long, q long, body binary"))
    known = T.materialize(rows.groupBy("h2", "seg2").agg(
        F.count("*").alias("c"), F.min(F.struct("k", "q")).alias("f")).select("h2", "seg2", "c", "f.k", "f.q"))
    per = T.materialize(_shared(known.select(F.col("h2").alias("h"), F.col("q").alias("p"))))
    chosen = known.join(per.withColumnRenamed("h", "h2"), "h2")
    chosen = rows.join(chosen.select("h2", "seg2", "k", "q", "n_seg"), ["h2", "seg2", "k", "q"])
    limit = hot_group if level < LEVELS else (1 << 62)
    found = compare(chosen.select(F.col("h2").alias("h"), F.col("seg2").alias("seg"), "k", F.col("q").alias("p"),
                                  (F.col("n_seg") > limit).alias("hot"), "body"),
                    match, how, by_document, hot_group, level)
    found = found.withColumnsRenamed({"h": "h2", "seg": "seg2"})
    state = known.withColumnRenamed("k", "k0").withColumnRenamed("q", "q0").join(found, ["h2", "seg2"], "left")
    state = T.materialize(state.where("c > 1 or w is not null"))
    later = F.col("k") > F.col("k0")
    if not by_document:
        later = later | ((F.col("k") == F.col("k0")) & (F.col("q") > F.col("q0")))
    n = F.col("q").bitwiseAND(F.lit(0x7FFF)).cast("int")
    whole = F.array(F.struct(F.lit(0).alias("a"), n.alias("b"), later.alias("earlier")))
    nothing = F.array().cast("array<struct<a:int,b:int,earlier:boolean>>")
    spans = F.concat(F.when(F.col("c") > 1, whole).otherwise(nothing),
                     F.when(later, nothing).otherwise(F.coalesce("w", nothing)))
    moved = F.transform(spans, lambda x: F.struct(
        (x["a"] + F.col("o")).cast("int").alias("a"), (x["b"] + F.col("o")).cast("int").alias("b"),
        x["earlier"].alias("earlier")))
    out = rows.drop("body").join(state, ["h2", "seg2"]).select("h", "seg", moved.alias("w"))
    return out.groupBy("h", "seg").agg(F.flatten(F.collect_list("w")).alias("w"))  # at most MAX_RUN windows


def repeated_spans(docs: DataFrame, packed: DataFrame, how: Windows, match, *, by_document: bool,
                   first_stays: bool, hot_group: int) -> DataFrame:
    """(_k, spans array<struct<s, e>>): token spans covered by repeated windows.  With ``first_stays``
    only windows with an earlier copy count, else those with any other copy."""
    runs = repeated_runs(docs, how, by_document)
    known, shared = contents(runs, hot_group)
    found = compare(fetch(packed, shared, how), match, how, by_document, hot_group)
    wanted = F.filter("w", lambda x: x["earlier"]) if first_stays else F.col("w")
    per = found.select("h", "seg", F.transform(wanted, lambda x: F.struct(
        x["a"].alias("a"), x["b"].alias("b"))).alias("w")).where(F.size("w") > 0)
    state = known.join(per, ["h", "seg"], "left").where("c > 1 or w is not null")
    state = T.materialize(state.select("h", "seg", "c", F.col("k").alias("k0"), F.col("p").alias("p0"), "w"))
    j = runs.join(state, ["h", "seg"])
    if by_document:
        whole = F.col("k") > F.col("k0")
    elif first_stays:
        whole = (F.col("k") > F.col("k0")) | (F.col("p") > F.col("p0"))
    else:
        whole = F.col("c") > 1
    start, n = F.shiftright("p", 16), F.col("p").bitwiseAND(F.lit(0x7FFF))
    all_of = F.array(F.struct(F.lit(0).alias("a"), n.cast("int").alias("b")))
    j = j.select("k", start.alias("start"), F.inline(F.when(whole, all_of).otherwise(F.col("w"))))
    return j.groupBy(F.col("k").alias("_k")).agg(F.collect_list(F.struct(
        (F.col("start") + F.col("a")).alias("s"), (F.col("start") + F.col("b") + (how.size - 1)).alias("e"),
    )).alias("spans"))  # bounded by the document's length
