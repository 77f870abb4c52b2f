"""Substring dedup on words with suffix automata.

The reference of a document is every document with a smaller key.  A suffix automaton of the whole
corpus can be neither built in one task nor broadcast (it grows with the data), so the reference is
sharded by winnowed anchor (see ``anchors``): a shard holds one copy of each distinct stretch of
text that has the anchor, in document order.  In a shard the stretches are streamed through the
automaton of the earlier documents for matching statistics (longest match ending at each word), then
added to it.  Equal windows have equal anchors, so each window meets all its possible copies; spans
of ``size`` words or more that occur earlier are removed, the first copy stays.

Defined results: null text has no words and stays null; empty texts and texts under ``size`` words lose
nothing; rows that repeat a document id, or have none, are ordered by (id, text) and count as documents of
their own; other columns pass through whatever their names, but one named like a result column gives way to
it; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import anchors as A
from . import textops as T


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def _state(self, length, edges, link):
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p, q, word):
        nxt, link, length = self.next, self.link, self.length
        clone = self._state(length[p] + 1, dict(nxt[q]), link[q])
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        link[q] = clone
        return clone

    def add(self, words) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, q, word)
                continue
            p, last = last, self._state(length[last] + 1, {}, 0)
            while p >= 0 and word not in nxt[p]:
                nxt[p][word] = last
                p = link[p]
            if p >= 0:
                q = nxt[p][word]
                link[last] = q if length[q] == length[p] + 1 else self._split(p, q, word)

    def matches(self, words):
        """Longest match that ends at each word."""
        nxt, link, length = self.next, self.link, self.length
        v = n = 0
        for word in words:
            while v and word not in nxt[v]:
                v = link[v]
                n = length[v]
            to = nxt[v].get(word)
            if to is None:
                n = 0
            else:
                v, n = to, n + 1
            yield n


def _shards(size: int, limit: int = 1 << 20):
    def match(batches):
        for t in A.grouped(batches, limit):
            h, seg, k = (t.column(c).to_numpy() for c in ("h", "seg", "k"))
            bodies = t.column("body").to_pylist()
            edges = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True])))
            out = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if hi - lo < 2 or k[lo] == k[hi - 1]:
                    continue
                automaton, waiting = SuffixAutomaton(), []
                for i in range(lo, hi):
                    words = bodies[i].split()
                    if waiting and k[i] != k[i - 1]:
                        for w in waiting:
                            automaton.add(w)
                        waiting = []
                    if k[i] != k[lo]:
                        begin = None
                        for end, n in enumerate(automaton.matches(words), 1):
                            if n >= size:
                                begin = end - size if begin is None else begin
                            elif begin is not None:
                                out.append((i, begin, end - size))
                                begin = None
                        if begin is not None:
                            out.append((i, begin, len(words) - size + 1))
                    waiting.append(words)
            if out:
                i, a, b = map(np.array, zip(*out, strict=True))
                yield T.batch(A.GROUP_SCHEMA, h=h[i], seg=seg[i], a=a.astype(np.int32), b=b.astype(np.int32),
                              earlier=np.ones(len(i), bool))
    return match


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13,
                   rejoin_all: bool = False, hot_group: int = 2000, out_col: str = "repeats") -> DataFrame:
    """``docs`` with the words of repeated spans removed from the text, plus a struct column ``repeats``:
    ``n_words``, ``n_removed`` and ``spans`` (removed word ranges).  Kept words are joined by one space;
    a text that loses nothing is left as it is unless ``rejoin_all``."""
    how = A.Windows("word", size, max(1, min(3, size)))
    keyed, _ = A.keyed(docs, id_col, text_col)
    packed = A.pack(keyed)
    spans = A.repeated_spans(keyed, packed, how, _shards(size), by_document=True, first_stays=True,
                             hot_group=hot_group)
    span = S.ArrayType(S.StructType([S.StructField("s", S.LongType()), S.StructField("e", S.LongType())]))
    schema = S.StructType([
        S.StructField("_k", S.LongType()), S.StructField("_t", S.StringType()), S.StructField("_n", S.LongType()),
        S.StructField("_cut", S.LongType()), S.StructField("_spans", span), keyed.schema["_row"]])

    def cut(batches):
        for b in batches:
            rows = T.Rows(pa.schema([
                ("_k", pa.int64()), ("_t", pa.string()), ("_n", pa.int64()), ("_cut", pa.int64()),
                ("_spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                pa.field("_row", b.column(3).type)]))
            for key, z, w, row in zip(*(b.column(i) for i in range(4)), strict=True):
                z = z.as_py()
                raw = A.unpack(z)
                words = raw.split()
                left, lost = words, []
                if w.values is not None and len(w.values):
                    s, e = (w.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    lost = T.merge_spans(s, e)
                    left, at = [], 0
                    for s, e in lost:
                        left += words[at:s]
                        at = e
                    left += words[at:]
                text = None if z is None else (b" ".join(left) if lost or rejoin_all else raw).decode()
                rows.add(len(raw), key.as_py(), text, len(words), len(words) - len(left),
                         [{"s": s, "e": e} for s, e in lost], row.as_py())
                yield from rows.take()
            yield from rows.take(last=True)

    joined = packed.join(spans.hint("shuffle_hash"), "_k", "left").select("_k", "_z", "spans", "_row")
    out = joined.mapInArrow(cut, schema)
    cols = [F.col("_t").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c)
            for c in T.beside(docs.columns, out_col)]
    repeats = F.struct(F.col("_n").alias("n_words"), F.col("_cut").alias("n_removed"), F.col("_spans").alias("spans"))
    return out.select(*cols, repeats.alias(out_col))


def digest(docs: DataFrame) -> DataFrame:
    d = remove_repeats(docs.select("doc_id", "text"), rejoin_all=True)
    return d.select("doc_id", "repeats.n_words", "repeats.n_removed",
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
