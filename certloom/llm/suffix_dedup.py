"""Substring dedup on bytes with longest-previous-factor arrays.

Stretches of text that share a winnowed anchor (see ``anchors``) are laid out in document order and
their windows are put in suffix order by prefix ranks.  For each window the previous and the next
entry in suffix order that start earlier in the text (previous and next smaller positions) hold its
longest previous factor, so comparing with these two finds every earlier match; the same arrays from
the other side give later matches.  Factors are compared up to ``size`` bytes, the length that
matters.  ``keep="first"`` removes later copies and keeps the first; ``keep="none"`` removes every
byte of a repeated window, the first copy too.

Defined results: null text counts as empty; texts under ``size`` bytes lose nothing; rows that repeat an id,
or have none, are ordered by (id, text) and count as documents of their own; other columns pass through
whatever their names, but one named like a result column gives way to it; an empty table gives an empty
result. A cut may fall inside a UTF-8 character, so the kept text is a binary column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import anchors as A
from . import textops as T


def _dense(key: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct values."""
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


def prefix_ranks(buf: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the ``size``-byte strings at ``starts``, by prefix multiplying (three equal parts at
    a time where the ranks fit); every start must have
    ``size`` bytes after it."""
    n, m = len(buf), 1
    rank = buf.astype(np.int64)
    if size >= 8:
        padded = np.concatenate((buf, np.zeros(8, np.uint8)))
        word = np.zeros(n, T.U64)
        for i in range(8):
            word = (word << T.U64(8)) | padded[i:i + n]
        rank, m = _dense(word), 8
    parts = 3 if (n + 1) ** 3 < 1 << 62 else 2  # ranks that fit into one sort key

    def joined(offsets, at=None):
        key = np.zeros(n if at is None else len(at), np.int64)
        for o in offsets:
            if at is None:
                key *= n + 1
                key[:max(n - o, 0)] += rank[o:] + 1
            else:
                key = key * (n + 1) + rank[at + o]
        return _dense(key)

    while m * parts < size:
        rank = joined([m * i for i in range(parts)])
        m *= parts
    return joined([0, min(m, size - m), size - m] if parts == 3 else [0, size - m], starts)


def smaller_neighbours(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the nearest earlier and nearest later entry with a smaller value (-1 and n if
    none), by pointer jumping."""
    def left(x):
        x = np.concatenate(([x.min() - 1], x))
        p = np.arange(-1, len(x) - 1)
        p[0] = 0
        open_ = np.flatnonzero(x[p] > x)
        while len(open_):
            p[open_] = p[p[open_]]
            open_ = open_[x[p[open_]] > x[open_]]
        return p[1:] - 1
    return left(position), len(position) - 1 - left(position[::-1])[::-1]


def factor_flags(rank: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous factor of each window (by ``position``) has full length, and the
    same for the longest later factor."""
    low = position.min()
    order = np.argsort(rank * (position.max() - low + 1) + (position - low))
    r, p = rank[order], position[order]
    out = []
    for sign in (1, -1):
        found = np.zeros(len(r), bool)
        for near in smaller_neighbours(sign * p):
            ok = (near >= 0) & (near < len(r))
            found[ok] |= r[near[ok]] == r[ok]
        flags = np.empty(len(r), bool)
        flags[order] = found
        out.append(flags)
    return out[0], out[1]


def _match(size: int, limit: int = 1 << 18):
    def match(batches):
        for t in A.grouped(batches, limit):
            h, seg = t.column("h").to_numpy(), t.column("seg").to_numpy()
            buf, off = T.text_buffer(t.column("body"))
            n = np.maximum(np.diff(off) - size + 1, 0)
            starts = T.ranges(off[:-1], n)  # rows are in document order within an anchor
            if not len(starts):
                continue
            row = np.repeat(np.arange(len(n)), n)
            rank = prefix_ranks(buf, starts, size)
            _, group = np.unique(h, return_inverse=True)
            rank = _dense(rank * (group.max() + 1) + group[row])
            at = np.arange(len(starts))
            earlier, later = factor_flags(rank, at)
            for mask, flag in ((earlier, True), (later & ~earlier, False)):
                # runs of windows that do not pass from one row to the next
                edge = np.ones(len(mask) + 1, bool)
                edge[1:-1] = (mask[1:] != mask[:-1]) | (row[1:] != row[:-1])
                cuts = np.flatnonzero(edge)
                a, b = cuts[:-1], cuts[1:]
                a, b = a[mask[a]], b[mask[a]]
                if len(a):
                    i, base = row[a], starts[a] - off[row[a]]
                    yield T.batch(A.GROUP_SCHEMA, h=h[i], seg=seg[i], a=base.astype(np.int32),
                                  b=(base + b - a).astype(np.int32), earlier=np.full(len(a), flag))
    return match


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 200,
                   keep: str = "first", hot_group: int = 2000, out_col: str = "repeats") -> DataFrame:
    """The columns of ``docs`` but the text, plus a struct column ``repeats``: ``n_bytes``, ``n_removed``,
    ``spans`` (maximal removed byte ranges) and ``kept`` (the remaining bytes)."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    how = A.Windows("byte", size, max(1, min(32, size // 2)))
    keyed, _ = A.keyed(docs, id_col, text_col)
    packed = A.pack(keyed)
    spans = A.repeated_spans(keyed, packed, how, _match(size), by_document=False, first_stays=keep == "first",
                             hot_group=hot_group)
    span = S.ArrayType(S.StructType([S.StructField("s", S.LongType()), S.StructField("e", S.LongType())]))
    schema = S.StructType([
        S.StructField("_kept", S.BinaryType()), S.StructField("_n", S.LongType()), S.StructField("_cut", S.LongType()),
        S.StructField("_spans", span), keyed.schema["_row"]])

    def cut(batches):
        for b in batches:
            rows = T.Rows(pa.schema([
                ("_kept", pa.binary()), ("_n", pa.int64()), ("_cut", pa.int64()),
                ("_spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                pa.field("_row", b.column(2).type)]))
            for z, w, row in zip(*(b.column(i) for i in range(3)), strict=True):
                raw = A.unpack(z.as_py())
                left, lost = raw, []
                if w.values is not None and len(w.values):
                    s, e = (w.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    lost = T.merge_spans(s, e)
                    edges = [0, *(x for span in lost for x in span), len(raw)]
                    left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.add(len(raw), left, len(raw), len(raw) - len(left),
                         [{"s": s, "e": e} for s, e in lost], row.as_py())
                yield from rows.take()
            yield from rows.take(last=True)

    joined = packed.join(spans.hint("shuffle_hash"), "_k", "left").select("_z", "spans", "_row")
    out = joined.mapInArrow(cut, schema)
    cols = [F.col(f"_row.`{c}`").alias(c) for c in T.beside(docs.columns, text_col, out_col)]
    repeats = F.struct(F.col("_n").alias("n_bytes"), F.col("_cut").alias("n_removed"),
                       F.col("_spans").alias("spans"), F.col("_kept").alias("kept"))
    return out.select(*cols, repeats.alias(out_col))


def digest(docs: DataFrame) -> DataFrame:
    d = remove_repeats(docs.select("doc_id", "text"), keep="none")
    return d.select("doc_id", "repeats.n_bytes", "repeats.n_removed",
                    F.size("repeats.spans").cast("long").alias("n_spans"),
                    F.sha2(F.col("repeats.kept"), 256).alias("kept_sha256"))
