"""G-family fan-out: one ID expression row -> one row per item ID.

The parse (``functions.ids``) yields compact segments.  This operator expands
them in two levels so that no single row ever holds a huge array:

  1. ``posexplode(segments)``      -> one row per segment (with its ID offset)
  2. ``explode(chunk numbers)``    -> one row per chunk of ``chunk_size`` IDs
  3. optional ``repartition``      -> spread the chunks of a huge range (and of nothing else)
  4. ``explode(sequence(lo, hi))`` -> one row per ID

so a range of a billion IDs is a million chunk rows that Spark can spread over
the cluster instead of one task building a billion-element array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import low_start, render_id

DEFAULT_CHUNK = 4096
OFFSET_BLOCK = 256
#: IDs of one segment that are dealt to a task as one row.
DEAL = 1 << 20


def with_offsets(segs):
    """Attach to every segment the number of IDs that precede it: one fold carries the sum to the next block of
    ``OFFSET_BLOCK`` segments, a short fold within the block gives each its own.  A list of single IDs (however
    long) needs no sums."""
    zero = F.lit(0).cast("bigint")

    def total(part, start):
        return F.aggregate(part, start, lambda a, g: a + g["n"])
    firsts = F.sequence(F.lit(1), F.size(segs), F.lit(OFFSET_BLOCK))
    # the sums before each block: [0, s1, s1 + s2, ...]
    before = F.aggregate(firsts, F.array(zero), lambda acc, k: F.concat(acc, F.array(
        total(F.slice(segs, k, OFFSET_BLOCK), F.element_at(acc, -1)))))
    counted = F.flatten(F.transform(F.arrays_zip(firsts.alias("k"), F.slice(before, F.lit(1), F.size(firsts)).alias("b")),
                                    lambda x: _block_offsets(F.slice(segs, x["k"], OFFSET_BLOCK), x["b"])))
    singles = F.transform(segs, lambda g, k: F.struct(g.alias("g"), k.cast("bigint").alias("offset")))
    return F.when(F.forall(segs, lambda g: g["n"] == 1), singles).when(
        F.size(segs) <= OFFSET_BLOCK, _block_offsets(segs, zero)).otherwise(counted)


def _block_offsets(part, start):
    return F.transform(part, lambda g, i: F.struct(g.alias("g"), F.aggregate(
        F.slice(part, F.lit(1), i), start, lambda a, x: a + x["n"]).alias("offset")))


def explode_ids(df: DataFrame, segs_col: str = "id_segments", *, id_col: str = "id_number",
                idx_col: str = "id_idx", chunk_size: int = DEFAULT_CHUNK,
                rebalance_cols=None, segment_col: str | None = None, tasks: int | None = None) -> DataFrame:
    """Expand ``segs_col`` into ``id_col`` (string) and ``idx_col`` (0-based
    position of the ID inside its expression); ``segment_col``, if named, is the place of the ID's segment.

    ``rebalance_cols``: when given, the chunks of segments of more than one chunk are hash-repartitioned on these
    columns plus the chunk's place, so that the IDs of one huge range are produced by many tasks; all other segments
    are expanded where they are, without a shuffle.  ``tasks``: all segments are dealt over so many tasks, a row for
    each ``DEAL`` IDs (for expressions of many IDs, however few tasks read them), and cut into chunks there."""
    other = [c for c in df.columns if c != segs_col]
    segs, n = F.col(segs_col), F.col("_n")

    def by_segment(d):
        d = d.select(*other, F.posexplode(with_offsets(segs)).alias("_seg_idx", "_seg"))
        # flat columns from here on (keeps nested-field pruning out of the generators)
        return d.select(*other, "_seg_idx", F.col("_seg.g.prefix").alias("_pfx"),
                        F.col("_seg.g.start").alias("_st"), F.col("_seg.g.n").alias("_n"),
                        F.col("_seg.g.suffix").alias("_sfx"), F.col("_seg.g.pad").alias("_pad"),
                        F.col("_seg.offset").alias("_off")).where(n > 0)
    last_chunk = F.floor((n + chunk_size - 1) / chunk_size).cast("bigint") - 1

    def chunks(d):
        return d.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_chunk"))
    if rebalance_cols:
        large = by_segment(df.where(F.exists(segs, lambda g: g["n"] > chunk_size))).where(n > chunk_size)
        spread = chunks(large).repartition(*[F.col(c) for c in rebalance_cols], F.col("_seg_idx"), F.col("_chunk"))
        step2 = by_segment(df).where(n <= chunk_size).withColumn("_chunk", F.lit(0).cast("bigint")).unionByName(spread)
    elif tasks:
        each = max(DEAL // chunk_size, 1)  # chunks of a dealt row
        dealt = by_segment(df).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(
            last_chunk / each).cast("bigint"))).alias("_deal"))
        dealt = dealt.repartition(tasks, *[F.col(c) for c in other], F.col("_seg_idx"), F.col("_deal"))
        first = F.col("_deal") * each
        step2 = dealt.select("*", F.explode(F.sequence(first, F.least(first + each - 1, last_chunk))).alias("_chunk"))
    else:
        step2 = chunks(by_segment(df))
    lo = F.col("_chunk") * chunk_size
    hi = F.least(lo + chunk_size, n) - 1
    step3 = step2.select("*", low_start(F.col("_st"), n).alias("_low"), F.explode(F.sequence(lo, hi)).alias("_i"))
    g = F.struct(F.col("_pfx").alias("prefix"), F.col("_st").alias("start"), F.col("_n").alias("n"),
                 F.col("_sfx").alias("suffix"), F.col("_pad").alias("pad"))
    out = [*other, render_id(g, F.col("_i"), F.col("_low")).alias(id_col), (F.col("_off") + F.col("_i")).alias(idx_col)]
    return step3.select(*out, *([F.col("_seg_idx").alias(segment_col)] if segment_col else []))
