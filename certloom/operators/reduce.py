"""Reductions and windows: A1, A2, A5, A6, W1, W2, J7."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys, pos_col: str, value_cols, first_pos_col: str = "first_pos") -> DataFrame:
    """A1: dict upsert semantics.  Per key the values of the row with the
    greatest position win, while the key keeps the position of its *first*
    appearance (the order of the output table).  One shuffle on the keys;
    partial aggregation runs map-side.  Null fields survive because the values
    travel as one struct."""
    payload = F.struct(*[F.col(c) for c in value_cols])
    agg = df.groupBy(*keys).agg(
        F.max_by(payload, F.col(pos_col)).alias("_last"),
        F.min(pos_col).alias(first_pos_col),
    )
    return agg.select(*keys, first_pos_col, *[F.col("_last." + c).alias(c) for c in value_cols])


DIGITS = (10, 10, 10, 8)  # page, table and row are ints, an expression has under 10**8 segments


def pack_position(page, table, row, segment) -> F.Column:
    """One DECIMAL(38,0) that orders like (page, table, row, segment), so that its minimum and maximum are
    hash-aggregated.  Each part has decimal digits of its own, enough for any non-negative int."""
    place, out = sum(DIGITS), None
    for part, digits in zip((page, table, row, segment), DIGITS, strict=True):
        place -= digits
        scaled = (F.col(part).cast(f"decimal({digits},0)") * F.lit(str(10**place)).cast(f"decimal({place + 1},0)")).cast(
            "decimal(38,0)")
        out = scaled if out is None else (out + scaled).cast("decimal(38,0)")
    return out


def position_part(pos: str, which: int) -> F.Column:
    """The page (0), table (1) or row (2) of a packed position."""
    text = F.lpad(F.col(pos).cast("string"), sum(DIGITS), "0")
    return text.substr(sum(DIGITS[:which]) + 1, DIGITS[which]).cast("int")


def last_wins_ids(ids: DataFrame, items: DataFrame, value_cols, item_key=("doc_id", "page_no", "table_no", "row_no")):
    """A1 after the ID fan-out: ``ids`` has (doc_id, id_number, page_no, table_no, row_no, id_idx, segment),
    ``items`` one row per ``item_key`` with the values.  Only keys and packed positions are shuffled and
    aggregated; the winning item's values are joined afterwards.  Any non-negative int is a table or row number."""
    agg = ids.select("doc_id", "id_number", "id_idx", pack_position("page_no", "table_no", "row_no", "segment").alias(
        "_p")).groupBy("doc_id", "id_number").agg(
            F.max("_p").alias("_hi"), F.min("_p").alias("_lo"), F.min_by("id_idx", "_p").alias("_idx"))
    parts = ("page_no", "table_no", "row_no")
    won = agg.select(
        "doc_id", "id_number",
        F.struct(*[position_part("_lo", i).alias(n) for i, n in enumerate(parts)], F.col("_idx").alias("id_idx")).alias(
            "first_pos"), *[position_part("_hi", i).alias(n) for i, n in enumerate(parts)])
    return won.join(items.select(*item_key, *value_cols), list(item_key)).select(
        "doc_id", "id_number", "first_pos", *value_cols)


def last_nonnull(df: DataFrame, keys, pos_col: str, value_cols) -> DataFrame:
    """A2: per group, the last non-null value of each column by position."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos_col))).alias(c) for c in value_cols]
    return df.groupBy(*keys).agg(*aggs)


def distinct_ids(df: DataFrame, keys=("doc_id", "id_number")) -> DataFrame:
    """The distinct item keys."""
    return df.select(*keys).distinct()


def number_rows(df: DataFrame, part_col: str, order_col: str, out_col: str = "row_no", start: int = 1,
                block: F.Column | None = None, skew_safe: bool = True, stored: bool = False) -> DataFrame:
    """``row_number() over (partition by part order by order)`` + offset.

    ``skew_safe=False`` is the plain window (one task per partition key, so a document holding a third of all
    rows lands in one task).  The default numbers by prefix sums: ``block`` is a column that never falls along
    the order and holds a bounded number of rows (a page, or a stretch of a page); rows are numbered within
    their block, and a small table of counts per (key, block) gives each block its offset.  One shuffle of the
    rows, on (key, block); the counts are combined before theirs and join without another one.  The order column
    must be unique within a key.  Without ``block`` the order's first field is taken.  ``stored``: the input is
    already stored, so reading it twice runs nothing twice."""
    order = Window.partitionBy(part_col).orderBy(order_col)
    if not skew_safe:
        return df.withColumn(out_col, F.row_number().over(order) + (start - 1))
    if not stored:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    if block is None:
        kind = df.schema[order_col].dataType
        block = F.col(order_col)[kind.names[0]] if hasattr(kind, "names") else F.col(order_col)
    tagged = df.withColumn("_block", block)
    before = Window.partitionBy(part_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = tagged.groupBy(part_col, "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        part_col, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(part_col, "_block").orderBy(order_col)
    out = tagged.withColumn("_place", F.row_number().over(within)).join(counts, [part_col, "_block"])
    return out.select(*df.columns, (F.col("_before") + F.col("_place") + (start - 1)).cast("bigint").alias(out_col))


#: IDs of one expression that are numbered in one task.
NUMBER_BLOCK = 1 << 16


def number_block(pos_col: str = "first_pos") -> F.Column:
    """A grid row and a stretch of ``NUMBER_BLOCK`` of its IDs, as :func:`number_rows` needs it for items."""
    pos = F.col(pos_col)
    return F.struct(pos["page_no"].alias("p"), pos["table_no"].alias("t"), pos["row_no"].alias("r"),
                    F.floor(pos["id_idx"] / NUMBER_BLOCK).cast("bigint").alias("i"))


def running_errors(df: DataFrame, part_cols, order_col: str, errors_col: str = "errors",
                   out_col: str = "running_errors") -> DataFrame:
    """W2 (reference-compatible error leak): each row carries the errors of
    every earlier row of its page plus its own.  Windows are per page, so
    partitions stay page-sized."""
    w = Window.partitionBy(*part_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out_col, F.flatten(F.collect_list(F.col(errors_col)).over(w)))


def stamp(df: DataFrame, page_attrs: DataFrame, keys, attr_cols) -> DataFrame:
    """Page-level attributes stamped on every item of the page (equi-join
    on the page key; the page table is one row per page)."""
    return df.drop(*[c for c in attr_cols if c in df.columns]).join(
        page_attrs.select(*keys, *attr_cols), list(keys), "left")


def extraction_summary(items: DataFrame, page_errors: DataFrame, group_col: str = "client") -> DataFrame:
    """A5: items and error pages per client."""
    it = items.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_items"),
                                      F.countDistinct("doc_id").alias("n_docs"))
    er = page_errors.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_error_pages"))
    return it.join(er, group_col, "full").select(
        group_col, F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("n_error_pages", F.lit(0)).alias("n_error_pages"))
