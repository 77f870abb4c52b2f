"""Manufacturer / model dictionary lookups: J1-J5, J8, J9.

The dictionary has two ordered sheets:
  manufacturers(ord, keyword, canonical)   models(ord, model, manufacturer)
A description matches a row when the row's keyword, lower-cased, is one of the
description's whitespace tokens (J1) or a substring of it (J2); the first row
in sheet order wins.

Plan shape (both lookups): only the *distinct* descriptions are looked up.
Their tokens (or substrings) meet the dictionary in a broadcast hash join (the
dictionary side is size-checked first), ``min_by(.., ord)`` picks the first
row per description, and the small result joins back to the items on the
description text; AQE turns that join into a broadcast when the lookup result
is small and splits a hot description when it is skewed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nullif_empty, pysplit, truthy

MAX_BROADCAST_ROWS = 2_000_000


def sized_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven small; otherwise
    return it unchanged so the join falls back to a shuffle join."""
    rows = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if rows <= max_rows else df


@dataclass
class Dictionary:
    manufacturers: DataFrame   # ord, keyword, canonical
    models: DataFrame          # ord, model, manufacturer
    manufacturer_rows: int | None = None
    model_rows: int | None = None

    @classmethod
    def from_rows(cls, spark: SparkSession, manufacturers, models) -> "Dictionary":
        m = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(manufacturers)],
                                  "ord int, keyword string, canonical string")
        d = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(models)],
                                  "ord int, model string, manufacturer string")
        return cls(m, d, len(manufacturers), len(models))

    def manufacturer_side(self) -> DataFrame:
        df = self.manufacturers.where(truthy("keyword")).select(
            F.lower("keyword").alias("_tok"), "ord", "keyword", "canonical")
        return sized_broadcast(df, known_rows=self.manufacturer_rows)

    def model_side(self) -> DataFrame:
        df = self.models.where(truthy("model")).select(
            F.lower("model").alias("_tok"), "ord", "model", "manufacturer")
        return sized_broadcast(df, known_rows=self.model_rows)


def _tokens(desc):
    return F.array_distinct(pysplit(F.lower(desc)))


def token_matches(descs: DataFrame, desc_col: str, dictionary: Dictionary) -> DataFrame:
    """First manufacturer-sheet row and first model-sheet row whose keyword is a
    token of each distinct description: (desc, m_canonical, m_keyword, model,
    model_manufacturer, tokens)."""
    toks = descs.select(desc_col, F.explode(_tokens(F.col(desc_col))).alias("_tok"))
    m = toks.join(dictionary.manufacturer_side(), "_tok").groupBy(desc_col).agg(
        F.min_by(F.struct("canonical", "keyword"), "ord").alias("_m"))
    d = toks.join(dictionary.model_side(), "_tok").groupBy(desc_col).agg(
        F.min_by(F.struct("model", "manufacturer"), "ord").alias("_d"))
    return descs.join(m, desc_col, "left").join(d, desc_col, "left").select(
        desc_col,
        F.col("_m.canonical").alias("m_canonical"), F.col("_m.keyword").alias("m_keyword"),
        F.col("_d.model").alias("d_model"), F.col("_d.manufacturer").alias("d_manufacturer"),
    )


def resolve_token_lookup(hits: DataFrame, desc_col: str, mode: str = "canonical", override: bool = True):
    """J1/J3/J4/J5 from the raw hits.

    mode ``canonical`` (J1): manufacturer = the row's canonical name; when that
      is empty, the matched model row's manufacturer (J3); ``miller`` plus the
      token ``weblift`` becomes ``Miller Weblift`` (J4, when ``override``).
    mode ``keyword`` (J5): manufacturer and model are the matched keywords
      themselves, no fallback.
    Empty results are null.
    """
    if mode == "keyword":
        return hits.select(desc_col, nullif_empty(F.col("m_keyword")).alias("manufacturer"),
                           nullif_empty(F.col("d_model")).alias("model"))
    m1 = F.col("m_canonical")
    if override:
        m1 = F.when((F.lower(m1) == F.lit("miller")) & F.array_contains(_tokens(F.col(desc_col)), "weblift"),
                    F.lit("Miller Weblift")).otherwise(m1)
    manufacturer = F.when(truthy(m1), m1).when(truthy("d_manufacturer"), F.col("d_manufacturer"))
    return hits.select(desc_col, manufacturer.alias("manufacturer"), nullif_empty(F.col("d_model")).alias("model"))


def token_lookup(df: DataFrame, desc_col: str, dictionary: Dictionary, mode: str = "canonical",
                 override: bool = True, out_prefix: str = "") -> DataFrame:
    """J1 (+J3/J4) or J5 applied to every row of ``df``: adds
    ``{out_prefix}manufacturer`` and ``{out_prefix}model``."""
    descs = df.select(desc_col).where(F.col(desc_col).isNotNull()).distinct()
    res = resolve_token_lookup(token_matches(descs, desc_col, dictionary), desc_col, mode, override)
    res = res.withColumnRenamed("manufacturer", out_prefix + "manufacturer").withColumnRenamed(
        "model", out_prefix + "model")
    return df.join(res, desc_col, "left")


GRAM, PIECE = 3, 256


def gram_index(side: DataFrame) -> DataFrame:
    """(_gram, _tok, ...): each keyword under its rarest gram of ``GRAM`` characters among all keywords (a shorter
    keyword under itself), so that few texts meet it that do not hold it."""
    words = side.select("_tok").distinct()
    n = F.length("_tok")
    grams = words.select("_tok", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n - GRAM + 1, F.lit(1))), lambda i: F.col("_tok").substr(i, F.lit(GRAM))))).alias(
            "_gram"))
    spread = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = grams.join(spread, "_gram").groupBy("_tok").agg(F.min(F.struct("_n", "_gram"))["_gram"].alias("_gram"))
    return side.join(rarest, "_tok")


def text_grams(texts: DataFrame, text_col: str, sizes) -> DataFrame:
    """(_id, _gram): the distinct grams of each lower-cased text, of ``GRAM`` characters and of the shorter sizes that
    keywords have.  Texts are cut into pieces that overlap by ``GRAM - 1`` characters by one pattern, so the time
    follows a text's length."""
    pieces = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(
        f"(?s)(?=(.{{1,{PIECE + GRAM - 1}}})).{{1,{PIECE}}}"), F.lit(1))
    rows = texts.select("_id", F.explode(pieces).alias("_piece"))
    piece = F.col("_piece")

    def of(n):
        last = F.greatest(F.length(piece) - n + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: piece.substr(i, F.lit(n)))
    grams = F.array_distinct(F.flatten(F.array(*[of(n) for n in sizes])))
    return rows.select("_id", F.explode(grams).alias("_gram")).distinct()


def substring_hits(texts: DataFrame, text_col: str, dictionary: Dictionary) -> DataFrame:
    """J2 for distinct texts: (text, _s struct<manufacturer, model>) of the first model-sheet row whose model occurs in
    the text.  Grams of the texts meet the keywords' rarest grams in an equi join; only these candidates are
    verified, and the text itself is shuffled once, under a hash."""
    side = dictionary.model_side()
    sizes = sorted({min(r[0], GRAM) for r in side.select(F.length("_tok")).distinct().collect()})  # at most GRAM
    named = texts.select(text_col, F.sha2(F.col(text_col), 256).alias("_id"))
    if not sizes:
        return texts.select(text_col, F.lit(None).cast("struct<manufacturer:string,model:string>").alias("_s")).limit(0)
    index = sized_broadcast(gram_index(side), known_rows=dictionary.model_rows)
    found = text_grams(named, text_col, sizes).join(index, "_gram").select("_id", "_tok", "ord", "manufacturer", "model")
    held = found.join(named, "_id").where(F.lower(F.col(text_col)).contains(F.col("_tok")))
    first = held.groupBy("_id").agg(F.min_by(F.struct("manufacturer", "model"), "ord").alias("_s"))
    return named.join(first, "_id").select(text_col, "_s")


def substring_lookup(df: DataFrame, desc_col: str, dictionary: Dictionary) -> DataFrame:
    """J2 (local First Integrated rules): the first *model-sheet* row whose
    model, lower-cased, occurs anywhere in the lower-cased description; its
    manufacturer is taken as is.  Adds ``manufacturer`` and ``model``.

    A theta join done as an equi join over distinct descriptions (:func:`substring_hits`)."""
    descs = df.select(desc_col).where(F.col(desc_col).isNotNull()).distinct()
    res = substring_hits(descs, desc_col, dictionary).select(
        desc_col, nullif_empty(F.col("_s.manufacturer")).alias("manufacturer"),
        nullif_empty(F.col("_s.model")).alias("model"))
    return df.join(res, desc_col, "left")


def dictionary_misses(df: DataFrame, desc_col: str, dictionary: Dictionary) -> DataFrame:
    """Distinct descriptions with no manufacturer and no model token hit
    (an anti join against the dictionary tokens, broadcast where their number is checked)."""
    descs = df.select(desc_col).where(F.col(desc_col).isNotNull()).distinct()
    toks = descs.select(desc_col, F.explode(_tokens(F.col(desc_col))).alias("_tok"))
    keys = dictionary.manufacturer_side().select("_tok").union(dictionary.model_side().select("_tok"))
    known = (None if dictionary.manufacturer_rows is None or dictionary.model_rows is None
             else dictionary.manufacturer_rows + dictionary.model_rows)
    hits = toks.join(sized_broadcast(keys.distinct(), known_rows=known), "_tok", "left_semi").select(desc_col)
    return descs.join(hits, desc_col, "left_anti")
