"""Filter interaction audit by difference arrays over Lehmer ranks.

Five filters can run in 120 orders.  A document that fails the filters of a mask is removed, in a given
order, by the first filter of the mask, at that filter's step.  Orders that begin with the same letters
have consecutive lexicographic (Lehmer) ranks, so a mask's removals at one step are the intervals of
ranks whose orders begin with filters outside the mask and go on with one of it.  Each interval adds a
mask's documents at its start and takes them off at its end; the prefix sums along the 120 ranks give
what each order removes at each step, and everything else follows from those sums.

The documents are read once: the filters become a mask, identical texts are counted together (a text is
known by its SHA-256), and the counts of (part, mask) are all that the rest of the job sees, so it does
not grow with the table.  A group of copies, however large, is counted before it meets in one place.
Only DataFrame functions are used.

Defined results: null text counts as empty, and empty texts are identical to each other; a null part is
the part ``""``; a null id is smaller than any other; rows of the smallest id of a group of copies, however many, do not fail
E; a document has a label if any label row of its id says so; other columns do not matter, whatever
their names; an empty table gives no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
STEPS, ORDERS = len(FILTERS), factorial(len(FILTERS))
WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ("n", "good", "toxic")


def conditions(text: Column) -> list[Column]:
    """Failure conditions A to D of a text that is not null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    return [n < 100, 100 * F.size(F.array_distinct(words)) < 80 * n,
            100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text), text.rlike(r"[#$%&*|]")]


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail exactly the filters of the mask (bit
    0 is the first filter), and how many of them the labels call good and toxic."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias(
        "part"), text.alias("_t"))
    d = d.select("_id", "part", F.unhex(F.sha2("_t", 256)).alias("_key"),
                 sum(F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions(F.col("_t")))).alias("_m"))
    known = labels.select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("_g"), (
        F.col("toxic") == 1).alias("_x")).where("_id is not null").groupBy("_id").agg(
        F.coalesce(F.max("_g"), F.lit(False)).alias("_g"), F.coalesce(F.max("_x"), F.lit(False)).alias("_x"))
    d = d.join(known, "_id", "left").select("_id", "part", "_key", "_m", F.coalesce("_g", F.lit(False)).alias("_g"),
                                            F.coalesce("_x", F.lit(False)).alias("_x"))
    kind = ["_key", "_m", "part", "_g", "_x"]
    # rows of one id, then copies of one kind (combined before the shuffle), then the kinds of one text
    one = d.groupBy(*kind, "_id").agg(F.count(F.lit(1)).alias("_n"))
    copies = one.groupBy(*kind).agg(F.sum("_n").alias("_n"), F.min(F.struct(F.col("_id").isNotNull(), "_id", "_n")).alias(
        "_first"))
    # a text has at most a row for each part and label pair here
    lead = F.min("_first").over(Window.partitionBy("_key"))
    stay = F.when(F.col("_first._id").eqNullSafe(lead["_id"]), F.col("_first._n")).otherwise(F.lit(0))
    copies = copies.select("part", "_m", "_g", "_x", "_n", stay.alias("_stay"))
    last = 1 << (STEPS - 1)
    kinds = copies.select("part", "_g", "_x", F.explode(F.array(
        F.struct(F.col("_m").alias("mask"), F.col("_stay").alias("c")),
        F.struct((F.col("_m") + last).alias("mask"), (F.col("_n") - F.col("_stay")).alias("c")))).alias("_e")).select(
        "part", "_g", "_x", "_e.mask", "_e.c")
    return kinds.groupBy("part", "mask").agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("_g"), F.col("c")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_x"), F.col("c")).otherwise(0)).alias("toxic"))


def rank(prefix: str) -> int:
    """Lehmer rank of the first order that begins with ``prefix``."""
    left, out = list(FILTERS), 0
    for i, letter in enumerate(prefix):
        out += left.index(letter) * factorial(STEPS - 1 - i)
        left.remove(letter)
    return out


def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, rank behind the last) of a mask's removals."""
    out = []
    for step in range(1, STEPS + 1):
        for p in permutations(FILTERS, step):
            if mask >> FILTERS.index(p[-1]) & 1 and not any(mask >> FILTERS.index(x) & 1 for x in p[:-1]):
                lo = rank("".join(p))
                out.append((step, lo, lo + factorial(STEPS - step)))
    return out


def removals(counts: DataFrame) -> DataFrame:
    """(part, step, rank, n, good, toxic) removed, a row for every part, step and rank."""
    spark = counts.sparkSession
    ends = [(m, step, at, sign) for m in range(1, 1 << STEPS) for step, lo, hi in intervals(m)
            for at, sign in ((lo, 1), (hi, -1))]
    ends = spark.createDataFrame(ends, "mask int, step int, rank int, sign int")  # fixed by the number of filters
    add = counts.join(F.broadcast(ends), "mask").select(
        "part", "step", "rank", *[(F.col(c) * F.col("sign")).alias(c) for c in COUNTS])
    zero = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias(
        "step")).select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"), *[
            F.lit(0).cast("long").alias(c) for c in COUNTS])
    deltas = add.unionByName(zero).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return deltas.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS]).where(
        F.col("rank") < ORDERS)


def audit(counts: DataFrame) -> DataFrame:
    """The full report from the counts of :func:`masks`."""
    spark = counts.sparkSession
    orders = spark.createDataFrame([(rank("".join(p)), "".join(p)) for p in permutations(FILTERS)],
                                   "rank int, filter_order string")
    fails = counts.select("part", "mask", "n", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("_i"))
    per_filter = fails.groupBy("part", F.substring(F.lit(FILTERS), F.col("_i") + 1, F.lit(1)).alias("filter")).agg(
        F.sum(F.when(F.expr("(shiftright(mask, _i) & 1) = 1"), F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("mask") == F.expr("shiftleft(1, _i)"), F.col("n")).otherwise(0)).alias("unique_fails"))
    all_rows = Window.partitionBy("part")
    per_filter = per_filter.join(counts.groupBy("part").agg(F.sum("n").alias("documents")), "part")
    r = removals(counts).join(F.broadcast(orders), "rank").withColumn(
        "filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    r = r.join(per_filter, ["part", "filter"])
    done = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("part", "filter")
    return r.select(
        "part", "filter_order", "step", (F.col("documents") - F.sum("n").over(done)).alias("kept"),
        F.col("n").alias("removed"), (F.col("failing") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(every).alias("shapley"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(masks(docs.select("doc_id", "text", "lang"), labels))
