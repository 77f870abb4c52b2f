"""URL filters: a blocked Bloom filter before an exact join.

Two lists decide: rules (host, path, verdict), which fit their host, its subdomains and every path
that starts with theirs, and listed canonical URLs, which are blocked.  Every rule and listed URL is
a key; a URL asks for the few keys it could match (its host endings and path prefixes of the shapes
that rules have, and its canonical form).  The filter, of at most ``max_bits`` bits however long the
lists are, passes possible hits; an exact hash join with the lists removes the false positives.  The
longest rule wins over shorter ones, and any rule over the list; other URLs are allowed.

Defined results: a null URL, or one without ``://``, has empty host and path, no rule and is allowed;
rows that repeat an id, or have none, are judged each by itself; only ``keep`` columns pass through;
rules repeated in the list count once, of rules that differ only in verdict ``block`` wins; empty
lists allow everything; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.`` and default port, path without a trailing slash, query without
    tracking parameters in sorted order; no scheme, no fragment; null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.split(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


class BlockedBloom:
    """512-bit blocks; a key sets ``PROBES`` bits of one block."""

    WORDS, PROBES = 8, 8

    def __init__(self, n_keys: int, max_bits: int, bits_per_key: int = 12):
        self.blocks = 1 << max(0, (min(max_bits, max(1, n_keys) * bits_per_key) // 512 - 1).bit_length())
        while self.blocks * 512 > max_bits and self.blocks > 1:
            self.blocks //= 2
        self.words = np.zeros(self.blocks * self.WORDS, T.U64)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and bit of every probe, (keys, PROBES) each."""
        h = T.mix(keys.astype(np.int64).view(T.U64))
        block = (h & T.U64(self.blocks - 1)).astype(np.int64)
        probes = T.mix(h[:, None] + np.arange(1, self.PROBES + 1, dtype=T.U64) * T.U64(0x9E3779B97F4A7C15))
        bit = (probes >> T.U64(55)).astype(np.int64)  # 0 to 511
        return block[:, None] * self.WORDS + (bit >> 6), T.U64(1) << (bit & 63).astype(T.U64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        word, bit = self.places(keys)
        return ((self.words[word] & bit) != 0).all(axis=1)


def build_filter(keys: DataFrame, max_bits: int) -> BlockedBloom:
    """Filter of the string column ``key``, its words combined in Spark."""
    bloom = BlockedBloom(keys.count(), max_bits)

    def words(batches):
        for b in batches:
            word, bit = bloom.places(b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(word.ravel()), pa.array(bit.ravel().view(np.int64))],
                                             names=["word", "bits"])

    set_ = keys.select(F.xxhash64("key")).mapInArrow(words, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits")).collect()  # at most max_bits / 64 rows
    for word, bits in set_:
        bloom.words[word] = np.int64(bits).view(T.U64)
    return bloom


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, url_col: str = "url",
               keep: tuple[str, ...] = ("page_id",), max_bits: int = 1 << 26) -> DataFrame:
    """``keep`` columns (but those named like a result) plus host, path, rule, listed and verdict.  ``rules``
    has (host, path, verdict), ``listed`` has canonical URLs in its first column."""
    T.prepare(pages.sparkSession)
    keep = T.beside(list(keep), "host", "path", "rule", "listed", "verdict")
    rule_keys = rules.where("host is not null and path is not null").groupBy("host", "path").agg(
        F.max(F.col("verdict")).alias("verdict")).select(
        F.concat(F.lit("r "), "host", "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict",
        F.size(F.split("host", "\\.")).alias("labels"), F.length("path").alias("chars"))
    list_keys = listed.select(F.concat(F.lit("u "), F.col(listed.columns[0])).alias("key")).where(
        "key is not null").distinct()
    shapes = [tuple(r) for r in rule_keys.select("labels", "chars").distinct().collect()]  # shapes, not rules
    known = rule_keys.select("key", "rule", "verdict").unionByName(list_keys.select(
        "key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict")))
    known = T.materialize(known)
    shared = pages.sparkSession.sparkContext.broadcast(build_filter(known, max_bits))

    url = F.col(f"`{url_col}`")
    d = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), host_of(url).alias("host"),
                     path_of(url).alias("path"), canonical(url).alias("_url"))
    ends = [F.when((F.size(F.split("host", "\\.")) >= labels) & (F.length("path") >= chars),
                   F.concat(F.lit("r "), F.substring_index("host", ".", -labels), F.substring("path", 1, chars)))
            for labels, chars in shapes]
    d = d.select("_row", "host", "path",
                 F.array_compact(F.array(*ends, F.concat(F.lit("u "), "_url"))).alias("keys"))
    d = d.withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
    schema = S.StructType([*d.schema.fields[:3], S.StructField("keys", S.ArrayType(S.StringType()))])

    def possible(batches):
        for b in batches:
            lists = b.column(4)
            n = np.diff(lists.offsets.to_numpy())
            hit = shared.value.has(lists.flatten().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(n)), n)[hit]
            off = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(n))))).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(off), b.column(3).flatten().filter(pa.array(hit)))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], keys], names=schema.names)

    maybe = d.mapInArrow(possible, schema).withColumn("_n", F.monotonically_increasing_id())
    asked = maybe.where(F.size("keys") > 0)
    hits = asked.select("_n", "_row", "host", "path", F.explode("keys").alias("key")).join(known, "key", "left")
    longest = F.struct(F.length("rule"), "rule", "verdict")
    best = hits.groupBy("_n").agg(
        F.first("_row").alias("_row"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(F.col("rule").isNotNull(), longest)).alias("b"),
        F.max(F.col("rule").isNull() & F.col("verdict").isNotNull()).alias("listed"))
    best = best.select("_row", "host", "path", F.col("b.rule").alias("rule"), "listed",
                       F.coalesce("b.verdict", F.when(F.col("listed"), F.lit("block")), F.lit("allow")).alias("verdict"))
    rest = maybe.where(F.size("keys") == 0).select(
        "_row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(False).alias("listed"),
        F.lit("allow").alias("verdict"))
    out = best.unionByName(rest)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], "host", "path", "rule", "listed", "verdict")


# The rules and the listed sites of the registered query.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
LISTED_SITES = ("casino-win", "spam-farm", "cheap-pills", "free-bets", "adult-x", "ads-track")
LISTED_ENDINGS = ("example.com", "example.org", "example.net")


def digest(pages: DataFrame) -> DataFrame:
    """The rules above; the list holds the canonical URLs of all pages on the listed sites."""
    spark = pages.sparkSession
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    url = canonical(F.col("url"))
    listed = pages.select(url.alias("url")).where(F.regexp_extract("url", r"^[^/?]*", 0).isin(
        *[f"{name}.{ending}" for name in LISTED_SITES for ending in LISTED_ENDINGS]))
    return judge_urls(pages.select("page_id", "url"), rules, listed)
