"""Quality rules: an isolation forest on rule statistics.

One vectorised scan computes the rule statistics of every document.  The base rules fail a document
outright (fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT`` per cent of its words in repeated
three-word windows).  Beyond them, an isolation forest (random splits on small subsamples of good
labelled rows) scores how quickly a document's statistics are isolated, and the threshold is
calibrated on all labelled rows: the one that finds most bad rows while at most ``max_false`` of the
good ones are rejected.

The forest is fitted on about ``max_fit_rows`` labelled rows (chosen by a hash of the id); counts,
statistics, calibration and verdicts cover all rows.

Defined results: null text has no words, so it fails the base rules, as empty text does; rows that
repeat an id are judged each by itself; an id may be null (such a row has no label); without labelled
good rows only the base rules reject; other columns pass through whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T

MIN_WORDS, MAX_REPEAT = 50, 50
# The symbols counted by the rules.
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_DIGITS = ~T.separators((0x00, 0x2F), (0x3A, 0xFF))
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_distinct")
BINS = 4096


def _count(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def rule_statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, len(STATS)) counts for a slice of texts."""
    n_docs = len(off) - 1
    ws, we, woff = T.word_spans(buf, off, T.BLANKS)
    n_words = np.diff(woff)
    doc = np.repeat(np.arange(n_docs), n_words)
    code_points = ((buf & 0xC0) != 0x80) & ~T.BLANKS[buf]
    sums = T.span_sums(T.byte_values(buf))
    words = T.span_hash(sums, ws, we)
    salt = T.mix(np.arange(1, n_docs + 1, dtype=np.uint64))

    distinct = np.unique(words ^ salt[doc], return_index=True)[1]
    n_distinct = np.bincount(doc[distinct], minlength=n_docs)

    s = T.ranges(woff[:-1], np.maximum(n_words - 2, 0))
    repeated = np.zeros(len(ws) + 1, bool)
    if len(s):
        windows = T.span_hash(T.span_sums(words), s, s + 3) ^ salt[doc[s]]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = s[counts[inverse] > 1]
        for j in range(3):
            repeated[twice + j] = True
    n_repeat = _count(repeated[:-1], woff)

    # lines: [start, end) between line feeds and document ends
    is_feed = buf == 0x0A
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    feeds = np.flatnonzero(is_feed)
    start = np.union1d(feeds + 1, off[:-1])
    start = start[start < len(buf)]
    start = start[~is_feed[start]]  # empty lines have no word
    nexts = np.union1d(feeds, off[1:])
    end = nexts[np.searchsorted(nexts, start, "right")] if len(start) else start
    with_word = np.searchsorted(ws, end) > np.searchsorted(ws, start)
    start, end = start[with_word], end[with_word]
    line_doc = np.searchsorted(off, start, "right") - 1
    lines = T.span_hash(sums, start, end) ^ salt[line_doc] if len(start) else np.zeros(0, T.U64)
    n_lines = np.bincount(line_doc, minlength=n_docs)
    first = np.unique(lines, return_index=True)[1]
    n_dup = n_lines - np.bincount(line_doc[first], minlength=n_docs)

    return np.stack([n_words, _count(code_points, off), _count(_SYMBOLS[buf], off), n_dup, n_repeat, n_lines,
                     _count(_DIGITS[buf], off), n_distinct], axis=1).astype(np.int64)


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT * stats[:, 0])


def rates(stats: np.ndarray) -> np.ndarray:
    """What the forest splits on: letters a word, and symbols, repeated lines, repeated words and digits
    as shares."""
    words, chars, symbols, dup, repeat, lines, digits, _ = stats.T.astype(float)
    some = np.maximum(words, 1)
    return np.stack([chars / some, symbols / some, dup / np.maximum(lines, 1), repeat / some, digits / some], axis=1)


class IsolationForest:
    """Random split trees as flat arrays; the score is 2 ** (-mean path length / expected length).

    A rate counts by its distance from the usual (the median for letters a word, zero for the shares),
    in units of the distance that 99.9 % of the good rows keep, up to ``CAP`` units.  Splits are drawn
    from that whole domain, not only from where the subsample lies, so a value that good rows never
    have falls into an empty cell after a few splits."""

    CAP = 10.0
    FLOOR = (0.5, 0.02, 0.05, 0.05, 0.05)

    def __init__(self, good: np.ndarray, trees: int = 100, subsample: int = 256, seed: int = 7):
        self.usual = np.zeros(good.shape[1])
        self.usual[0] = np.median(good[:, 0])
        self.unit = np.maximum(np.quantile(np.abs(good - self.usual), 0.999, axis=0), self.FLOOR)
        rng = np.random.default_rng(seed)
        rows = self.place(good)
        size = min(subsample, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        self.feature = np.full((trees, 2 ** (self.depth + 1)), -1, np.int16)
        self.split = np.zeros(self.feature.shape)
        self.path = np.zeros(self.feature.shape)
        self.scale = max(self._expected(size), 1.0)
        low, high = np.zeros(rows.shape[1]), np.full(rows.shape[1], self.CAP)
        for tree in range(trees):
            self._grow(rows[rng.choice(len(rows), size, replace=False)], tree, 1, 0, low, high, rng)

    def place(self, rows: np.ndarray) -> np.ndarray:
        return np.minimum(np.abs(rows - self.usual) / self.unit, self.CAP)

    @staticmethod
    def _expected(n: int) -> float:
        return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    def _grow(self, rows, tree, node, depth, low, high, rng):
        if depth == self.depth or len(rows) < 2:
            self.path[tree, node] = depth + self._expected(len(rows))
            return
        f = rng.integers(rows.shape[1])
        cut = rng.uniform(low[f], high[f])
        self.feature[tree, node], self.split[tree, node] = f, cut
        left = rows[:, f] < cut
        upper, lower = high.copy(), low.copy()
        upper[f] = lower[f] = cut
        self._grow(rows[left], tree, 2 * node, depth + 1, low, upper, rng)
        self._grow(rows[~left], tree, 2 * node + 1, depth + 1, lower, high, rng)

    def score(self, rows: np.ndarray) -> np.ndarray:
        rows = self.place(rows)
        total = np.zeros(len(rows))
        at = np.arange(len(rows))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.ones(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + (rows[at, f] >= split[node]), node)
            total += path[node]
        return 2 ** (-total / len(self.feature) / self.scale)


class Model:
    """The forest (None without labelled rows) and the largest score that is kept."""

    def __init__(self, forest: IsolationForest | None, threshold: float):
        self.forest, self.threshold = forest, threshold

    def judge(self, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, score, kept."""
        failed = base_failed(stats)
        score = self.forest.score(rates(stats)) if self.forest else np.zeros(len(stats))
        return failed, score, ~failed & (score <= self.threshold)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, STATS...) of every document, in one scan."""
    schema = S.StructType([S.StructField("_id", docs.schema[id_col].dataType)]
                          + [S.StructField(c, S.LongType()) for c in STATS])

    def scan(batches):
        for b in batches:
            found = [rule_statistics(buf, off) for _, buf, off in T.text_slices(b.column(1))]
            if found:
                found = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, found.T)], names=schema.names)

    T.prepare(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")).mapInArrow(scan, schema)


def fit(stats: DataFrame, labels: DataFrame, label_id: str = "doc_id", quality_col: str = "quality",
        max_fit_rows: int = 5_000, max_false: float = 0.002) -> Model:
    """Fit on ``stats`` (see :func:`statistics`) and labels (id, quality 1 good / 0 bad)."""
    given = labels.select(F.col(f"`{label_id}`").alias("_id"), F.col(f"`{quality_col}`").alias("_good"))
    known = T.materialize(stats.join(given.where(F.col("_good").isin(0, 1)), "_id"))
    passed = known.where((F.col("n_words") >= MIN_WORDS)
                         & (100 * F.col("n_repeat_words") <= MAX_REPEAT * F.col("n_words")))
    good_rows = passed.where("_good = 1").select("_id", *STATS)
    share = F.lit(min(1.0, max_fit_rows / max(good_rows.count(), 1)))
    place = F.pmod(F.xxhash64("_id", *STATS), F.lit(1_000_003)) / 1_000_003
    rows = good_rows.where(place < share).orderBy("_id", *STATS).select(*STATS).toPandas().to_numpy(np.int64)
    rows = rows.reshape(-1, len(STATS))  # about max_fit_rows of them
    if len(rows) < 2:
        return Model(None, 1.0)
    forest = IsolationForest(rates(rows))
    bins = scored(passed.select("_good", *STATS), Model(forest, 1.0)).groupBy(
        F.floor(F.col("score") * BINS).alias("bin"), "_good").count().toPandas()  # at most 2 * BINS rows
    good, bad = (np.bincount(bins.bin[bins._good == g].astype(int), bins["count"][bins._good == g],
                             minlength=BINS + 1).astype(float) for g in (1, 0))
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)  # share of good rows in this bin or above
    caught = np.cumsum(bad[::-1])[::-1] / max(bad.sum(), 1)
    gain = np.where(lost <= max_false, caught - 2 * lost, -1.0)
    if gain.max() <= 0:
        return Model(forest, 1.0)
    best = np.flatnonzero(gain == gain.max())
    return Model(forest, (best[0] + best[-1]) / 2 / BINS)  # between the good and the bad


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` plus base_failed, score and kept."""
    shared = stats.sparkSession.sparkContext.broadcast(model)  # trees * 2 * subsample numbers
    schema = S.StructType([*stats.schema.fields, S.StructField("base_failed", S.BooleanType()),
                           S.StructField("score", S.DoubleType()), S.StructField("kept", S.BooleanType())])
    places = [stats.columns.index(c) for c in STATS]

    def judge(batches):
        for b in batches:
            x = np.stack([b.column(i).to_numpy() for i in places], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, shared.value.judge(x))], names=schema.names)

    return stats.mapInArrow(judge, schema)


def filter_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected rows; the texts are not shuffled."""
    model = fit(T.materialize(statistics(docs, id_col, text_col)), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    source = docs.select(F.col(f"`{text_col}`").alias("_t"), row)

    def keep(batches):
        for b in batches:
            found = [shared.value.judge(rule_statistics(buf, off))[2] for _, buf, off in T.text_slices(b.column(0))]
            if found:
                yield b.filter(pa.array(np.concatenate(found))).select(["_row"])

    out = source.mapInArrow(keep, source.select("_row").schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = T.materialize(statistics(docs))
    out = scored(stats, fit(stats, labels))
    return out.select(F.col("_id").alias("doc_id"), *STATS[:5], "base_failed", "kept", "score")
