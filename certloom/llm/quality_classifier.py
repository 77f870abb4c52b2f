"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on the rule statistics of each document.
Expectation-maximisation over the counts of vote patterns (at most 3 ** labellers of them, counted
over all documents) estimates each labeller's accuracy on good and on bad documents; the posterior of
a document's pattern is its soft label.  A linear scorer over hashed byte n-grams is then trained on the
soft labels of all documents in ``rounds`` rounds: a round broadcasts a few weight vectors (steps of
several lengths along one quasi-Newton direction) and sums the loss and gradient of each over all
rows; the best one is where the next round starts.  Gradients are summed for the lengths that are likely to be the
best only; should another be, it is read once more.  The sums do not depend on how the rows are
partitioned, nor does the result, but for the last digits of doubles.

No given label is used.  The texts are read once, into a table of vote patterns and sparse gram counts
(a few bytes a distinct gram) that the rounds and the scoring read; nothing but sums is shuffled.

Defined results: null text counts as empty and gets the posterior and score of a text without words; rows that
repeat an id are scored each by itself; an id may be null; other columns pass through whatever their names,
but one named like a result column gives way to it; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T
from .quality_rules import rule_statistics

DIM, SIZES, ROWS, LENGTH = 8192, (3,), 64, 4.0  # DIM: at most 2 ** 15, places are shorts
_BYTES = np.arange(256, dtype=np.uint8)
GOOD, BAD, NONE = 2, 1, 0

LABELLERS = ("length", "symbols", "repeats", "lines", "variety", "digits", "word_size")
#: A labeller that gives a good document a bad vote more often than this is not believed to: its votes
#: then tell of documents that are bad.
MAX_FALSE = 0.02


def votes(stats: np.ndarray) -> np.ndarray:
    """(documents, labellers) votes.  Only length and word size can vote good; the others look for one
    defect each, and its absence says nothing."""
    words, chars, symbols, dup, repeat, lines, digits, distinct = stats.T.astype(float)
    some = np.maximum(words, 1)

    def vote(bad, good=False):
        return np.where(bad, BAD, np.where(good, GOOD, NONE))
    size = chars / some
    return np.stack([
        vote(words < 5, words >= 80),
        vote(symbols > 0.1 * some),
        vote(repeat > 0.3 * some),
        vote(dup > 0.3 * np.maximum(lines, 1)),
        vote((distinct < 0.2 * some) & (repeat > 0.1 * some)),
        vote(digits > some),
        vote((size < 2) | (size > 12), (size > 3) & (size < 8))], axis=1).astype(np.int64)


def pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


class LabelModel:
    """Each labeller's vote shares in good and bad documents, by EM.  The share of good documents is
    given: labellers that each look for a defect of their own cannot tell it."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, good_share: float = 0.85, rounds: int = 50):
        m = len(LABELLERS)
        v = patterns[:, None] // 3 ** np.arange(m) % 3
        good = np.where((v == BAD).any(axis=1), 0.1, 0.95)
        for _ in range(rounds):
            logit = np.full(len(v), np.log(good_share / (1 - good_share)))
            self.accuracy = []
            for i in range(m):
                row = []
                for weight in (good, 1 - good):
                    n = np.array([(weight * counts)[v[:, i] == x].sum() for x in (NONE, BAD, GOOD)]) + 0.1
                    n /= n.sum()
                    if weight is good and n[BAD] > MAX_FALSE:
                        n *= (1 - MAX_FALSE) / (1 - n[BAD])
                        n[BAD] = MAX_FALSE
                    row.append(n)
                self.accuracy.append(row)
                told = np.log(row[0]) - np.log(row[1])
                told[NONE] = 0.0  # a labeller that does not vote tells nothing: defects exclude each other
                logit += told[v[:, i]]
            good = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        self.share = float((good * counts).sum() / max(counts.sum(), 1))
        self.known = dict(zip(patterns.tolist(), good.tolist(), strict=True))

    def posterior(self, v: np.ndarray) -> np.ndarray:
        return self.posterior_of(pattern(v))

    def posterior_of(self, patterns) -> np.ndarray:
        return np.array([self.known[p] for p in patterns.tolist()])


class Grams:
    """Sparse vectors of log n-gram counts, all of length ``LENGTH``, of the rows of a batch: gaps between the
    grams' places (int16) and their counts (int32), both little-endian."""

    def __init__(self, gaps: pa.Array, counts: pa.Array):
        self.rows = len(gaps)
        gap, off = T.text_buffer(gaps)
        gap, self.size = gap.view("<i2"), np.diff(off) // 2
        size = self.size
        self.row = np.repeat(np.arange(self.rows), size)
        at = np.cumsum(gap, dtype=np.int64)
        first = (np.cumsum(size) - size)[size > 0]
        before = np.zeros(self.rows, np.int64)
        before[size > 0] = np.concatenate(([0], at))[first]
        self.at = at - before[self.row]
        value = np.log1p(np.frombuffer(T.text_buffer(counts)[0].tobytes(), "<i4").astype(float))
        norm = np.sqrt(np.bincount(self.row, value ** 2, self.rows))
        self.value = value * (LENGTH / np.maximum(norm, 1e-9))[self.row]

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.at], self.rows) + w[DIM]

    def totals(self, x: np.ndarray) -> np.ndarray:
        """Sum of the vectors, each times its ``x``."""
        return np.bincount(self.at, self.value * np.repeat(x, self.size), DIM)


def gram_lists(column) -> tuple[pa.Array, pa.Array]:
    """The binary columns of :class:`Grams` for a text column."""
    gaps, counts, size = [], [], []
    for _, buf, off in T.row_slices(column, ROWS):
        x = T.hashed_grams(buf, off, DIM, _BYTES, SIZES)
        row, at = np.nonzero(x)
        gap = np.diff(at, prepend=0)
        new = np.flatnonzero(np.diff(row, prepend=-1))
        gap[new] = at[new]
        gaps.append(gap.astype("<i2"))
        counts.append(x[row, at].astype("<i4"))
        size.append(np.bincount(row, minlength=len(off) - 1))
    ends = np.concatenate(([0], np.cumsum(np.concatenate(size)))).astype(np.int32)

    def binary(parts):
        values = np.concatenate(parts)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
            None, pa.py_buffer(ends * values.itemsize), pa.py_buffer(values)])
    return binary(gaps), binary(counts)


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


class Scorer:
    def __init__(self, weights: np.ndarray):
        self.w = weights

    def score(self, x: Grams) -> np.ndarray:
        return sigmoid(x.margins(self.w))


def sums(x: Grams, y: np.ndarray, w: np.ndarray, direction: np.ndarray, steps: np.ndarray,
         gradients: int | None = None) -> np.ndarray:
    """For each step along ``direction`` from ``w``: gradient (DIM + 1; of the first ``gradients`` steps only,
    else 0) and logistic loss, summed over the rows; the last column holds the number of rows and, for the first
    round (one step), the sums of squared features."""
    out = np.zeros((DIM + 2, len(steps) + 1))
    base, slope = x.margins(w), x.margins(direction)
    for i, step in enumerate(steps):
        m = base + step * slope
        if gradients is None or i < gradients:
            miss = sigmoid(m) - y
            out[:DIM, i], out[DIM, i] = x.totals(miss), miss.sum()
        out[DIM + 1, i] = (np.logaddexp(0, m) - y * m).sum()
    out[:DIM, -1], out[DIM:, -1] = np.bincount(x.at, x.value ** 2, DIM) if len(steps) == 1 else 0, len(y)
    return out


class Descent:
    """Limited-memory quasi-Newton steps on the mean loss plus ``ridge`` / 2 times the squared weights;
    each step picks the best of several lengths."""

    STEPS, NO_STEP = 2.0 ** -np.arange(0, 9, 2), np.zeros(1)
    LIKELY = 2  # with past steps to go by, one of the first two lengths is nearly always the best

    def __init__(self, ridge: float = 1e-4):
        self.ridge = np.append(np.full(DIM, ridge), 0.0)
        self.w, self.direction = np.zeros(DIM + 1), np.zeros(DIM + 1)
        self.best, self.gradient, self.pairs, self.scale, self.chosen = np.inf, None, [], None, None

    def line(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Start, direction and step lengths of the next reading, and of how many of these the gradient is wanted."""
        steps = self.NO_STEP if self.gradient is None else self.STEPS if self.chosen is None else self.chosen
        return self.w, self.direction, steps, self.LIKELY if self.pairs and len(steps) > 1 else len(steps)

    def take(self, total: np.ndarray) -> bool:
        """``total`` are the :func:`sums` of the line over all rows.  False if the best step's gradient is still
        to be read."""
        n = total[DIM + 1, -1]
        if not n:
            return True
        steps, gradients = self.line()[2:]
        tried = self.w[:, None] + steps * self.direction[:, None]
        loss = total[DIM + 1, :-1] / n + (self.ridge[:, None] * tried ** 2).sum(axis=0) / 2
        i = int(np.argmin(loss))
        if i >= gradients and loss[i] < self.best:
            self.chosen = steps[i:i + 1]
            return False
        self.chosen = None
        gradient = total[:DIM + 1, :-1] / n + self.ridge[:, None] * tried
        if self.gradient is None:
            self.scale = 1 / (total[:DIM + 1, -1] / (4 * n) + self.ridge + 1e-6)
        elif loss[i] >= self.best:  # no length is better: start again at shorter ones
            self.direction = self.direction * self.STEPS[-1] / 2
            return True
        else:
            s, g = tried[:, i] - self.w, gradient[:, i] - self.gradient
            if s @ g > 0:
                self.pairs.append((s, g))
        self.w, self.gradient, self.best = tried[:, i], gradient[:, i], loss[i]
        self.direction = -self._scaled(self.gradient)
        return True

    def _scaled(self, g: np.ndarray) -> np.ndarray:
        past = []
        for s, y in reversed(self.pairs):
            a = (s @ g) / (s @ y)
            past.append(a)
            g = g - a * y
        g = g * self.scale
        if self.pairs:
            s, y = self.pairs[-1]
            g = g * ((s @ y) / (y @ (self.scale * y)))
        for (s, y), a in zip(self.pairs, reversed(past), strict=True):
            g = g + s * (a - (y @ g) / (s @ y))
        return g


def _training_table(docs: DataFrame, text_col: str) -> DataFrame:
    """(_row struct of the other columns, p vote pattern, and g, n as in :class:`Grams`) of every row, written
    once."""
    T.prepare(docs.sparkSession)
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    source = docs.select(F.col(f"`{text_col}`").alias("_t"), rest.alias("_row"))
    schema = S.StructType([source.schema["_row"], S.StructField("p", S.LongType()),
                           S.StructField("g", S.BinaryType()),
                           S.StructField("n", S.BinaryType())])

    def scan(batches):
        for b in batches:
            if b.num_rows:
                p = [pattern(votes(rule_statistics(buf, off))) for _, buf, off in T.row_slices(b.column(0), ROWS)]
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array(np.concatenate(p)), *gram_lists(b.column(0))],
                                                 names=schema.names)

    return T.materialize(source.mapInArrow(scan, schema))


def fit(docs: DataFrame, text_col: str = "text", rounds: int = 16) -> tuple[LabelModel, Scorer]:
    """The label model and the scorer, of all rows of ``docs``."""
    return _fit(_training_table(docs.select(text_col), text_col), rounds)


def _fit(table: DataFrame, rounds: int) -> tuple[LabelModel, Scorer]:
    rows = table.groupBy("p").agg(F.count("*").alias("n")).orderBy("p").collect()  # at most 3 ** labellers
    labels = LabelModel(np.array([r.p for r in rows], np.int64), np.array([r.n for r in rows], np.int64))
    descent = Descent()
    for _ in range(rounds if rows else 0):
        while not descent.take(_summed(table, labels, descent.line())):
            pass
    return labels, Scorer(descent.w)


def _summed(table: DataFrame, labels: LabelModel, line: tuple) -> np.ndarray:
    """:func:`sums` over all rows."""
    shared = table.sparkSession.sparkContext.broadcast((labels, line))
    n = len(line[2]) + 1

    def scan(batches):
        labels, line = shared.value
        total, seen = np.zeros((DIM + 2, n)), False
        for b in batches:
            if b.num_rows:
                total += sums(Grams(b.column(1), b.column(2)), labels.posterior_of(b.column(0)), *line)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 2, dtype=np.int32)),
                                              pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    rows = table.select("p", "g", "n").mapInArrow(scan, "i int, v array<double>").groupBy("i").agg(
        *[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(n)]).collect()  # DIM + 2 rows
    shared.unpersist()
    out = np.zeros((DIM + 2, n))
    for r in rows:
        out[r[0]] = r[1:]
    return out


def classify(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, out_col: str = "quality",
             rounds: int = 16) -> DataFrame:
    """``docs`` without the text plus ``quality``: p_weak (posterior of the votes), score (of the
    trained scorer) and kept (score at least ``threshold``).  """
    keep = T.beside(docs.columns, text_col, out_col)
    table = _training_table(docs.select(text_col, *[F.col(f"`{c}`") for c in keep]), text_col)
    shared = docs.sparkSession.sparkContext.broadcast(_fit(table, rounds))
    schema = S.StructType([table.schema["_row"], S.StructField("p_weak", S.DoubleType()),
                           S.StructField("score", S.DoubleType())])

    def scan(batches):
        labels, scorer = shared.value
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(labels.posterior_of(b.column(1))),
                     pa.array(scorer.score(Grams(b.column(2), b.column(3))))], names=schema.names)

    out = table.mapInArrow(scan, schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep],
                      F.struct("p_weak", "score", (F.col("score") >= threshold).alias("kept")).alias(out_col))


def digest(docs: DataFrame) -> DataFrame:
    return classify(docs.select("doc_id", "text")).select("doc_id", "quality.p_weak", "quality.score", "quality.kept")
