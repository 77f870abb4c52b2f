"""Toxicity classifier with a counterfactual penalty.

A sentence (up to ``SENTENCE`` words, ended by ``.``, ``!``, ``?`` or a line) is scored by a linear model
over the hashed character grams and words in it; a document's score is its most toxic sentence's, made a
probability.  Documents are labelled, sentences are not, so each labelled document stands for its
sentences of the highest class odds, and its loss is that of the sentence the model finds most toxic.

Words that only name a group of people (``IDENTITY``, a parameter) must not decide: in every training
sentence that has one, the terms are swapped for other terms, and half the squared change of the score,
times ``penalty``, is added to the loss.  A term that the toxic rows happen to mention often then cannot carry weight of
its own, and a neutral mention scores like the same sentence about anyone else.

Fitted on about ``max_fit_rows`` labelled rows a class, chosen by a hash of the id (all rows of a smaller
class), whole texts, copies once.  Only features whose class odds chance does not explain get a weight, and at most
``PER_DOC`` sentences of each row come to the driver.  The fit reads only texts and labels
of rows that are not held out; scoring reads only texts, in one pass without a shuffle.

Defined results: null and empty texts are one empty sentence and get its score; rows that repeat an id are
scored each by itself; an id that has several labels is toxic if one of them is; rows without an id are not
learned from; other columns pass through whatever their names, save that the results replace columns of
their names; without labels of both classes every score is the share of toxic labels (0 without any); an empty
table gives an empty result.  Texts of any length are read in pieces, cut at sentence ends where there is one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T
from .pieces import text_pieces

DIM = 1 << 18
GRAMS = (4, 5)
SENTENCE, PER_DOC, SWAPS = 40, 4, 2
CERTAIN, FEWEST = 4.0, 100
U32, U64 = np.uint32, np.uint64

#: Terms that name groups of people, in the four languages of the corpus.
IDENTITY = (
    "women", "men", "woman", "man", "girls", "boys", "mothers", "fathers", "gay", "lesbian", "straight", "queer",
    "transgender", "bisexual", "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "hindus",
    "buddhist", "buddhists", "atheists", "catholics", "black", "white", "asian", "african", "mexican", "chinese",
    "arab", "arabs", "turkish", "polish", "immigrants", "refugees", "disabled", "deaf", "blind", "elderly",
    "frauen", "männer", "juden", "christen", "muslime", "flüchtlinge", "behinderte", "schwule", "lesben",
    "femmes", "hommes", "juifs", "chrétiens", "musulmans", "réfugiés", "handicapés", "immigrés",
    "mujeres", "hombres", "judíos", "cristianos", "musulmanes", "refugiados", "inmigrantes", "discapacitados")

#: A word is a run of ASCII letters, digits and bytes of other characters.
_BREAK = T.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True


# ------------------------------------------------------------------ features
def _fold(h: np.ndarray) -> np.ndarray:
    return (T.mix(h) >> U64(64 - DIM.bit_length() + 1)).astype(np.int32)


def _features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(word, feature) of all words (lower-cased bytes): the grams within ``<word>`` and the word itself."""
    size = ends - starts
    wide = size + 2
    first = np.cumsum(wide) - wide
    text = np.full(int(wide.sum()), 0x3E, np.uint8)  # <word>
    text[first] = 0x3C
    text[T.ranges(first + 1, size)] = buf[T.ranges(starts, size)]
    sums = T.span_sums(T.byte_values(text))
    words, found = [np.arange(len(size))], [_fold(T.span_hash(sums, first, first + wide))]
    for n in GRAMS:
        some = np.maximum(wide - n + 1, 0)
        at = T.ranges(first, some)
        words.append(np.repeat(np.arange(len(size)), some))
        found.append(_fold(T.span_hash(sums, at, at + n)))
    return np.concatenate(words), np.concatenate(found)


def sentences(buf: np.ndarray, off: np.ndarray):
    """Word starts and ends, each word's sentence, and each sentence's text; sentences of one text follow
    each other, and a text has at least one."""
    starts, ends, at = T.word_spans(buf, off, _BREAK)
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    stops = np.concatenate([[0], np.cumsum(_STOP[buf])])
    new = np.ones(len(starts), bool)
    if len(starts):
        new[1:] = (stops[starts[1:]] > stops[ends[:-1]]) | (doc[1:] != doc[:-1])
        run = np.flatnonzero(new)
        place = np.arange(len(starts)) - np.repeat(run, np.diff(np.append(run, len(starts))))
        new |= place % SENTENCE == 0
    sentence = np.cumsum(new) - 1
    owner = doc[new]
    return starts, ends, sentence, owner


def split(column):
    """(first row, texts, last, lower-cased bytes, word starts, word ends, sentence of each word, text of each sentence)."""
    for a, last, buf, off in text_pieces(column, _STOP):
        low = T.LOWER[buf]
        yield (a, len(off) - 1, last, low, *sentences(low, off))


# ------------------------------------------------------------------ model
@dataclass
class Model:
    weights: np.ndarray      # of the features
    bias: float
    scale: float             # probability = sigmoid(scale * score + shift)
    shift: float

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))


def _sums(weights: np.ndarray, buf, starts, ends, sentence, n: int) -> np.ndarray:
    word, feature = _features(buf, starts, ends)
    return np.bincount(sentence[word], weights[feature], n) if len(word) else np.zeros(n)


def text_scores(model: Model, column) -> np.ndarray:
    """Each text's probability."""
    out = np.full(len(column), -np.inf)
    for a, n, _, buf, starts, ends, sentence, owner in split(column):
        if len(owner):
            np.maximum.at(out, a + owner, _sums(model.weights, buf, starts, ends, sentence, len(owner)) + model.bias)
    return model.probability(np.where(np.isneginf(out), model.bias, out))


class _Sentences:
    """Training sentences as one list of features with offsets."""

    def __init__(self, lists: list[np.ndarray]):
        self.size = np.array([len(x) for x in lists], np.int64)
        self.feature = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(len(lists)), self.size)

    def score(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.feature], len(self.size))

    def pull(self, g: np.ndarray, dim: int) -> np.ndarray:
        """Gradient of the weights from that of the scores."""
        return np.bincount(self.feature, g[self.row], dim)


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Scale and shift that make scores probabilities, by Newton steps with a small ridge; the weights bring
    the classes to their shares of all labels."""
    x = np.stack([z, np.ones(len(z))], axis=1)
    t = np.where(y == 1, 1 - 1e-3, 1e-3)
    b = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        pull = x.T @ ((p - t) * weight) + 1e-4 * (b - [1.0, 0.0])
        curve = (x * (p * (1 - p) * weight)[:, None]).T @ x + 1e-4 * np.eye(2)
        move = np.linalg.solve(curve, pull)
        b -= move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-9))
        b[0] = max(b[0], 0.05)
    return float(b[0]), float(b[1])


def train(lists, doc, label, swapped, origin, share: float = 0.5, penalty: float = 1.0, decay: float = 1e-3, rounds: int = 60,
          rate: float = 0.1) -> Model:
    """``lists``: the features of each sentence; ``doc``: its document; ``label``: of each document; ``swapped``:
    features of counterfactual sentences and ``origin``, the sentence each comes from.  Adagrad on the logistic
    loss of each document's highest sentence, classes weighted alike, plus the penalty on score changes.
    ``share``: of toxic documents among all labels, for the probabilities."""
    features = np.unique(np.concatenate([*lists, *swapped, np.zeros(0, np.int32)]))
    dim = len(features)
    real = _Sentences([np.searchsorted(features, x) for x in lists])
    other = _Sentences([np.searchsorted(features, x) for x in swapped])
    origin = np.asarray(origin, np.int64)
    n = np.bincount(label, minlength=2)
    weight = np.where(label == 1, 0.5 / max(n[1], 1), 0.5 / max(n[0], 1))
    w, bias, seen = np.zeros(dim), 0.0, np.full(dim + 1, 1e-6)
    by_doc = np.lexsort((np.arange(len(doc)), doc))
    begin = np.flatnonzero(np.concatenate([[True], np.diff(doc[by_doc]) > 0]))

    def top(z):
        """Each document's highest sentence."""
        order = np.lexsort((-z, doc))
        return order[begin]

    for step in range(rounds):
        z = real.score(w) + bias
        best = top(z)
        miss = (1 / (1 + np.exp(-np.clip(z[best], -30, 30))) - label[doc[best]]) * weight[doc[best]]
        if step == 0:  # before anything is known every sentence speaks for its document
            each = 1 / np.bincount(doc, minlength=len(label))[doc]
            g = (0.5 - label[doc]) * weight[doc] * each
        else:
            g = np.zeros(len(z))
            g[best] = miss
        grad = real.pull(g, dim) + decay * w / max(len(label), 1)
        if len(origin):
            change = (other.score(w) + bias - z[origin]) * (penalty / len(origin))
            grad += other.pull(change, dim) - real.pull(np.bincount(origin, change, len(z)), dim)
        full = np.append(grad, g.sum())
        seen += full * full
        move = rate * full / np.sqrt(seen)
        w -= move[:-1]
        bias -= move[-1]
    z = (real.score(w) + bias)
    z = z[top(z)]
    y = label[doc[by_doc][begin]]
    scale, shift = platt(z, y, np.where(y == 1, share / max(n[1], 1), (1 - share) / max(n[0], 1)))
    weights = np.zeros(DIM)
    weights[features] = w
    return Model(weights, bias, scale, shift)


# ------------------------------------------------------------------ training rows
def _odds(rows: DataFrame) -> np.ndarray:
    """Log odds of each feature, by the documents of each class that have it (at most DIM rows)."""
    schema = pa.schema([("f", pa.int32()), ("y", pa.int32()), ("n", pa.int64())])

    def scan(batches):
        total = np.zeros((2, DIM + 1), np.int64)
        for b in batches:
            label = np.array(b.column(1).to_pylist(), np.int64)
            rest: list = []
            for a, n, last, buf, starts, ends, sentence, owner in split(b.column(0)):
                word, feature = _features(buf, starts, ends)
                rest.append(np.unique(owner[sentence[word]] * DIM + feature) if len(word) else np.zeros(0, np.int64))
                if not last:
                    continue
                pair = np.unique(np.concatenate(rest))
                rest = []
                y = label[a + pair // DIM]
                for c in (0, 1):
                    total[c, :DIM] += np.bincount(pair[y == c] % DIM, minlength=DIM)
                    total[c, DIM] += int((label[a:a + n] == c).sum())
        y, f = np.nonzero(total)
        yield T.batch(schema, f=f.astype(np.int32), y=y.astype(np.int32), n=total[y, f])

    got = rows.mapInArrow(scan, "f int, y int, n long").groupBy("f", "y").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((2, DIM + 1))
    total[got["y"].to_numpy(), got["f"].to_numpy()] = got["n"].to_numpy()
    return class_odds(total[:, :DIM], total[:, DIM:])


def class_odds(found: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Log odds of each feature from the documents of each class (row 0, 1) that have it; 0 for those that chance
    explains (under ``CERTAIN`` standard errors), save that the ``FEWEST`` surest always count."""
    odds = np.log((found[1] + 0.5) / (documents[1] + 1)) - np.log((found[0] + 0.5) / (documents[0] + 1))
    sure = np.abs(odds) / np.sqrt(1 / (found[1] + 0.5) + 1 / (found[0] + 0.5))
    least = min(CERTAIN, np.sort(sure)[-FEWEST])
    return np.where((sure >= least) & (sure > 1), odds, 0.0)


def _identity_hashes(terms) -> np.ndarray:
    raw = [t.lower().encode() for t in terms]
    size = np.array([len(x) for x in raw], np.int64)
    ends = np.cumsum(size)
    return T.word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - size, ends)


def swaps(terms: list[str], which: int, times: int) -> list[str]:
    """``times`` other terms for the term, spread over the list."""
    n = len(terms)
    return [terms[(which + 1 + (i * (n - 1)) // max(times, 1)) % n] for i in range(min(times, n - 1))]


def _training_sentences(rows: DataFrame, odds: np.ndarray, identity: tuple[str, ...], per_doc: int, times: int) -> pa.Table:
    """(id, y, features, swapped): each document's sentences of the highest odds, with their counterfactuals."""
    schema = S.StructType([S.StructField("id", S.StringType()), S.StructField("y", S.IntegerType()),
                           S.StructField("features", S.ArrayType(S.IntegerType())),
                           S.StructField("swapped", S.ArrayType(S.ArrayType(S.IntegerType())))])
    arrow = pa.schema([("id", pa.string()), ("y", pa.int32()), ("features", pa.list_(pa.int32())),
                       ("swapped", pa.list_(pa.list_(pa.int32())))])
    shared = rows.sparkSession.sparkContext.broadcast(odds)
    known = _identity_hashes(identity) if identity else np.zeros(0, U64)
    order = np.argsort(known)

    def scan(batches):
        odds = shared.value
        for b in batches:
            pending: dict[int, list] = {}
            for a, n, last, buf, starts, ends, sentence, owner in split(b.column(0)):
                word, feature = _features(buf, starts, ends)
                mean = np.bincount(sentence[word], np.maximum(odds[feature], 0), len(owner)) if len(word) else (
                    np.zeros(len(owner)))
                by = np.argsort(sentence[word], kind="stable")
                cut = np.searchsorted(sentence[word][by], np.arange(len(owner) + 1))
                first = np.searchsorted(sentence, np.arange(len(owner) + 1))
                groups = np.zeros(0, np.int64)
                if len(known):
                    h = T.word_hashes(buf, starts, ends)
                    at = np.minimum(np.searchsorted(known[order], h), len(known) - 1)
                    groups = np.where(known[order][at] == h, order[at], -1)
                best = np.lexsort((-mean, owner))
                rank = np.arange(len(owner)) - np.searchsorted(owner[best], owner[best])
                for s in best[rank < per_doc].tolist():
                    swapped = []
                    w0, w1 = int(first[s]), int(first[s + 1])
                    if len(groups) and (groups[w0:w1] >= 0).any():
                        for i in range(min(times, len(identity) - 1)):
                            words = [swaps(identity, int(groups[w]), times)[i].lower().encode() if groups[w] >= 0
                                     else bytes(buf[starts[w]:ends[w]]) for w in range(w0, w1)]
                            size = np.array([len(x) for x in words], np.int64)
                            stop = np.cumsum(size)
                            other = _features(np.frombuffer(b"".join(words), np.uint8), stop - size, stop)[1]
                            swapped.append(other[odds[other] != 0].tolist())
                    row = feature[by[cut[s]:cut[s + 1]]]
                    row = row[odds[row] != 0].tolist()
                    pending.setdefault(a + int(owner[s]), []).append((float(mean[s]), row, swapped))
                if not last:
                    continue
                done = [(i, x) for i, mine in pending.items() for x in sorted(mine, key=lambda x: -x[0])[:per_doc]]
                pending = {}
                if done:
                    yield pa.RecordBatch.from_arrays([
                        b.column(2).take(pa.array([i for i, _ in done])), b.column(1).take(pa.array([i for i, _ in done])),
                        pa.array([x[1] for _, x in done], arrow.field("features").type),
                        pa.array([x[2] for _, x in done], arrow.field("swapped").type)], schema=arrow)

    return rows.mapInArrow(scan, schema).orderBy("id", "y", "features").toArrow()


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
        identity: tuple[str, ...] = IDENTITY, max_fit_rows: int = 3000, penalty: float = 1.0,
        per_doc: int = PER_DOC, times: int = SWAPS) -> Model:
    """Fit on the labelled documents whose ``labels`` row meets ``training`` (a condition on ``doc_id``)."""
    spark = docs.sparkSession
    T.prepare(spark)
    known = labels.where(training & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").alias("_lid")).agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_y"))
    sizes = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}  # two rows
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    if len(sizes) < 2:
        z = np.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        return Model(np.zeros(DIM), 0.0, 1.0, z)
    place = F.pmod(F.xxhash64(F.col("_lid").cast("string")), F.lit(1_000_003)) / 1_000_003
    limit = F.when(F.col("_y") == 1, F.lit(max_fit_rows / sizes[1])).otherwise(F.lit(max_fit_rows / sizes[0]))
    chosen = known.where(place < limit)  # about 2 * max_fit_rows rows
    rows = docs.join(F.broadcast(chosen), F.col(f"`{id_col}`") == F.col("_lid")).select(
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"), "_y", F.col("_lid").cast("string").alias("i"))
    # copies of a text are one training row, or their grams would look telling
    rows = T.materialize(rows.groupBy("t").agg(F.max("_y").alias("_y"), F.min("i").alias("i")))
    found = _training_sentences(rows, _odds(rows.select("t", "_y")), identity, per_doc, times)
    if len(found) == 0 or len(set(found["y"].to_pylist())) < 2:
        return Model(np.zeros(DIM), 0.0, 1.0, float(np.log(share / (1 - share))))
    lists = [np.array(x, np.int32) for x in found["features"].to_pylist()]
    names = {i: n for n, i in enumerate(dict.fromkeys(found["id"].to_pylist()))}
    doc = np.array([names[i] for i in found["id"].to_pylist()], np.int64)
    label = np.zeros(len(names), np.int64)
    label[doc] = found["y"].to_numpy()
    swapped, origin = [], []
    for n, x in enumerate(found["swapped"].to_pylist()):
        swapped += [np.array(f, np.int32) for f in x]
        origin += [n] * len(x)
    return train(lists, doc, label, swapped, origin, share, penalty)


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the text, plus score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM numbers
    new = ("score", "predicted")
    keep = [c for c in docs.columns if c != text_col and c not in new]
    d = docs.select(F.col(f"`{text_col}`").alias("_t"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
                    if keep else F.lit(None).cast("struct<_:int>").alias("_row"))
    schema = S.StructType([d.schema["_row"], S.StructField("score", S.DoubleType())])

    def scan(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(text_scores(shared.value, b.column(0)))],
                                             names=schema.names)

    return d.mapInArrow(scan, schema).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep], "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def held_out(id_col: str = "doc_id") -> Column:
    code = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.coalesce(code % 4 == 2, F.lit(False))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), ~held_out())
    return score(docs.select("doc_id", "text", held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "score", "predicted")
