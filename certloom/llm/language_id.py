"""Language identification by nearest centroid.

A text is the TF-IDF vector (log counts, unit length) of its hashed byte n-grams.  Document
frequencies count every training document; each language's vectors are clustered into several
centroids by spherical k-means; a text takes the language of the centroid with the largest cosine
and is ``rejected`` where that cosine is under the floor its language's own documents keep.

Frequencies cover all training rows.  Centroids are fitted on about ``max_fit_rows`` rows per
language, chosen by a hash of the id (all rows of a smaller language).

Defined results: null text, or text without a letter, is ``und`` with score 0; rows without a language or an
id are not learned from, but predicted; without training rows everything is ``und``; rows that repeat an id
are predicted each by itself; other columns pass through whatever their names, but one named like a result
column gives way to it, save that the results replace columns of their names; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T

UNKNOWN = "und"
DIM, SIZES, ROWS = 4096, (2, 3), 128
LETTER = regex.compile(r"\p{L}")
#: Lower-cased; ASCII bytes that are no letters are blanks.
_LETTERS = np.where(T.separators((0x61, 0x7A), (0x80, 0xFF))[T.LOWER], T.LOWER, 32).astype(np.uint8)


def counts(buf, off) -> np.ndarray:
    return T.hashed_grams(buf, off, DIM, _LETTERS, SIZES)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids, started from the mean and the rows farthest from those chosen."""
    centres = unit(x.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(x)):
        centres = np.concatenate([centres, x[[np.argmin((x @ centres.T).max(axis=1))]]])
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        filled = np.bincount(near, minlength=len(centres)) > 0
        centres = np.where(filled[:, None], unit(sums), centres)
    return centres


class Model:
    def __init__(self, idf: np.ndarray):
        self.idf = idf.astype(np.float32)
        self.centres, self.owner, self.langs, self.floors = np.zeros((0, len(idf)), np.float32), [], [], []

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        return unit(np.log1p(grams) * self.idf)

    def add(self, lang: str, x: np.ndarray, k: int) -> None:
        centres = spherical_kmeans(x, k).astype(np.float32)
        self.floors.append(0.8 * float(np.quantile((x @ centres.T).max(axis=1), 0.01)))
        self.owner += [len(self.langs)] * len(centres)
        self.langs.append(lang)
        self.centres = np.concatenate([self.centres, centres])

    def predict(self, grams: np.ndarray):
        """language index, cosine, rejected."""
        cosine = self.vectors(grams) @ self.centres.T
        best = cosine.argmax(axis=1)
        lang = np.array(self.owner)[best]
        score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0, 1)
        return lang, score, score < np.array(self.floors)[lang]


def _frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that have each gram, and documents, over all training rows."""
    schema = pa.schema([("i", pa.int32()), ("n", pa.int64())])

    def scan(batches):
        total = np.zeros(DIM + 1, np.int64)
        for b in batches:
            for _, buf, off in T.row_slices(b.column(0), ROWS):
                total[:DIM] += (counts(buf, off) > 0).sum(axis=0)
                total[DIM] += len(off) - 1
        yield T.batch(schema, i=np.arange(DIM + 1, dtype=np.int32), n=total)

    rows = train.select("_t").mapInArrow(scan, "i int, n long").groupBy("i").agg(F.sum("n")).collect()  # DIM + 1
    out = np.zeros(DIM + 1, np.int64)
    for i, n in rows:
        out[i] = n
    return out[:DIM], int(out[DIM])


def fit(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        centroids: int = 4, max_fit_rows: int = 400) -> Model | None:
    """Fit on the rows where ``training`` holds and the language and the text are given."""
    T.prepare(docs.sparkSession)
    train = docs.where(training & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"), F.col(f"`{lang_col}`").alias("_l"))
    df, n = _frequencies(train)
    if not n:
        return None
    model = Model(np.log((1 + n) / (1 + df)) + 1)
    sizes = {r["_l"]: r["count"] for r in train.groupBy("_l").count().collect()}  # one row per language
    share = F.create_map(*[F.lit(x) for lang, size in sizes.items() for x in (lang, max_fit_rows / size)])
    place = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1_000_003)) / 1_000_003
    idf = model.idf
    schema = pa.schema([("lang", pa.string()), ("x", pa.binary())])

    def vectors(batches):
        m = Model(idf)
        for b in batches:
            for a, buf, off in T.row_slices(b.column(0), ROWS):
                x = m.vectors(counts(buf, off)).astype(np.float32)
                yield T.batch(schema, lang=b.column(1).slice(a, len(x)), x=[v.tobytes() for v in x])

    rows = train.where(place < share[F.col("_l")]).select("_t", "_l").mapInArrow(
        vectors, "lang string, x binary").collect()  # about max_fit_rows vectors a language
    rows.sort()
    for lang in sorted({r.lang for r in rows}):
        x = np.stack([np.frombuffer(r.x, np.float32) for r in rows if r.lang == lang])
        x = x[np.abs(x).sum(axis=1) > 0]
        if len(x):
            model.add(lang, x, centroids)
    return model if model.langs else None


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM floats a centroid
    new = ("lang_pred", "score", "rejected")
    keep = T.beside(docs.columns, text_col, *new)
    d = docs.select(F.col(f"`{text_col}`").alias("_t"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
                    if keep else F.lit(None).cast("struct<_:int>").alias("_row"))
    schema = S.StructType([d.schema["_row"], S.StructField("lang_pred", S.StringType()),
                           S.StructField("score", S.DoubleType()), S.StructField("rejected", S.BooleanType())])

    def scan(batches):
        m = shared.value
        for b in batches:
            n = b.num_rows
            lang, score, rejected = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
            if m is not None:
                named = np.array(m.langs, object)
                for a, buf, off in T.row_slices(b.column(0), ROWS):
                    which, cosine, low = m.predict(counts(buf, off))
                    for i, text in enumerate(b.column(0).slice(a, len(off) - 1)):
                        text = text.as_py()
                        if text is not None and LETTER.search(text):
                            lang[a + i], score[a + i], rejected[a + i] = named[which[i]], cosine[i], low[i]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(lang, pa.string()), pa.array(score),
                                              pa.array(rejected)], names=schema.names)

    out = d.mapInArrow(scan, schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], *new)


def held_out(id_col: str = "doc_id") -> Column:
    code = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.coalesce(code % 4 == 2, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs, ~held_out() & F.col("doc_id").isNotNull())
    d = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(d, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
