"""op12: held-out labels, planted toxic sentences, and the counterfactual penalty."""

import numpy as np
import pyarrow as pa

from certloom.llm import toxicity

CALM = [f"calm{a}{b}" for a in "abcdefgh" for b in "stuvwxyz"]
RUDE = ["grobian", "lumpsack", "schuftig", "dumbhead"]


def corpus(n, seed, biased=True):
    """Documents of several sentences.  Toxic ones hold rude words and, if ``biased``, mostly mention a group, which
    few of the others do."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        text = [list(rng.choice(CALM, rng.integers(6, 12))) for _ in range(rng.integers(1, 8))]
        if toxic:
            at = text[rng.integers(len(text))]
            at[2:2] = list(rng.choice(RUDE, 2))
            if biased and rng.random() < 0.9:
                at.insert(1, str(rng.choice(["women", "muslims"])))
        elif rng.random() < 0.03:
            text[0].insert(1, "women")
        rows.append((i, ". ".join(" ".join(s) for s in text)))
        labels.append((i, toxic))
    return rows, labels


def _fit(spark, rows, labels, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.fit(docs, lab, ~toxicity.held_out(), **kw)


def test_held_out_labels(spark):
    rows, labels = corpus(800, 1, biased=False)
    model = _fit(spark, rows, labels)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = dict(labels)
    got = [(lab[r.doc_id], r.predicted) for r in toxicity.score(docs.select("doc_id", "text", toxicity.held_out().alias(
        "held_out")), model).where("held_out").collect()]
    assert len(got) > 100
    assert np.mean([a == b for a, b in got]) > 0.97


def test_neutral_mentions(spark):
    """The penalty takes the weight off a group's name; the rude words keep theirs."""
    rows, labels = corpus(900, 2)
    neutral = pa.array([f"{g} {' '.join(CALM[i:i + 7])}" for g in ("women", "muslims") for i in range(0, 50, 5)])
    plain = pa.array([" ".join(CALM[i:i + 7]) for i in range(0, 50, 5)] * 2)
    rude = pa.array([f"calmas {a} {b} calmbs" for a in RUDE for b in RUDE if a != b])
    free, bound = _fit(spark, rows, labels, penalty=0.0), _fit(spark, rows, labels, penalty=10.0)
    gap = [np.abs(np.log(toxicity.text_scores(m, neutral)) - np.log(toxicity.text_scores(m, plain))).mean()
           for m in (free, bound)]
    assert gap[1] < 0.5 * gap[0]
    false = [(toxicity.text_scores(m, neutral) >= 0.3).mean() for m in (free, bound)]
    assert false[1] <= false[0] and false[1] < 0.05
    assert (toxicity.text_scores(bound, rude) >= 0.3).all()


def test_swaps():
    terms = ["a", "b", "c", "d"]
    for i in range(4):
        other = toxicity.swaps(terms, i, 2)
        assert len(set(other)) == 2 and terms[i] not in other
    assert toxicity.swaps(["a"], 0, 2) == []
    assert len(set(toxicity.IDENTITY)) == len(toxicity.IDENTITY)


def test_one_bad_sentence_in_a_long_text(spark, monkeypatch):
    rows, labels = corpus(600, 4, biased=False)
    model = _fit(spark, rows, labels)
    calm = ". ".join(" ".join(CALM[i % 50:i % 50 + 9]) for i in range(9000))
    bad = calm + ". you grobian lumpsack. " + calm
    scores = toxicity.text_scores(model, pa.array([calm, bad]))
    assert len(bad) > 1_000_000 and scores[0] < 0.3 <= scores[1]
    monkeypatch.setattr(toxicity.text_pieces, "__defaults__", (5000,))
    assert np.allclose(toxicity.text_scores(model, pa.array([calm, bad])), scores, atol=1e-9)


def test_same_for_any_partitioning(spark):
    rows, labels = corpus(300, 6)
    got = []
    for n in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        m = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ~toxicity.held_out())
        got.append([r.score for r in toxicity.score(docs, m).orderBy("doc_id").collect()])
    assert np.allclose(*got, atol=1e-9)


def test_toxicity_odd(spark, odd, nothing):
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 0), (5, None), (None, 1), (6, 0), (9, 1), (11, 0)],
                                   "doc_id long, toxic int")
    out = toxicity.score(odd, toxicity.fit(odd, labels, ~toxicity.held_out()))
    assert out.columns == [c for c in odd.columns if c != "text"] + ["score", "predicted"] and out.count() == odd.count()
    scores = [r.score for r in out.collect()]
    assert all(0 <= s <= 1 for s in scores)
    clash = odd.withColumn("score", odd.h).withColumn("predicted", odd.h)
    assert toxicity.score(clash, toxicity.fit(clash, labels, ~toxicity.held_out())).columns == out.columns
    assert toxicity.digest(nothing, labels).count() == 0
    for some, want in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        got = toxicity.digest(odd, some)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        assert all(abs(r.score - want) < 1e-9 for r in got.collect())
