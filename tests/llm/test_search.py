"""op11 and op13 against brute force and their SQL."""

import math
import re
from collections import Counter
from itertools import permutations

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from certloom.llm import filter_audit, lexical_search, pieces, sql
from certloom.llm import textops as T


def by_sql(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    r = con.execute(sql.ORACLE_SQL[name])
    return [c[0] for c in r.description], r.fetchall()


# ---------------------------------------------------------------- op11
def ranked(docs, items, k=20):
    terms = {i: brute.alnum_words(t) for i, t in docs}
    n_docs, total = sum(bool(x) for x in terms.values()), sum(map(len, terms.values()))
    tf = {i: Counter(x) for i, x in terms.items()}
    df = Counter(x for c in tf.values() for x in c)
    out = []
    for item, text in items:
        want = Counter(brute.alnum_words(text))
        scores = []
        for i, c in tf.items():
            if not c:
                continue
            m = 100 - 25 + (25 * len(terms[i]) * n_docs) // total
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    * ((10**9 * c[x]) // (1000 * c[x] + 12 * m)) for x, n in want.items() if c[x])
            if s > 0:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_search_given(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = lexical_search.digest(documents, bench)
    names, want = by_sql("op11_ranked_lexical_search")
    assert got.columns == names and rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("shard", [4 << 20, 150])
def test_search_small(spark, shard, monkeypatch):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(1, 200), p=np.arange(60, 0, -1) / 1830))) for i in range(150)]
    docs += [(200 + i, "copy of W1 w2 w2") for i in range(40)] + [(300, None), (301, ""), (302, "-- !"), (303, "É日本 w3,w3")]
    items = [(1, "w50 w51 w2"), (2, "W1 w1 copy"), (3, None), (4, ""), (5, "nowhere"), (6, "w3 w4 é日本 É日本"), (7, "w0 w0 w0")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "BLOCK", 16)
    assert rows(lexical_search.search(df, q, k=7, max_shard_bytes=shard)) == ranked(docs, items, 7)


def test_bounds_are_bounds():
    """Every bound is at least the exact score, and most documents are ruled out."""
    rng = np.random.default_rng(5)
    vocab = np.array([f"t{i}" for i in range(3000)])
    texts = [" ".join(rng.choice(vocab[:500 + 5 * i], 30 + i)) for i in range(200)]
    column = pa.array(texts)
    items = lexical_search.Items([(0, texts[3][:150]), (1, "t1 t2 t3 t3"), (2, texts[199])])
    a, size, doc, h, tf = next(lexical_search.term_counts(column))
    assert a == 0 and len(size) == 200
    df = np.zeros(len(items.terms), np.int64)
    known, at = items.lookup(h)
    np.add.at(df, at[known], 1)
    items.weigh(df, 200, int(size.sum()))
    exact = np.zeros((3, 200), np.int64)
    for row, item, score in lexical_search.exact_scores(items, column, pa.array([[0, 1, 2]] * 200)):
        exact[item, row] = score
    width = np.full(200, lexical_search.signature_width(300), np.int64)
    packed, start = lexical_search._signatures(doc, h, tf, width)
    sl = lexical_search._slices([packed[s:s + w // 8] for s, w in zip(start, width, strict=True)], int(width[0]))
    most = np.array([tf[doc == i].max() for i in range(200)])
    for which, bounds in lexical_search.block_bounds(items, int(width[0]), 200, sl, size, most):
        assert (bounds >= exact[which]).all()
        assert (bounds[0] >= exact[0].max()).sum() < 20


def test_search_odd(spark, odd, nothing):
    q = spark.createDataFrame([(1, "word"), (1, "word"), (2, "three four five"), (None, "ab"), (3, "aaa")],
                              "item_id long, text string")
    got = lexical_search.search(odd, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    seen = {}
    for r in got.collect():
        seen.setdefault(r.item_id, []).append((r["rank"], r.doc_id))
    assert sorted(x for x in seen[1]) == [(1, 3), (2, 3)] and seen[None] == [(1, 7)] and 3 not in seen
    assert [r for r, _ in sorted(seen[2])] == [1, 2, 3, 4] and {i for _, i in seen[2]} == {None, 4, 5, 6}
    assert lexical_search.search(nothing, q).count() == 0
    assert lexical_search.search(odd, q.limit(0)).count() == 0


def test_long_text_pieces(spark, monkeypatch):
    """A text in pieces has the counts of the whole text, and its words are not cut."""
    text = " ".join(f"w{i % 97} Long{'x' * (i % 50)}" for i in range(9000))
    whole = {bytes(x): n for x, n in Counter(brute.alnum_words(text)).items()}
    monkeypatch.setattr(pieces.text_pieces, "__defaults__", (1000,))
    (a, size, doc, h, n), = lexical_search.term_counts(pa.array([text]))
    assert size.tolist() == [sum(whole.values())] and sorted(n.tolist()) == sorted(whole.values())
    table = T.separators((0x20, 0x20))
    for raw in (b"x" * 5000, b"x" * 2500 + b" " + b"y" * 10, b"", b"a b " * 900):
        buf = np.frombuffer(raw, np.uint8)
        ends = list(pieces.cuts(buf, table, 1000))
        assert ends[-1] == len(raw) and sorted(set(ends)) == ends
        assert all(raw[e - 1:e] == b" " for e in ends[:-1])


# ---------------------------------------------------------------- op13
def audited(docs, labels):
    """docs: [(id, text, lang)] -> rows of the contract."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    smallest = {}
    for i, t, _ in docs:
        smallest[t or ""] = min(smallest.get(t or "", i), i)
    facts = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(x for x, f in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), smallest[t] < i), strict=True) if f)
        facts.append((lang or "", i, fails))
    out = []
    for part in {p for p, _, _ in facts}:
        mine = [(i, f) for p, i, f in facts if p == part]
        removed = {}
        for order in permutations("ABCDE"):
            for i, fails in mine:
                step = min((order.index(x) + 1 for x in fails), default=None)
                if step:
                    removed.setdefault(("".join(order), step), []).append(i)
        for order in permutations("ABCDE"):
            name, kept = "".join(order), len(mine)
            for step, x in enumerate(order, 1):
                gone = removed.get((name, step), [])
                kept -= len(gone)
                out.append((part, name, step, kept, len(gone), sum(x in f for _, f in mine) - len(gone),
                            sum(f == x for _, f in mine), len(good & set(gone)), len(toxic & set(gone)),
                            sum(len(v) for (o, s), v in removed.items() if o[s - 1] == x)))
    return sorted(out)


def test_audit_given(spark, documents):
    got = filter_audit.digest(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    names, want = by_sql("op13_filter_interaction_audit")
    assert got.columns == names and rows(got) == sorted(want, key=str)


def test_audit_small(spark):
    long = " ".join(f"word{i}" for i in range(120))
    docs = [(5, long, "en"), (3, long, "de"), (9, long, "en"), (1, None, None), (2, "", "en"), (4, "A B#", "en"),
            (6, "same " * 150, "en"), (7, "SAME " * 150, "fr"), (8, long + " $", "fr"), (10, "A B#", "en")]
    labels = [(5, 1, 0), (4, 0, 1), (9, 1, 1), (1, None, 1), (7, 1, None), (99, 1, 1), (None, 1, 1), (5, 0, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in filter_audit.digest(df, lab).collect()) == audited(docs, labels)


def test_audit_intervals():
    """Each mask's intervals hold every order once, at the step of its first filter."""
    orders = ["".join(p) for p in permutations(filter_audit.FILTERS)]
    assert [filter_audit.rank(o) for o in orders] == list(range(120))
    for mask in range(1, 32):
        steps = {}
        for step, lo, hi in filter_audit.intervals(mask):
            for r in range(lo, hi):
                assert r not in steps
                steps[r] = step
        want = {r: min(o.index(x) + 1 for i, x in enumerate("ABCDE") if mask >> i & 1) for r, o in enumerate(orders)}
        assert steps == want
    assert filter_audit.intervals(0) == []


def test_audit_odd(spark, odd, nothing):
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    got = filter_audit.digest(odd, labels)
    assert got.count() == 1200 and {r.part for r in got.select("part").distinct().collect()} == {"", "en"}
    first = got.where("step = 5").groupBy("part").agg({"kept": "max", "kept": "min"}).collect()
    assert len(first) == 2
    total = sum(r.kept + r.removed for r in got.where("step = 1 and filter_order = 'ABCDE'").collect())
    assert total == odd.count()
    assert filter_audit.digest(nothing, labels).count() == 0
    assert filter_audit.digest(odd, labels.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0
