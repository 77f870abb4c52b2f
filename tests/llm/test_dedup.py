"""op3, op5 and op6 against brute force."""

import brute
import numpy as np
import pytest

from certloom.llm import simhash_dedup, substring_dedup, suffix_dedup
from certloom.llm import textops as T


def rows(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select(*cols).collect()}


def test_suffix_digest(documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    assert rows(suffix_dedup.digest(documents), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") \
        == brute.bytes_removed(docs, 200)


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("hot", [1, 2000])
def test_suffix_small(spark, keep, hot):
    rng = np.random.default_rng(5)
    parts = ["".join(rng.choice(list("abcé "), 30)) for _ in range(12)]
    docs = [(i, "".join(rng.choice(parts, rng.integers(0, 9)))) for i in range(60)]
    docs += [(60, None), (61, "xyz" * 50), (62, docs[3][1]), (63, "q" * 19)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = suffix_dedup.remove_repeats(df, size=20, keep=keep, hot_group=hot)
    got = {r.doc_id: (r.repeats.n_bytes, r.repeats.n_removed, len(r.repeats.spans), brute.sha(bytes(r.repeats.kept)))
           for r in out.collect()}
    assert got == brute.bytes_removed(docs, 20, first_stays=keep == "first")


def test_factor_arrays():
    text = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    size = 4
    starts = np.arange(len(text) - size + 1)
    rank = suffix_dedup.prefix_ranks(text, starts, size)
    strings = [bytes(text[i:i + size]) for i in starts]
    assert [sorted(set(strings)).index(s) for s in strings] == rank.tolist()
    earlier, later = suffix_dedup.factor_flags(rank, starts)
    assert earlier.tolist() == [strings[i] in strings[:i] for i in starts]
    assert later.tolist() == [strings[i] in strings[i + 1:] for i in starts]
    for size in (1, 2, 7, 8, 9, 20, 50, 70):
        text = np.frombuffer(b"abcab" * 30, np.uint8)
        starts = np.arange(len(text) - size + 1)
        strings = [bytes(text[i:i + size]) for i in starts]
        order = sorted(set(strings))
        assert [order.index(s) for s in strings] == suffix_dedup.prefix_ranks(text, starts, size).tolist()
    x = np.array([5, 3, 4, 1, 6, 2])
    left, right = suffix_dedup.smaller_neighbours(x)
    assert left.tolist() == [-1, -1, 1, -1, 3, 3] and right.tolist() == [1, 3, 3, 6, 5, 6]


def test_substring_digest(documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    assert rows(substring_dedup.digest(documents), "doc_id", "n_words", "n_removed", "kept_sha256") \
        == brute.words_removed(docs)


@pytest.mark.parametrize("hot", [1, 2000])
def test_substring_small(spark, hot):
    rng = np.random.default_rng(3)
    parts = [" ".join(rng.choice(list("abcdefg"), 6)) for _ in range(10)]
    docs = [(i, "\n ".join(rng.choice(parts, rng.integers(0, 8)))) for i in range(80)]
    docs += [(80, None), (81, "a " * 900), (82, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = substring_dedup.remove_repeats(df, rejoin_all=True, hot_group=hot)
    got = {r.doc_id: (r.repeats.n_words, r.repeats.n_removed, brute.sha((r.text or "").encode()))
           for r in out.collect()}
    assert got == brute.words_removed(docs)


def test_automaton():
    a = substring_dedup.SuffixAutomaton()
    a.add("abcbc")
    a.add("bcd")
    assert list(a.matches("xabcdbcbc")) == [0, 1, 2, 3, 3, 1, 2, 3, 4]


def test_simhash(documents):
    docs = {r.doc_id: r.text for r in documents.collect()}
    fp = {k: brute.simhash(t) for k, t in docs.items()}
    comp = brute.near_components(fp)
    got = rows(simhash_dedup.digest(documents), "doc_id", "fingerprint", "component_id")
    assert got == {k: (f"{fp[k]:016x}", comp[k]) for k in docs}
    kept = {r.doc_id for r in simhash_dedup.deduplicate(documents).select("doc_id").collect()}
    assert kept == set(comp.values())


@pytest.mark.parametrize("hot,distance", [(20_000, 3), (5, 3), (20_000, 2), (20_000, 6)])
def test_links(spark, hot, distance):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 12).tolist()
    points = set(centres)
    for c in centres:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            points.add(c ^ sum(1 << int(f) for f in flips))
    fp = dict(enumerate(sorted(points)))
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)), k) for k, v in fp.items()], "fp long, k long")
    found = [(r.u, r.v) for r in simhash_dedup.links(df, distance, hot).collect()]
    assert all((fp[a] ^ fp[b]).bit_count() <= distance for a, b in found)
    assert brute.components(fp, found) == brute.near_components(fp, distance)


def test_odd_inputs(odd, nothing):
    n = odd.count()
    five = substring_dedup.remove_repeats(odd)
    assert five.columns == [*odd.columns, "repeats"] and five.count() == n
    three = suffix_dedup.remove_repeats(odd)
    assert three.columns == [c for c in odd.columns if c != "text"] + ["repeats"] and three.count() == n
    six = simhash_dedup.near_duplicates(odd)
    assert six.count() == n
    zero = [r for r in six.collect() if r.fingerprint == "0" * 16]
    assert len(zero) >= 4 and {r.component_id for r in zero} == {0}
    assert simhash_dedup.deduplicate(odd).columns == odd.columns
    for op in (substring_dedup.remove_repeats, suffix_dedup.remove_repeats, simhash_dedup.near_duplicates,
               simhash_dedup.deduplicate):
        assert op(nothing).count() == 0


def test_leftmost_min(monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 500).astype(np.uint64) << np.uint64(40)
    for block in (1 << 20, 7):
        monkeypatch.setattr(T, "MIN_BLOCK", block)
        for w in (1, 5, 64):
            assert T.leftmost_min(x, w).tolist() == [i + int(np.argmin(x[i:i + w])) for i in range(len(x) - w + 1)]
    assert len(T.leftmost_min(x[:3], 5)) == 0


@pytest.mark.parametrize("unit", ["byte", "word"])
@pytest.mark.parametrize("limit", [1, 50, 400])
def test_pieces_hold_each_window_once(unit, limit):
    import pyarrow as pa

    from certloom.llm.anchors import Windows
    rng = np.random.default_rng(1)
    texts = ["", "ab c", None, "".join(rng.choice(list("ab \né"), 900)), "x" * 300, "a " * 300, " " + "word\n" * 70]
    how = Windows(unit, 13, 3)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        tokens = brute.words(t) if unit == "word" else [raw[j:j + 1] for j in range(len(raw))]
        places = []
        for row, first, buf, off in how.slices(pa.array(texts), limit):
            for doc, place in zip(*how.runs(buf, off)[:2]):
                if row + doc == i:
                    start = first + (int(place) >> 16)
                    n = int(place) & 0x7FFF
                    text = how.cut(buf, off, np.array([doc]), np.array([int(place) >> 16]), np.array([n]))[0]
                    want = tokens[start:start + n + 12]
                    assert (text.split() == want) if unit == "word" else text == b"".join(want)
                    places += range(start, start + n)
        assert sorted(places) == list(range(max(len(tokens) - 12, 0)))


def test_long_texts(spark):
    """op3 and op5 on texts longer than a piece, against brute force."""
    rng = np.random.default_rng(6)
    words = np.array(["".join(rng.choice(list("abcdefé"), 6)) for _ in range(3000)])
    a, b = (" ".join(rng.choice(words, 55_000)) for _ in range(2))
    docs = [(0, a), (1, b[:150_000] + a[120_000:300_000] + b[150_000:]), (2, "y " * 150_000), (3, a[1:])]
    assert all(len(t) > T.SLICE_BYTES for _, t in docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = suffix_dedup.remove_repeats(df, size=24, keep="none")
    got = {r.doc_id: (r.repeats.n_bytes, r.repeats.n_removed, len(r.repeats.spans), brute.sha(bytes(r.repeats.kept)))
           for r in out.collect()}
    assert got == brute.bytes_removed(docs, 24)
    assert rows(substring_dedup.digest(df), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.words_removed(docs)


@pytest.mark.parametrize("op,new", [
    (substring_dedup.remove_repeats, ["repeats"]), (suffix_dedup.remove_repeats, ["repeats"]),
    (simhash_dedup.near_duplicates, ["fingerprint", "component_id", "first"])])
def test_clashing_result_names(spark, op, new):
    """A column named like a result gives way to it."""
    df = spark.createDataFrame([(1, "a b", "x", "y", "z", "u", "v")],
                               "doc_id long, text string, Repeats string, fingerprint string, FIRST string, "
                               "component_id string, other string")
    out = op(df)
    names = [c.lower() for c in out.columns]
    assert len(set(names)) == len(names) and out.columns[-len(new):] == new
    assert out.select("doc_id", "other", *new).first()[1] == "v"


def test_text_buffer():
    import pyarrow as pa
    buf, off = T.text_buffer(pa.array(["ab", None, "", "é"]).slice(1))
    assert bytes(buf) == "é".encode() and off.tolist() == [0, 0, 0, 2]
    assert T.merge_spans(np.array([5, 1, 2]), np.array([7, 3, 5])) == [(1, 7)]
