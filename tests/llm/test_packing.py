"""op8: exact round trip, and the bins."""

import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from certloom.llm import packing


def check(docs, rows, capacity=1024):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for n, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(part))
            assert 0 < r.length <= capacity and (n == 0 or r.length == capacity)
            at += r.length
        assert at == len(ids) and (len(by_doc[i]) == 1 or len(ids) > capacity)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_digest(documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    made, least = check(docs, packing.digest(documents).collect())
    assert made <= 1.03 * least


def test_odd(odd, nothing):
    df = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check([(r.doc_id, r.text) for r in df.collect()], packing.digest(df).collect())
    assert packing.digest(odd).select("doc_id").distinct().count() == 13
    assert packing.digest(nothing).count() == 0


def test_open_bins():
    rng = np.random.default_rng(2)
    bins, used = packing.OpenBins(100, 3), {}
    for length in rng.integers(1, 101, 2000).tolist():
        number, offset = bins.place(length)
        assert offset == used.get(number, 0)
        used[number] = offset + length
        assert used[number] <= 100
        assert sum(len(b) for b in bins.bins) == bins.count <= 3
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n)[0] for n in (6, 7, 8, 4)] == [0, 1, 2, 0]  # bin 1 was the fullest and closed
