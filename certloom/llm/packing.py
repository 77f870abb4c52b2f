"""Best-fit packing of tokenised documents into fixed-length sequences.

Each task tokenises its rows and packs them as they come, with a fixed number of open bins: an item
goes to the open bin with the least free space that holds it, found in a bitset whose bits are the
free spaces; when there are too many open bins the fullest closes.  Within an Arrow batch the longest
items are offered first, which leaves fewer gaps.  Nothing is shuffled and a task holds only its open
bins' free spaces, so memory does not follow the input; a lost task is packed again the same way,
with the same sequence numbers.

Defined results: null and empty texts are the end token alone; a document of more than ``capacity``
tokens is cut into pieces of ``capacity``, the first taking the remainder; rows that repeat an id are
packed each by itself; an id may be null; other columns are left out; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from . import textops as T

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: byte-level BPE
_OTHER = re.compile(r"[^\x00-ɏ]|<\|")


@lru_cache(maxsize=2)
def _exact(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _fast(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder(tokenizer: str, ranks: str | None):
    """text -> uint32 ids.  With the same vocabulary as ranks, plain Latin text takes the faster
    library; whatever the two might split differently goes to the tokenizer file itself."""
    def encode(text: str) -> np.ndarray:
        if ranks is None or _OTHER.search(text):
            return np.array(_exact(tokenizer).encode(text, add_special_tokens=False).ids, np.uint32)
        return _fast(ranks).encode_to_numpy(text, disallowed_special=())
    return encode


class OpenBins:
    """Online best fit over at most ``limit`` open bins of ``capacity``."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.spaces, self.bins, self.count, self.made = 0, [[] for _ in range(capacity + 1)], 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin number, offset) for an item of 1 to ``capacity``."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.made, self.capacity
            self.made += 1
            if length < free:
                self.count += 1
                if self.count > self.limit:  # the fullest closes
                    self._take((self.spaces & -self.spaces).bit_length() - 1)
                    self.count -= 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.spaces |= 1 << left
        elif free < self.capacity:
            self.count -= 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.spaces &= ~(1 << free)
        return number


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 1024, end_id: int = 2, open_bins: int = 1024) -> DataFrame:
    """One row per piece: (id, piece, start, length, ids binary of little-endian uint32, sequence_id,
    offset)."""
    T.prepare(docs.sparkSession)
    schema = S.StructType([
        S.StructField(id_col, docs.schema[id_col].dataType), S.StructField("piece", S.IntegerType()),
        S.StructField("start", S.LongType()), S.StructField("length", S.LongType()),
        S.StructField("ids", S.BinaryType()), S.StructField("sequence_id", S.LongType()),
        S.StructField("offset", S.LongType())])

    def run(batches):
        encode, bins = encoder(tokenizer, ranks), OpenBins(capacity, open_bins)
        first_id = TaskContext.get().partitionId() << 40
        for b in batches:
            rows = T.Rows(pa.schema([
                pa.field(id_col, b.column(0).type), ("piece", pa.int32()), ("start", pa.int64()),
                ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())]))
            for lo in range(0, b.num_rows, 1024):
                pieces = []
                for key, text in zip(b.column(0).slice(lo, 1024).to_pylist(), b.column(1).slice(lo, 1024), strict=True):
                    ids = encode(text.as_py() or "")
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                    pieces += [(e - s, key, i, s, ids[s:e].tobytes())
                               for i, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
                pieces.sort(key=lambda x: -x[0])  # stable
                for length, key, i, s, raw in pieces:
                    number, offset = bins.place(length)
                    rows.add(len(raw), key, i, s, length, raw, first_id + number, offset)
                    yield from rows.take()
            yield from rows.take(last=True)

    columns = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    return columns.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers as P
    d = pack(docs.select("doc_id", "text"), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    return d.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
