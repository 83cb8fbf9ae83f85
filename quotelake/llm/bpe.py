"""Byte-level BPE: ranked merges folded over the bytes of distinct words.

Texts are split by the tokenizer's pattern in the plan. A task takes the words of
some rows at a time, makes them distinct, folds each distinct word it has not just
seen, and puts the ids in the places of the words. The rank map goes with the
function, as large as the rank file; texts and words are not shuffled, so a task
needs neither the vocabulary of the corpus nor rows of other tasks. Decoding
concatenates the pieces of the ids in the plan.
"""

from __future__ import annotations

import base64
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from quotelake.llm.common import literal_table

SLICE_BYTES = 4 << 20  # of text that a task takes at a time; a longer text is taken alone
KNOWN_WORDS = 1 << 18  # whose ids a task remembers; it forgets all and begins anew


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file in the order of their ids."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: neighbours of lowest rank are merged, leftmost first, until none merge.

    ``end[i]`` is the end of the piece that starts at i, ``merged[i]`` the rank of
    that piece with the next (-1: none). A heap holds ranks with places; an entry
    that ``merged`` no longer agrees with is passed over.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))
    merged = [ranks.get(word[i : i + 2], -1) for i in range(n - 1)] + [-1]
    heap = [rank * n + i for i, rank in enumerate(merged) if rank >= 0]
    heapq.heapify(heap)
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        if merged[i] != rank:
            continue
        middle = end[i]
        end[i] = stop = end[middle]
        before[stop] = i
        merged[middle] = merged[i] = -1
        if stop < n:
            merged[i] = rank = ranks.get(word[i : end[stop]], -1)
            if rank >= 0:
                heapq.heappush(heap, rank * n + i)
        if i:
            left = before[i]
            merged[left] = rank = ranks.get(word[left:stop], -1)
            if rank >= 0:
                heapq.heappush(heap, rank * n + left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encoding and decoding with one rank file and splitting pattern."""

    def __init__(self, pieces: list[bytes], pattern: str):
        self.pattern = "(?U)" + pattern
        self.ranks = {piece: i for i, piece in enumerate(pieces)}
        self.pieces = literal_table([p.hex().upper() for p in pieces], "string")

    def split(self, text: Column) -> Column:
        """The words of a text that are encoded separately."""
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def decode(self, ids: Column) -> Column:
        """The bytes of a list of ids."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i)), ""))


def _slices(sizes: np.ndarray, most: int):
    """Ranges of rows of about ``most`` bytes, at least a row each."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, stop
        start = stop


def _encoder(ranks: dict[bytes, int]):
    """The task's function: the last column, lists of words, becomes lists of ids."""

    def ids_of(words: pa.ListArray, known: dict[bytes, bytes]) -> pa.ListArray:
        coded = words.flatten().cast(pa.binary()).dictionary_encode()
        if len(known) > KNOWN_WORDS:
            known.clear()
        codes = []
        for word in coded.dictionary.to_pylist():
            code = known.get(word)
            if code is None:
                code = known[word] = array("i", fold(word, ranks)).tobytes()
            codes.append(code)
        ids = np.frombuffer(b"".join(codes), dtype=np.int32)
        length = np.fromiter((len(c) >> 2 for c in codes), np.int64, len(codes))
        first = np.cumsum(length) - length
        at = coded.indices.to_numpy(zero_copy_only=False)
        long = length[at]
        ends = np.concatenate([[0], np.cumsum(long)])
        # Each word's run of ids stands in the place of the word.
        taken = np.repeat(first[at] - ends[:-1], long) + np.arange(ends[-1])
        rows = words.offsets.to_numpy() - words.offsets[0].as_py()
        return pa.ListArray.from_arrays(pa.array(ends[rows], pa.int32()), pa.array(ids[taken]))

    def batches(source):
        known: dict[bytes, bytes] = {}
        for batch in source:
            words = batch.column(batch.num_columns - 1)
            bounds = words.offsets.to_numpy()
            flat = words.values.cast(pa.large_binary())
            starts = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset + bounds]
            for start, stop in _slices(np.diff(starts), SLICE_BYTES):
                part = batch.slice(start, stop - start)
                columns = part.columns
                columns[-1] = ids_of(columns[-1], known)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return batches


def encode_texts(docs: DataFrame, codec: Codec) -> DataFrame:
    """All columns of ``docs`` and ``ids``, the token ids of the whole text as array<int>.

    A null or empty text has no ids. Rows stay where they are: repeated rows and
    rows of one doc_id are encoded apart, each with the rows around it. Columns may
    have any names (a column ``ids`` is replaced); an empty table gives no rows.
    """
    kept = [field for field in docs.schema.fields if field.name.lower() != "ids"]
    words = F.coalesce(codec.split(F.col("text")), F.array().cast("array<string>"))
    split = docs.select(*[F.col(f"`{field.name}`") for field in kept], words.alias("ids"))
    schema = StructType(kept).add("ids", ArrayType(IntegerType()))
    return split.mapInArrow(_encoder(codec.ranks), schema)
