"""Best-fit packing: token sequences of a fixed capacity, filled by best-fit decreasing.

Every text becomes its token ids and a final end id. A document longer than the capacity is cut into
pieces of the capacity, of which the first may be shorter; nothing else is cut. Pieces are placed
longest first, each into the open sequence with the least room that still holds it.

Pieces of one length are interchangeable, so the placing needs only how many there are of each
length, at most ``capacity`` numbers. ``plan`` runs best-fit decreasing on these: a segment tree over
the remaining capacities finds the tightest one with an open sequence in logarithmic time, and all
equal steps in a row (the same length into sequences of the same remaining capacity) are taken at
once. Its result, a bounded list of runs, says where the k-th piece of a length goes. Spark numbers
the pieces of each length: the place within its partition is counted while the tokens are written,
and a window over the (length, partition) totals gives each partition its first number. No task sees
all pieces of a length, and no more than the length counts reach the driver.

Defined results: a null or empty text is one piece, the end id alone; texts of any length are encoded
whole; repeated rows are packed as rows; equal lengths are told apart by their place in the written
table; an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import json
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import small_batches, staged

TOKENIZER, CAPACITY, END_ID = "byte_bpe_50k.json", 1024, 2
#: Bits of a piece's number within its length.
RANK_BITS = 42
PIECES = "doc_id long, piece int, start long, length int, ids binary, chunk int, nth long"


class Encoder:
    """A byte-level BPE tokenizer file, run by tiktoken's merging, which is several times faster and
    gives the same ids: both merge the pair of the least id first. Texts that hold the string of a
    special token go to the tokenizers library, which makes it one id."""

    def __init__(self, text: str) -> None:
        self.tokenizer = Tokenizer.from_str(text)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        byte = byte_alphabet()
        ranks = {bytes(byte[c] for c in token): i for token, i in json.loads(text)["model"]["vocab"].items() if token not in special}
        self.merge = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.special is not None and self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.merge.encode_ordinary(text), "<u4").tobytes()


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 characters
    for themselves, those from 256 on for the others in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


_encoders: list[tuple[str, Encoder]] = []


def _encoder(name: str, file: Broadcast) -> Encoder:
    """The tokenizer of this Python worker; one at a time."""
    if not _encoders or _encoders[0][0] != name:
        _encoders[:] = [(name, Encoder(file.value))]
    return _encoders[0][1]


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, tokens, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document, with their ids (little-endian unsigned 32-bit numbers) and, for
    ``place``, the partition that made them (``chunk``) and their number among its pieces of the
    same length (``nth``). Write it before use: both belong to one run of the partition."""
    small_batches(docs.sparkSession)
    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, chunk = _encoder(tokenizer, file), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.encode(text.as_py() or "") + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, piece, start, length, ids[4 * start : 4 * (start + length)], seen[length]))
                    seen[length] += 1
            doc_id, piece, start, length, ids, nth = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                 pa.array(ids, pa.binary()), pa.array([chunk] * len(rows), pa.int32()), pa.array(nth, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids", "chunk", "nth"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class Tightest:
    """Segment tree over remaining capacities 0..top: is there an open sequence in a range of them?"""

    def __init__(self, top: int) -> None:
        self.size = 1 << top.bit_length()
        self.open = [False] * (2 * self.size)

    def mark(self, room: int, is_open: bool) -> None:
        at = room + self.size
        self.open[at] = is_open
        while at := at // 2:
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def at_least(self, room: int) -> int | None:
        """The least remaining capacity from ``room`` on that has an open sequence."""
        at = room + self.size
        if not self.open[at]:
            while at % 2 or not self.open[at + 1]:  # up until an open part lies to the right
                at //= 2
                if at <= 1:
                    return None
            at += 1
            while at < self.size:
                at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces of each length.

    Runs (length, first number, first sequence, pieces a sequence takes, offset): the piece with the
    number ``first + k`` goes to sequence ``first sequence + k // takes`` at
    ``offset + (k % takes) * length``. A sequence that takes a piece and still holds another has the
    least room of all that do, so it is filled with that length before the next one is opened."""
    tree = Tightest(capacity)
    rooms: dict[int, deque[tuple[int, int]]] = {}  # ranges (first, number) of sequences by remaining capacity
    runs, n_sequences = [], 0

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            rooms.setdefault(room, deque()).append((first, number))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        number, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room is None:  # open as many as the rest of this length fills
                room, fresh = capacity, -(-left // (capacity // length))
                first, many = n_sequences, fresh
                n_sequences += fresh
            else:
                first, many = rooms[room].popleft()
                if not rooms[room]:
                    tree.mark(room, False)
            takes = room // length
            full = min(many, left // takes)
            if full:
                runs.append((length, number, first, takes, capacity - room))
                leave(room - takes * length, first, full)
                number, left = number + full * takes, left - full * takes
            if full < many and left:  # fewer are left than the next sequence takes
                runs.append((length, number, first + full, left, capacity - room))
                leave(room - left * length, first + full, 1)
                number, left, full = number + left, 0, full + 1
            if full < many:
                rooms.setdefault(room, deque()).appendleft((first + full, many - full))
                tree.mark(room, True)
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to the written rows of ``token_pieces`` (any of its columns besides
    length, chunk and nth may be left out)."""
    spark = pieces.sparkSession
    totals = staged(pieces.groupBy("length", "chunk").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity``
    runs = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)
    order = np.argsort((runs[:, 0] << RANK_BITS) + runs[:, 1])
    runs = spark.sparkContext.broadcast(runs[order])  # bounded by the capacity, whatever the rows

    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        t, length, number = runs.value, length.to_numpy(np.int64), number.to_numpy(np.int64)
        at = np.searchsorted((t[:, 0] << RANK_BITS) + t[:, 1], (length << RANK_BITS) + number, side="right") - 1
        step = number - t[at, 1]
        return pd.DataFrame({"sequence_id": t[at, 2] + step // t[at, 3], "offset": t[at, 4] + step % t[at, 3] * length})

    rows = pieces.join(firsts, ["length", "chunk"])
    rows = rows.withColumn("_at", placed(F.col("length"), F.col("nth") + F.col("_first")))
    kept = [c for c in pieces.columns if c not in ("chunk", "nth")]
    return rows.select(*kept, F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset"))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    return place(staged(token_pieces(docs, tokenizer, capacity, end_id), "token-pieces"), capacity)
