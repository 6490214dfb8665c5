"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file and composed with each input:

* the normaliser maps characters to characters: a white-space mark in front of the text, and the
  mark for every space;
* the piece machine reads normalised characters and writes piece ids. A character that no piece
  holds goes through its byte pieces;
* the grammar weighs neighbouring pieces. For a model of merges (BPE) a pair of pieces is allowed
  (weight 0) if merging the characters of both gives these two pieces again, and forbidden
  (infinite weight) otherwise. A path of allowed pairs only is the merge result, so the shortest
  path in the tropical semiring (weights add along a path, the least path wins) is exactly the
  encoding of the model. For a unigram model the weight of a piece is its negative score.

No piece of a model trained on split words holds the white-space mark after another character, so
a path can always be cut in front of a mark, and around a line break that no piece holds; shortest
paths are found word by word and remembered in a bounded table.

Defined results: null and empty texts have no pieces; any length is encoded whole; control
pieces' names inside a text are ordinary text; decoding gives the normalised text back (a literal
white-space mark reads back as a space). An empty table gives an empty result; other columns are
left alone. A model with a character map in its normaliser is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Default model (a parameter of every function that needs one).
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
INFINITE = float("inf")
#: Words (the first different ones, common words come early) and pairs of pieces that a task remembers.
WORD_TABLE, PAIR_TABLE = 400_000, 400_000


def read_model(path: str) -> dict:
    """Pieces, scores and normaliser flags of a model file, as plain values."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces:
        raise ValueError("only normalisers that mark spaces and change nothing else are supported")
    kinds = pb.ModelProto.SentencePiece
    return {
        "name": path,
        "merges": m.trainer_spec.model_type == pb.TrainerSpec.BPE,
        "prefix": n.add_dummy_prefix,
        "pieces": {p.piece: (i, p.score) for i, p in enumerate(m.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)},
        "bytes": {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == kinds.BYTE},
        "unknown": next(i for i, p in enumerate(m.pieces) if p.type == kinds.UNKNOWN),
        "surfaces": [p.piece if p.type in (kinds.NORMAL, kinds.USER_DEFINED) else "" for p in m.pieces],
    }


class Transducer:
    """The compiled machines of one model."""

    def __init__(self, model: dict):
        self.merges, self.prefix = model["merges"], model["prefix"]
        self.pieces: dict[str, tuple[int, float]] = model["pieces"]
        self.bytes, self.unknown = model["bytes"], model["unknown"]
        # states of the piece machine: all beginnings of pieces
        self.begins = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        cut = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        line = "" if any("\n" in p for p in self.pieces) else "\n"
        words = rf"{MARK}*[^{MARK}{line}]+|{MARK}+" + (rf"|{line}" if line else "")
        self.chunks = re.compile(words if cut else "(?s).+").findall
        self.worst = min((s for _, s in self.pieces.values()), default=0.0) - 10.0
        self.output = [s.replace(MARK, " ").encode() for s in model["surfaces"]]
        for b, i in self.bytes.items():
            self.output[i] = bytes([b])
        self.output[self.unknown] = " ⁇ ".encode()
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.spines: dict[tuple[str, bool], list[tuple[str, float]] | None] = {}
        if self.merges:  # a piece that merging never gives is on no path
            self.pieces = {p: v for p, v in self.pieces.items() if len(p) == 1 or self.merged(p) == [p]}

    def normalise(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, while a piece results and
        more than ``least`` parts are left."""
        parts = list(text)
        while len(parts) > least:
            best, at = -INFINITE, -1
            for k in range(len(parts) - 1):
                found = self.pieces.get(parts[k] + parts[k + 1])
                if found is not None and found[1] > best:
                    best, at = found[1], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, piece: str, right: bool) -> list[tuple[str, float]] | None:
        """What stands at one edge of a piece while it is merged, last first, each with the score of
        the merge that takes it away. ``None`` if merging the characters doesn't give the piece, or
        if some merge has no better score than the one it leads to."""
        known = self.spines.get((piece, right), 0)
        if known == 0:
            known = self.spines[piece, right] = self._spine(piece, right)
        return known

    def _spine(self, piece: str, right: bool) -> list[tuple[str, float]] | None:
        if len(piece) == 1:
            return [(piece, -INFINITE)]
        parts = self.merged(piece, 2)
        score = self.pieces[piece][1] if piece in self.pieces else INFINITE
        if len(parts) != 2 or any(len(p) > 1 and self.pieces[p][1] <= score for p in parts):
            return None
        halves = [self.spine(p, right) for p in parts]
        if None in halves:
            return None
        return [(piece, -INFINITE), (parts[right], score), *halves[right][1:]]

    def allowed(self, left: str, right: str) -> bool:
        """Grammar of a merge model: do these two pieces stay as they are side by side?

        Merges run from good scores to bad ones. So a merge over the border happens if what stands
        at both edges then forms a piece whose score comes before those that take them away (the
        left one goes first among equals)."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIR_TABLE:
                self.pairs.clear()
            a, b = self.spine(left, True), self.spine(right, False)
            if a is None or b is None:
                known = self.merged(left + right) == [left, right]
            else:
                known = True
                for x, x_goes in a:
                    for y, y_goes in b:
                        found = self.pieces.get(x + y)
                        if found is not None and x_goes < found[1] >= y_goes:
                            known = False
                            break
                    if not known:
                        break
            self.pairs[left, right] = known
        return known

    def arcs(self, text: str, start: int) -> Iterator[tuple[str, float]]:
        """Pieces that the piece machine can read from ``start``, with their weights. A single
        character is always readable, if need be by its bytes."""
        one = text[start]
        if one not in self.pieces:
            yield one, 0.0 if self.merges else -self.worst
        end = start + 1
        while end <= len(text) and (piece := text[start:end]) in self.begins:
            found = self.pieces.get(piece)
            if found is not None:
                yield piece, 0.0 if self.merges else -found[1]
            end += 1

    def shortest_path(self, text: str) -> list[str]:
        """Composition with one input word and its shortest path. States are (place, last piece)
        for a merge model and places otherwise; paths of infinite weight are not followed."""
        n = len(text)
        best: list[dict[str, tuple[float, int, str]]] = [{} for _ in range(n + 1)]
        best[0][""] = (0.0, 0, "")
        for at in range(n):
            for last, (cost, _, _) in best[at].items():
                for piece, weight in self.arcs(text, at):
                    if self.merges and last and not self.allowed(last, piece):
                        continue
                    state = piece if self.merges else "*"
                    there = best[at + len(piece)]
                    old = there.get(state)
                    if old is None or cost + weight < old[0]:
                        there[state] = (cost + weight, at, last) if self.merges else (cost + weight, at, piece)
        out, at = [], n
        state = min(best[n], key=lambda s: best[n][s][0])
        while at:
            _, before, note = best[at][state]
            out.append(text[before:at])
            state = note if self.merges else ("*" if before else "")
            at = before
        return out[::-1]

    def finite_path(self, text: str) -> list[str]:
        """Shortest path of a merge model. All arcs of a finite path weigh 0, so the first path that
        reaches the end is the shortest one. Longer pieces are tried first; a place from which the
        end can't be reached is not tried twice (its beginning has one encoding only)."""
        n, pieces, begins, pairs = len(text), self.pieces, self.begins, self.pairs
        dead: set[int] = set()
        path: list[str] = []
        ends = [0]
        todo: list[list[str]] = []
        at, last = 0, ""
        while at < n:
            if len(todo) == len(path):  # a new place: its pieces, longest last
                found = [text[at]]
                end = at + 2
                while end <= n and (piece := text[at:end]) in begins:
                    if piece in pieces:
                        found.append(piece)
                    end += 1
                todo.append(found)
            found = todo[-1]
            while found:
                piece = found.pop()
                end = at + len(piece)
                if end in dead:
                    continue
                if last:
                    good = pairs.get((last, piece))
                    if good or (good is None and self.allowed(last, piece)):
                        break
                else:
                    break
            else:
                dead.add(at)
                todo.pop()
                path.pop()
                ends.pop()
                at, last = ends[-1], path[-1] if path else ""
                continue
            path.append(piece)
            ends.append(end)
            at, last = end, piece
        return path

    def ids(self, pieces: Iterable[str]) -> list[int]:
        out = []
        for p in pieces:
            found = self.pieces.get(p)
            if found is not None:
                out.append(found[0])
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str | None) -> list[int]:
        text = self.normalise(text or "")
        words = self.chunks(text)
        known = self.words
        got = list(map(known.get, words))
        if None in got:
            search = self.finite_path if self.merges else self.shortest_path
            for k, word in enumerate(words):
                if got[k] is None:
                    found = got[k] = known.get(word) or tuple(self.ids(search(word)))
                    if len(known) < WORD_TABLE and len(word) <= 64:
                        known[word] = found
        return list(chain.from_iterable(got))

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_compiled: list[tuple[str, Transducer]] = []


def _machine(shared: Broadcast) -> Transducer:
    """The compiled model of this Python worker; one model at a time."""
    name = shared.value["name"]
    if not _compiled or _compiled[0][0] != name:
        _compiled[:] = [(name, Transducer(shared.value))]
    return _compiled[0][1]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_chars, ids (array), round_trip (decoding the ids
    gives the text back, white-space marks read as spaces)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(shared)
        for batch in batches:
            ids, ends, trip, chars = [], [0], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                got = machine.encode(text)
                trip.append(machine.decode(got) == text.replace(MARK, " "))
                chars.append(len(text))
                ids.append(np.array(got, np.int32))
                ends.append(ends[-1] + len(got))
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(chars, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)), pa.array(trip, pa.bool_())],
                ["doc_id", "n_tokens", "n_chars", "ids", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_chars long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids) back to (doc_id, text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(shared)
        for batch in batches:
            texts = [machine.decode(x.as_py() or ()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
