"""Packing against the plain algorithm, and every piece against the tokenizer."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
from frames import none_of, odd_docs, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventsieve.llm import packing


def best_fit_decreasing(lengths, capacity):
    """One piece at a time, looking at every open sequence; rooms left, in order of opening."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return rooms


def laid_out(counts, capacity):
    """Sequence -> list of (offset, length), from the runs of the plan."""
    runs, out = packing.plan(counts, capacity), {}
    for length, total in counts.items():
        mine = sorted(r for r in runs if r[0] == length)
        for k, (_, first, sequence, takes, offset) in enumerate(mine):
            stop = mine[k + 1][1] if k + 1 < len(mine) else total
            for i in range(stop - first):
                out.setdefault(sequence + i // takes, []).append((offset + i % takes * length, length))
    return out


def test_plan_equals_one_piece_at_a_time():
    rng = random.Random(4)
    for capacity in (1, 2, 7, 64, 100):
        for n in (0, 1, 5, 60, 700):
            for spread in (1, 3, capacity):
                lengths = [min(capacity, rng.randint(1, capacity) // rng.randint(1, spread) + 1) for _ in range(n)]
                out = laid_out(Counter(lengths), capacity)
                got = sorted(capacity - sum(x for _, x in pieces) for pieces in out.values())
                assert got == sorted(best_fit_decreasing(lengths, capacity)), (capacity, n, spread)
                for pieces in out.values():
                    at = 0
                    for offset, length in sorted(pieces):
                        assert offset == at
                        at += length
                    assert at <= capacity


def test_plan_does_not_grow_with_the_counts():
    rng = random.Random(1)
    few = {n: rng.randint(1, 50) for n in range(1, 1025)}
    many = {n: c * 10**7 for n, c in few.items()}
    assert len(packing.plan(many, 1024)) < 6 * 1024 > len(packing.plan(few, 1024))


def test_tightest_room():
    rng = random.Random(2)
    tree, rooms = packing.Tightest(37), set()
    for _ in range(2000):
        room = rng.randint(0, 37)
        is_open = rng.random() < 0.4
        tree.mark(room, is_open)
        (rooms.add if is_open else rooms.discard)(room)
        want = rng.randint(0, 37)
        assert tree.at_least(want) == min((r for r in rooms if r >= want), default=None)


def test_pieces_and_places(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = ["<|endoftext|> as text", "a  b\n\n c\t\td " * 40, " lead", "x" * 5000, "don't 12 's", " 　 é漢"]
    more = [(100 + i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(200 + i, prose(i, 10 + 9 * i), "en", "a", 1) for i in range(60)]
    docs = odd_docs(spark, more).repartition(5)
    got = packing.pack(docs, capacity=256).collect()
    sequences, whole = {}, {}
    for r in got:
        assert 0 < r["length"] <= 256 and len(r["ids"]) == 4 * r["length"]
        assert r["length"] == 256 or r["piece"] == 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        whole.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) == len(best_fit_decreasing([r["length"] for r in got], 256))
    texts = {}
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        texts.setdefault(r["doc_id"], []).append(np.array(ids, "<u4").tobytes())
    for doc_id, rows in texts.items():  # rows of one id: all their pieces together
        want = sorted((s, t[4 * s : 4 * (s + n)]) for t in rows for s, n in packing.cut(len(t) // 4, 256))
        assert sorted(whole[doc_id]) == want
    assert sum(map(len, texts.values())) == docs.count()


def test_hot_length_is_numbered_across_partitions(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text")).repartition(7)
    got = packing.pack(docs, capacity=16)
    n = got.first()["length"]
    assert got.select("sequence_id", "offset").distinct().count() == 3000
    assert got.select("sequence_id").distinct().count() == -(-3000 // (16 // n))


def test_no_rows(spark):
    assert packing.pack(none_of(spark)).collect() == []
