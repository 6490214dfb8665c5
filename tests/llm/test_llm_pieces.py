import random

import pytest
import sentencepiece
from frames import none_of, odd_docs

from eventsieve.llm import pieces


@pytest.fixture(scope="module")
def machine():
    return pieces.Transducer(pieces.read_model(pieces.MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


ALPHABET = ["a", "b", "e", "t", " ", "  ", "\n", "é", "ß", "1", "23", "😀", "▁", "the", "ing", "<s>", "<0x41>", "\t", "あ", "漢", "=", "    ", "--", "\x00"]


def test_ids_equal_the_library(machine, library):
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 16)))
        ids = machine.encode(text)
        assert ids == library.encode(text), repr(text)
        assert machine.decode(ids) == text.replace(pieces.MARK, " ")
        if text:
            assert machine.finite_path(machine.normalise(text)) == machine.shortest_path(machine.normalise(text))


def test_unigram_takes_the_best_path():
    model = {"name": "own", "merges": False, "prefix": False, "unknown": 0, "bytes": {}, "surfaces": ["", "a", "b", "ab", "abc", "c"],
             "pieces": {"a": (1, -1.0), "b": (2, -1.0), "ab": (3, -1.5), "abc": (4, -4.0), "c": (5, -1.0)}}
    m = pieces.Transducer(model)
    assert m.encode("abc") == [3, 5] and m.encode("ax") == [1, 0]


def test_documents(spark, machine, library):
    docs = odd_docs(spark)
    out = pieces.encode_documents(docs)
    texts = sorted((r["text"] or "" for r in docs.collect()))
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in out.collect())
    assert sorted(map(list, (r["ids"] for r in out.collect()))) == sorted(library.encode(t) for t in texts)
    assert sorted(r["text"] for r in pieces.decode_documents(out).collect()) == texts
    assert pieces.encode_documents(none_of(spark)).count() == 0
