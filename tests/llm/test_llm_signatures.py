"""Ranked search against its SQL, and the bounds against exact scores."""

import random
from collections import Counter

import numpy as np
import pytest
from frames import collected, duck, none_of, odd_docs, prose
from pyspark.sql import functions as F

from eventsieve.llm import oracle, signatures

ITEM = "item_id long, text string, q long, term string, w int"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 0, "clash", 0) for i, t in rows], ITEM)


def corpus(spark, n=150):
    rng = random.Random(9)
    more = [(1000 + i, prose(rng.randint(1, 5), rng.choice([3, 20, 80, 400])), "en", "a", 1) for i in range(n)]
    more += [(2000 + i, prose(1, 60), "en", "a", 1) for i in range(n)]  # many copies: ties
    return odd_docs(spark, more).repartition(4)


ITEMS = [(1, prose(1, 30)), (2, prose(4, 25) + " " + prose(2, 4)), (3, ""), (4, None), (5, "zzz unknown"), (None, "ONE É x x x"), (5, prose(3, 12)), (6, "é 漢字 one")]


@pytest.mark.parametrize("item_terms", [signatures.ITEM_TERMS, 30])
def test_search_matches_sql(spark, monkeypatch, item_terms):
    monkeypatch.setattr(signatures, "ITEM_TERMS", item_terms)  # several blocks of items
    docs, items = corpus(spark), items_of(spark, ITEMS)
    got = signatures.search(docs, items)
    assert collected(got) == duck(oracle.OP13, documents=docs.select("doc_id", "text"), benchmark=items.select("item_id", "text"))
    assert got.groupBy("item_id", "rank").count().filter("item_id <> 5 AND count > 1").isEmpty()


def test_empty_tables(spark):
    items, docs = items_of(spark, ITEMS), corpus(spark, 3)
    none = signatures.search(none_of(spark), items)
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert signatures.search(docs, items.limit(0)).collect() == []
    assert signatures.search(docs.filter("text IS NULL"), items).collect() == []


def test_bounds_are_never_below_the_scores(spark):
    docs = corpus(spark)
    texts = [signatures.terms(r["text"]) for r in docs.collect()]
    texts = [t for t in texts if t]
    n_docs, n_terms = len(texts), sum(map(len, texts))
    df = Counter(w for t in texts for w in set(t))
    index = signatures.build_index(docs, np.arange(signatures.HASH_SLOTS))
    held = {bytes(r["term"]): r["n"] for r in index.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("n")).collect()}
    assert held == df
    names = sorted(df)
    weight = np.array([int(1000 * np.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in names])
    rng = np.random.default_rng(0)
    own = [np.sort(rng.choice(len(names), 40, replace=False)) for _ in range(6)]
    items = signatures.Items(names, list(range(6)), own, [weight[o] for o in own])
    seen, high = 0, 0
    rows = index.filter("rows IS NOT NULL").collect()
    by_size = {}
    for t in texts:
        tf, m = Counter(t), 75 + 25 * len(t) * n_docs // n_terms
        by_size.setdefault(len(t), []).append([sum(int(weight[i]) * (10**9 * tf[names[i]] // (1000 * tf[names[i]] + 12 * m)) for i in o) for o in own])
    for r in rows:
        block = signatures.Block(r["rows"], np.array(r["sizes"]), bytes(r["bits"]), items, n_docs, n_terms)
        bounds = np.array([block.bounds(i) for i in range(6)]).T
        seen += len(bounds)
        high += int(bounds.sum())
        for n, bound in zip(r["sizes"], bounds):  # one of the texts of this length lies below the bound
            assert any(all(x <= b for x, b in zip(s, bound)) for s in by_size[n])
    low = sum(map(sum, (s for same in by_size.values() for s in same)))
    assert seen == len(texts) and low <= high < 1.25 * low


def test_terms():
    assert signatures.terms("Ab-c É_x\x7f9 漢字　\xa0Z") == [b"ab", b"c", "É".encode(), b"x", b"9", "漢字　\xa0".encode() + b"z"]
    assert signatures.terms(None) == signatures.terms(" \n.") == []
