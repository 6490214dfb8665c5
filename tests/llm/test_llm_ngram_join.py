import random
from itertools import combinations

from frames import none_of, odd_docs, prose

from eventsieve.llm import ngram_join


def sets(text):
    w = (text or "").encode().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def slow(docs):
    """doc_id -> (class_id, links) by comparing all pairs of different texts."""
    texts = {}
    for i, t in docs:
        texts.setdefault(t, []).append(i)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    root, links = {t: t for t in texts}, dict.fromkeys(texts, 0)

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    shingled = {t: sets(t) for t in texts}
    for a, b in combinations(texts, 2):
        x, y = shingled[a], shingled[b]
        if x and y and 10 * len(x & y) >= 8 * len(x | y):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    groups = {}
    for t, ids in texts.items():
        groups.setdefault(find(t), []).extend(ids)
    return {(i, least(groups[find(t)]), links[t], len(ids)) for t, ids in texts.items() for i in ids}


def near(seed, n, changes):
    rng = random.Random(1000 + seed)
    w = prose(77, n).split()
    for _ in range(changes):
        w[rng.randrange(n)] = f"new{seed}x{rng.randrange(9)}"
    return " ".join(w)


def planted():
    """One large group of near copies at all distances, a passage that many share, short texts."""
    rng = random.Random(5)
    out = [(1000 + i, near(i, 100, i % 5), "en", "a", 1) for i in range(320)]
    passage = prose(50, 60)
    out += [(3000 + i, passage + " " + prose(500 + i, rng.randint(3, 60)), "en", "a", 1) for i in range(60)]
    out += [(4000 + i, "a b c" if i % 2 else "a  b c", "en", "a", 1) for i in range(6)]
    base = prose(9, 200).split()
    return out + [(5000 + i, " ".join(base[i * 4 :]), "en", "a", 1) for i in range(30)]


def test_links_and_classes_equal_all_pairs(spark):
    docs = odd_docs(spark, planted())
    got = ngram_join.near_duplicates(docs).collect()
    want = slow([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert {(r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in got} == want
    assert len(got) == docs.count()


def test_one_row_of_each_class_stays(spark):
    docs = odd_docs(spark, planted())
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for _, c, _, _ in slow([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])}
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert set(ids) == want and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})


def test_empty_table(spark):
    assert ngram_join.near_duplicates(none_of(spark)).count() == 0
    assert ngram_join.keep_one(none_of(spark)).count() == 0


def test_pruning_bound():
    least = ngram_join.least_matches(0.8, 1e-5)
    assert least == sorted(least) and least[-1] < 0.8 * ngram_join.HASHES
