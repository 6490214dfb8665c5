import random

import numpy as np
from frames import none_of, odd_docs, prose

from eventsieve.llm import quality


def slow_counts(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in quality.SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(quality.SPACES):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), dup, len(marked)


def test_counts_equal_slow_counts():
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "c ", " ", "\n", "\x0b", "é", "#", "|", "\xa0", "a b c "]) for _ in range(rng.randint(0, 60)))
        assert quality.count_text(text) == slow_counts(text), repr(text)
    assert quality.count_text(None) == quality.count_text("") == (0,) * 5


def junk(seed):
    return "".join(w + random.Random(seed).choice(["###", "$$$", "%%%"]) + " " for w in prose(seed, 80).split())


def test_forest_finds_planted_junk_and_keeps_clean_rows(spark):
    more = [(100 + i, prose(i, 100 + i), "en", "a", 1) for i in range(200)] + [(900 + i, junk(i), "en", "a", 1) for i in range(20)]
    docs = odd_docs(spark, more)
    labels = spark.createDataFrame(
        [(100 + i, 1, 0) for i in range(100)] + [(900, 0, 0), (None, 1, None), (101, None, 0)], "doc_id long, quality int, toxic int")
    stats = quality.rule_stats(docs)
    rules = quality.fit(stats, labels)
    got = {(r["doc_id"], r["kept"]) for r in quality.judge(stats, rules).collect()}
    assert {(100 + i, True) for i in range(200)} <= got and {(900 + i, False) for i in range(20)} <= got
    assert {(3, False), (2, False), (None, False), (None, True), (7, False)} <= got
    kept = quality.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality.keep_good(docs, rules).count() == quality.judge(stats, rules).filter("kept").count()
    again = quality.fit(stats, labels)
    for name, forest in rules.forests.items():
        assert again.forests[name].threshold == forest.threshold and (again.forests[name].split == forest.split).all()


def test_labels_set_thresholds_and_never_scores(spark):
    texts = [(100 + i, prose(i, 100 + i), "en", "a", 1) for i in range(60)] + [(900 + i, junk(i), "en", "a", 1) for i in range(9)]
    stats = quality.rule_stats(spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long"))
    seen = []
    for swap in (False, True):
        labels = [(100 + i, int(not swap), 0) for i in range(60)] + [(900 + i, int(swap), 0) for i in range(9)]
        labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        rows = quality.judge(stats, quality.fit(stats, labels)).collect()
        seen.append({r["doc_id"]: (r["score"], r["kept"]) for r in rows})
    assert all(seen[0][k][0] == seen[1][k][0] for k in seen[0])
    assert any(seen[0][k][1] != seen[1][k][1] for k in seen[0])


def test_scores_equal_slow_paths():
    """Every tree walked from its root with the rows that it was grown on."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.exponential(1, 900), rng.integers(0, 4, 900), np.zeros(900)])
    trees, size = 9, 64
    forest = quality.grow(x, trees, size, 3)

    def path(tree, node, rows, row, depth):
        child = forest.child[tree, node]
        if child[0] == node:
            n = len(rows)
            return depth + (0 if n < 2 else 1 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n)
        f, split = forest.feature[tree, node], forest.split[tree, node]
        right = row[f] >= split
        return path(tree, child[int(right)], rows[(rows[:, f] >= split) == right], row, depth + 1)

    norm = 2 * (np.log(size - 1) + 0.5772156649015329) - 2 * (size - 1) / size
    slow = [2 ** (-np.mean([path(t, 0, x[t::trees][:size], row, 0) for t in range(trees)]) / norm) for row in x[:60]]
    assert np.abs(forest.scores(x[:60]) - slow).max() < 1e-12
    good, bad = np.array(slow[:50]), np.array(slow[50:])
    forest.calibrate(good, bad, 0.1)
    allowed = sorted(good)[-6]  # five of fifty may go
    above = [b for b in bad if b > allowed]
    assert forest.threshold == ((allowed + min(above)) / 2 if above else allowed)


def test_without_labels_and_without_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(quality.rule_stats(none_of(spark)), labels) is None
    assert quality.judge(quality.rule_stats(none_of(spark)), None).count() == 0
    stats = quality.rule_stats(odd_docs(spark))
    judged = quality.judge(stats, quality.fit(stats, labels))
    assert judged.filter("kept = base_failed").count() == 0


def test_path_length_of_an_outlier_is_short():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (500, 2)), [[30, 30]]])
    s = quality.grow(x[rng.permutation(len(x))], 50, 128, 1).scores(x)
    assert s.argmax() == 500


def test_junk_below_the_old_steps_goes(spark):
    """Few symbols a word, or a few repeated lines: once the same features as clean text."""
    def symbols(seed):
        return " ".join(w + "#" * (i % 13 == 5) for i, w in enumerate(prose(seed, 120).split()))

    def lines(seed, repeats):
        words = prose(seed, 120).split()
        cut = [" ".join(words[i : i + 10]) for i in range(0, 120, 10)]
        return "\n".join(cut[: 12 - repeats] + cut[:repeats])

    texts = {100 + i: lines(i, 0) for i in range(300)} | {500 + i: symbols(i) for i in range(40)} | {600 + i: lines(700 + i, 2) for i in range(40)}
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    good, bad = range(100, 300), [*range(500, 520), *range(600, 620)]
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 0, 0) for i in bad], "doc_id long, quality int, toxic int")
    stats = quality.rule_stats(docs)
    judged = quality.judge(stats, quality.fit(stats, labels))
    assert judged.filter("base_failed").count() == 0
    kept = {r["doc_id"] for r in judged.filter("kept").collect()}
    assert kept == set(range(100, 400))


def test_every_row_is_in_the_trees_and_every_label_counts(spark):
    """No sample: the roots hold all rows, and thresholds equal those of all labelled rows in memory."""
    n, seen = 26_000, quality.STATS
    stats = spark.range(n).selectExpr(
        "id AS doc_id", "60 + id % 50 AS n_words", "300 + id % 70 AS word_chars", "id % 7 AS n_symbols", "id % 3 AS n_dup_lines", "id % 5 AS n_repeat_words",
        "5 + id % 2 AS n_lines").localCheckpoint()
    counts = {}
    grown = quality.extremes

    def watched(feature, split, child, place, level, trees, each):
        of_rows = grown(feature, split, child, place, level, trees, each)
        if level == 0:
            root = next(of_rows(iter([stats.selectExpr(f"pmod(xxhash64(7, doc_id, {', '.join(seen)}), 100) AS tree", *seen).toPandas()])))
            counts.update(zip(root["id"], root["n"]))
        return of_rows

    quality.extremes = watched
    try:
        labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 40 != 0 AS INT) AS quality", "0 AS toxic")
        rules = quality.fit(stats, labels)
    finally:
        quality.extremes = grown
    assert sum(counts.values()) == n * len(quality.GROUPS)
    rows = stats.join(labels, "doc_id").select("quality", *seen).toPandas()
    fine = rows[(rows.n_words >= 50) & (100 * rows.n_repeat_words <= 50 * rows.n_words)]
    good, bad = (rules.scores(fine[fine.quality == q][seen].to_numpy()) for q in (1, 0))
    assert len(good["all"]) + len(bad["all"]) > 20_000
    for name, forest in rules.forests.items():
        if forest.threshold < float("inf"):
            set_, forest.threshold = forest.threshold, None
            forest.calibrate(good[name], bad[name], quality.MAX_FALSE_REJECTS / len(quality.GROUPS))
            assert forest.threshold == set_


def test_kth_largest_is_exact(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.exponential(1, 3000), "b": rng.integers(0, 3, 3000) / 7, "c": np.full(3000, 0.25)}
    rows = [(name, float(v)) for name, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "name string, score double")
    for k in (0, 17, 2999):
        assert quality.kth_largest(df, k, 16) == {name: float(np.sort(vs)[::-1][k]) for name, vs in values.items()}
