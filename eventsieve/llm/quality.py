"""Quality rules: rule counts per document, judged by isolation forests.

A few counts are taken from every whole text. Isolation forests over ratios of these counts (random
splits between the extremes of a node's rows) give short paths to unusual documents: one forest for each
rule and one for all rules together. Every row of the corpus is dealt by hash to at least one tree of
each forest; the trees grow level by level, all at once, from counts and extremes by node that Spark
aggregates, so the driver holds nodes and never rows. Scores come from the path lengths alone. All labelled
rows set each forest's threshold: halfway between the lowest score that would reject at most its part of
``max_false_rejects`` of the labelled good documents and the next score of a bad one. Forests are then
taken by how many labelled bad rows they catch that the ones before did not; one that catches none
rejects nothing. A document goes if it exceeds any threshold.

Defined results: a null text has no words and fails the base rules; texts of any length are
counted whole; repeated rows and ties get equal scores; without labelled good and bad rows only the
base rules reject; an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, staged

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = [*COUNTS, "n_lines"]
STAT_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in STATS])

#: Trees of a forest, and the rows that a tree gets at least, if there are so many. A tree has at most
#: four times as many nodes: the bound on what reaches the driver.
TREES, SUBSAMPLE, MAX_FALSE_REJECTS = 100, 256, 0.005
#: Forests and the columns of ``ratios`` that each of them sees.
GROUPS = {"symbols": [0], "word_length": [1], "lines": [2], "repetition": [3], "all": [0, 1, 2, 3]}


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside a ``window``-word sequence that occurs twice or more."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    key = codes[: n - window + 1]
    for k in range(1, window):
        if key.max() + 1 > (1 << 62) // len(ids):
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(ids) + codes[k : n - window + 1 + k]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    mark = np.zeros(n, bool)
    for k in range(window):
        mark[again + k] = True
    return int(mark.sum())


def count_text(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts of a text in the order of STATS."""
    return *count_text(text), sum(1 for x in (text or "").split("\n") if x.strip(SPACES))


@F.pandas_udf(STAT_TYPE)
def rule_counts(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(x) for x in text], columns=STATS, dtype="int64")


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def ratios(counts: np.ndarray) -> np.ndarray:
    """Symbols a word, characters a word, repeated lines a line and words in repeated windows a
    word; counts in the order of STATS. Ratios don't grow with the length of a text."""
    words, chars, symbols, dup_lines, repeat, lines = np.asarray(counts, float).reshape(-1, len(STATS)).T
    n = np.maximum(words, 1)
    return np.column_stack([symbols / n, chars / n, dup_lines / np.maximum(lines, 1), repeat / n])


def mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Trees as arrays [tree, node]; a leaf points to itself and holds its path length."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: int
    norm: float
    threshold: float = float("inf")

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf of every row, tree by tree."""
        rows = np.arange(len(x))
        for feature, split, child in zip(self.feature, self.split, self.child):
            node = np.zeros(len(x), np.int32)
            for _ in range(self.depth):
                node = child[node, (x[rows, feature[node]] >= split[node]).astype(np.int8)]
            yield node

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for path, node in zip(self.path, self.leaves(x)):
            total += path[node]
        return np.exp2(-total / (len(self.path) * max(self.norm, 1e-9)))

    def calibrate(self, good: np.ndarray, bad: np.ndarray, max_false_rejects: float) -> None:
        """The threshold from the scores of labelled rows in memory; ``calibrated`` does the same with tables."""
        g, b = np.sort(good), bad
        low = g[len(g) - 1 - int(max_false_rejects * len(g))]
        above = b[b > low]
        self.threshold = float((low + above.min()) / 2 if len(above) else low)


def grow(x: np.ndarray, trees: int, subsample: int, seed: int) -> Forest:
    """Isolation trees of rows in memory; tree t takes rows t, t + trees, ... of the already random ``x``.
    ``grow_all`` grows them on tables of any size."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1)
    feature, split = np.zeros((trees, nodes), np.int8), np.zeros((trees, nodes))
    child, path = np.zeros((trees, nodes, 2), np.int32), np.zeros((trees, nodes))
    for t in range(trees):
        rows = x[t::trees][:size] if len(x) >= trees * size else x[rng.choice(len(x), size, replace=False)]
        todo, used = [(0, 0, rows)], 1
        while todo:
            at, d, part = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            free = np.flatnonzero(high > low)
            if d == depth or len(part) <= 1 or not len(free):
                child[t, at], path[t, at] = at, d + mean_path(len(part))
                continue
            f = rng.choice(free)
            s = rng.uniform(low[f], high[f])
            s = s if s > low[f] else high[f]
            right = part[:, f] >= s
            feature[t, at], split[t, at], child[t, at] = f, s, (used, used + 1)
            todo += [(used, d + 1, part[~right]), (used + 1, d + 1, part[right])]
            used += 2
    return Forest(feature, split, child, path, depth, mean_path(size))


@dataclass
class Rules:
    """A forest for every entry of GROUPS."""

    forests: dict[str, Forest]

    def scores(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores by group of counts in the order of STATS."""
        x = ratios(counts)
        return {name: f.scores(x[:, GROUPS[name]]) for name, f in self.forests.items()}

    def keep_needed(self, caught: dict[tuple[bool, ...], int]) -> None:
        """Forests that are not needed to catch the labelled bad rows reject nothing. ``caught`` counts these
        rows by the forests, in the order of GROUPS, that catch them."""
        names, used = list(GROUPS), set()
        gain = lambda k: sum(n for by, n in caught.items() if by[k] and not any(by[j] for j in used))
        while (best := max(range(len(names)), key=gain)) not in used and gain(best):
            used.add(best)
        for k, name in enumerate(names):
            if k not in used:
                self.forests[name].threshold = float("inf")


#: What a level needs to know of a node: its rows and the extremes of the ratios.
LOWS, HIGHS = [f"lo{k}" for k in range(4)], [f"hi{k}" for k in range(4)]
NODE = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())]
                    + [T.StructField(c, T.DoubleType()) for c in LOWS + HIGHS])


def extremes(feature: np.ndarray, split: np.ndarray, child: np.ndarray, place: np.ndarray, level: int, trees: int, each: int):
    """For ``mapInPandas``: NODE rows of the nodes that ``place`` numbers (-1: not asked), one for each a task has rows of.

    The trees of all forests are stacked; row i of a table goes to ``each`` trees of every forest, from its ``tree`` on."""
    nodes, forests = int(place.max()) + 1, len(feature) // trees

    def of_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(nodes, np.int64)
        low, high = np.full((4, nodes), np.inf), np.full((4, nodes), -np.inf)
        for batch in batches:
            x, first = ratios(batch[STATS].to_numpy()), batch["tree"].to_numpy()
            rows = np.arange(len(x))
            for k in range(forests * each):
                tree = k // each * trees + (first + k % each) % trees
                node = np.zeros(len(x), np.int32)
                for _ in range(level):
                    node = child[tree, node, (x[rows, feature[tree, node]] >= split[tree, node]).astype(np.int8)]
                at = place[tree, node]
                asked = at >= 0
                at = at[asked]
                np.add.at(n, at, 1)
                for f in range(4):
                    np.minimum.at(low[f], at, x[asked, f])
                    np.maximum.at(high[f], at, x[asked, f])
        some = np.flatnonzero(n)
        yield pd.DataFrame({"id": some, "n": n[some], **dict(zip(LOWS, low[:, some])), **dict(zip(HIGHS, high[:, some]))})

    return of_rows


def grow_all(stats: DataFrame, trees: int, subsample: int, seed: int) -> Rules | None:
    """A forest for every entry of GROUPS, grown on all rows of ``stats``; ``None`` if there are none.

    A row goes to one tree of each forest, or to so many that trees have ``subsample`` rows. The rows are
    read once a level. Where nodes run out, those with the most rows are split; the others stay leaves
    whose path is that of their rows, as at the last level. Reruns grow the same trees."""
    rows = stats.select(F.pmod(F.xxhash64(F.lit(seed), "doc_id", *STATS), F.lit(trees)).cast("int").alias("tree"), *STATS)
    rows = staged(rows, "fit-rows")
    total = rows.count()
    if not total:
        return None
    each = min(trees, -(-trees * subsample // total))
    size = max(1, total * each // trees)
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    stacked, most = trees * len(GROUPS), 4 * subsample
    seen = np.repeat([np.isin(range(4), columns) for columns in GROUPS.values()], trees, axis=0)  # ratios of a tree
    feature, split = np.zeros((stacked, most), np.int8), np.zeros((stacked, most))
    child, path = np.tile(np.arange(most, dtype=np.int32)[:, None], (stacked, 1, 2)), np.zeros((stacked, most))
    used, rng = np.ones(stacked, int), np.random.default_rng(seed)
    tree, node = np.arange(stacked), np.zeros(stacked, int)  # the nodes of the level
    for level in range(depth + 1):
        wide = used.max()
        place = np.full((stacked, wide), -1, np.int32)
        place[tree, node] = np.arange(len(tree))
        of_rows = extremes(feature[:, :wide], split[:, :wide], child[:, :wide], place, level, trees, each)
        found = rows.mapInPandas(of_rows, NODE).groupBy("id").agg(
            F.sum("n").alias("n"), *[F.min(c).alias(c) for c in LOWS], *[F.max(c).alias(c) for c in HIGHS])
        found = found.toArrow().to_pandas().sort_values("id")  # at most a row for each node of the level
        tree, node, n = tree[found["id"]], node[found["id"]], found["n"].to_numpy()
        low, high = found[LOWS].to_numpy(), found[HIGHS].to_numpy()
        path[tree, node] = level + np.array([mean_path(k) for k in n])
        free = (high > low) & seen[tree]
        order = np.lexsort((node, -n, tree))
        order = order[(n[order] > 1) & free[order].any(axis=1) & (level < depth)]
        rank = np.arange(len(order)) - np.searchsorted(tree[order], tree[order])
        order = order[used[tree[order]] + 2 * rank + 2 <= most]
        if not len(order):
            break
        tree, node, low, high, free = tree[order], node[order], low[order], high[order], free[order]
        f = np.where(free, rng.random(free.shape), -1).argmax(axis=1)
        a, b = low[np.arange(len(f)), f], high[np.arange(len(f)), f]
        s = rng.uniform(a, b)
        rank = np.arange(len(tree)) - np.searchsorted(tree, tree)
        left = used[tree] + 2 * rank
        feature[tree, node], split[tree, node] = f, np.where(s > a, s, b)
        child[tree, node] = np.column_stack([left, left + 1])
        used += 2 * np.bincount(tree, minlength=stacked)
        tree, node = np.concatenate([tree, tree]), np.concatenate([left, left + 1])
    forests, wide = {}, used.max()
    for k, (name, columns) in enumerate(GROUPS.items()):
        mine = slice(k * trees, (k + 1) * trees)
        own = np.searchsorted(columns, feature[mine, :wide]).astype(np.int8)  # leaves may name a ratio the forest lacks
        own = np.minimum(own, len(columns) - 1).astype(np.int8)
        forests[name] = Forest(own, split[mine, :wide], child[mine, :wide], path[mine, :wide], depth, mean_path(size))
    return Rules(forests)


def kth_largest(scores: DataFrame, k: int, bins: int = 1024) -> dict[str, float]:
    """The exact k-th largest ``score`` (from 0) by ``name``: counts of bins between two bounds, which
    close in on it until one value is left."""
    span = {r["name"]: (r["lo"], r["hi"], k) for r in scores.groupBy("name").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).collect()}
    while some := [name for name, (lo, hi, _) in span.items() if lo < hi]:
        lo, hi = (F.create_map(*chain.from_iterable((F.lit(n), F.lit(span[n][j])) for n in some))[F.col("name")] for j in (0, 1))
        part = scores.filter(F.col("name").isin(some)).filter((F.col("score") >= lo) & (F.col("score") <= hi))
        place = F.least(F.floor((F.col("score") - lo) / (hi - lo) * bins), F.lit(bins - 1)).alias("place")
        found = part.groupBy("name", place).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).collect()
        for name in some:
            rank = span[name][2]
            for r in sorted((r for r in found if r["name"] == name), key=lambda r: -r["place"]):
                if rank < r["n"]:
                    span[name] = (r["lo"], r["hi"], rank)
                    break
                rank -= r["n"]
    return {name: lo for name, (lo, _, _) in span.items()}


def calibrated(rules: Rules, scored: DataFrame, max_false_rejects: float) -> Rules:
    """``rules`` with thresholds from all labelled rows: ``quality`` and a score for each of GROUPS."""
    good, bad = scored.filter("quality = 1"), scored.filter("quality = 0")
    n_good = good.count()
    if not n_good:
        return rules
    long = F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("score")) for n in GROUPS]))
    low = kth_largest(good.select(long), int(max_false_rejects * n_good))
    above = bad.agg(*[F.min(F.when(F.col(n) > low[n], F.col(n))).alias(n) for n in GROUPS]).first()
    for name, forest in rules.forests.items():
        forest.threshold = float(low[name] if above[name] is None else (low[name] + above[name]) / 2)
    flags = [(F.col(n) > rules.forests[n].threshold).alias(n) for n in GROUPS]
    rules.keep_needed({tuple(r[n] for n in GROUPS): r["count"] for r in bad.select(*flags).groupBy(*GROUPS).count().collect()})
    return rules


def fit(stats: DataFrame, labels: DataFrame, *, trees: int = TREES, subsample: int = SUBSAMPLE,
        max_false_rejects: float = MAX_FALSE_REJECTS, seed: int = 7) -> Rules | None:
    """Grow the forests on all rows, and calibrate them on all labelled documents. ``None`` if there are no rows."""
    rules = grow_all(stats, trees, subsample, seed)
    if rules is None:
        return None
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = (
        stats.join(known, "doc_id")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct(*STATS)).alias("c"))
        .filter(~base_failed(F.col("c.n_words"), F.col("c.n_repeat_words")))
    )

    @F.pandas_udf(", ".join(f"{n} double" for n in GROUPS))
    def scores(c: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(rules.scores(c[STATS].to_numpy()))

    scored = staged(labelled.select("quality", scores("c").alias("s")).select("quality", "s.*"), "label-scores")
    return calibrated(rules, scored, max_false_rejects / len(GROUPS))


VERDICT = "score double, exceeded string"


def verdict(rules: Rules | None, counts: Column) -> Column:
    """(score, exceeded) of a struct of STATS: the score (0 to 1) over all rules, and the names of the
    forests whose threshold is exceeded, comma-joined."""
    if rules is None:
        return F.struct(F.lit(0.0).alias("score"), F.lit("").alias("exceeded"))

    @F.pandas_udf(VERDICT)
    def judged(c: pd.DataFrame) -> pd.DataFrame:
        scores = rules.scores(c[STATS].to_numpy())
        over = {name: s > rules.forests[name].threshold for name, s in scores.items()}
        names = [",".join(n for n in over if over[n][i]) for i in range(len(c))]
        return pd.DataFrame({"score": scores["all"], "exceeded": names})

    return judged(counts)


def rule_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the rule counts of every whole text."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", rule_counts("text").alias("_c")).select("doc_id", "_c.*")


def judge(stats: DataFrame, rules: Rules | None) -> DataFrame:
    """Adds base_failed, score, exceeded and kept to rows of ``rule_stats``."""
    return (
        stats.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .withColumn("_v", verdict(rules, F.struct(*STATS)))
        .select("*", F.col("_v.score").alias("score"), F.col("_v.exceeded").alias("exceeded")).drop("_v")
        .withColumn("kept", ~F.col("base_failed") & (F.col("exceeded") == ""))
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that neither the base rules nor the forests reject.

    Texts are counted once: the counts are written beside the rows and judged from there."""
    small_batches(docs.sparkSession)
    counted = staged(docs.withColumn("_rule_counts", rule_counts("text")), "counted")
    rules = fit(counted.select("doc_id", "_rule_counts.*"), labels)
    c = F.col("_rule_counts")
    bad = base_failed(c["n_words"], c["n_repeat_words"]) | (verdict(rules, c)["exceeded"] != "")
    return counted.filter(~bad).select(*docs.columns)


def keep_good(docs: DataFrame, rules: Rules | None) -> DataFrame:
    """The rows of ``docs`` (all columns) that the base rules and given forests keep."""
    counted = docs.withColumn("_rule_counts", rule_counts("text"))
    c = F.col("_rule_counts")
    return counted.filter(~(base_failed(c["n_words"], c["n_repeat_words"]) | (verdict(rules, c)["exceeded"] != ""))).select(*docs.columns)
