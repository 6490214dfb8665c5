"""N-gram Jaccard join with Bayesian candidate pruning.

Links join different texts whose sets of five-word shingles have a Jaccard similarity of at least
``threshold``. Steps:

1. Documents of identical text form one class; only one text per class goes on.
2. MinHash values are cut into bands; texts that share a band are candidates. Within a band's
   group, MinHash values are compared a few at a time, and a pair is dropped as soon as the
   posterior probability that it reaches the threshold falls below ``tolerance``.
3. The pairs left form candidate groups (connected components). In each group every pair is
   verified exactly on the shingle sets, so the verification also sees pairs that no band joined.
4. Verified links are counted per text; their components are the near-duplicate classes.

No step emits the pairs of a group: tasks count links and emit the edges of a spanning forest.
Groups of any size are dealt to pairs of bounded blocks.

Recall: a pair at the threshold 0.8 shares one of 24 bands of 4 values with probability
1 - 3e-6, and pruning drops it with probability below about 1e-5; both fall fast above 0.8.

Defined results: words are separated by ASCII white space; a text of fewer than five words has one
shingle of all its words; texts without words and null texts have no links; texts of any length
are used whole; copies (null texts too) share a class and their links; repeated rows are kept as
rows; an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, in_blocks, small_batches, sorted_groups, staged

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-5
BANDS, ROWS, STEP = 24, 4, 16
HASHES = BANDS * ROWS
#: Members per block while pruning and while verifying.
PRUNE_BLOCK, VERIFY_BLOCK = 512, 128

_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, cache: dict[bytes, int], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of all ``size``-word sequences, in order and with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    codes = []
    for w in words:
        c = cache.get(w)
        if c is None:
            if len(cache) > 200_000:
                cache.clear()
            c = cache[w] = xxhash.xxh64_intdigest(w)
        codes.append(c)
    codes = np.array(codes, np.uint64)
    size = min(size, len(codes))
    out = np.full(len(codes) - size + 1, size, np.uint64)
    for k in range(size):
        out += codes[k : len(codes) - size + 1 + k] * _PLACE[k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def minhash(x: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, 2**64 - 1, np.uint64)
    for a in range(0, len(x), 2048):
        best = np.minimum(best, (x[a : a + 2048, None] * _MULTIPLY + _ADD).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32)


def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, key, text) to (doc_id, key, signature, bands); both null without words."""
    cache: dict[bytes, int] = {}
    place = _PLACE[:ROWS]
    for batch in batches:
        marks, bands = [], []
        for text in batch["text"]:
            x = shingles(text, cache)
            if not len(x):
                marks.append(None)
                bands.append(None)
                continue
            m = minhash(x)
            b = (m.reshape(BANDS, ROWS).astype(np.uint64) * place).sum(axis=1, dtype=np.uint64)
            b = (b ^ (b >> np.uint64(32))) * _PLACE[8 : 8 + BANDS] + np.arange(BANDS, dtype=np.uint64)
            marks.append(m.tobytes())
            bands.append(b.view(np.int64))
        yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "signature": marks, "bands": bands})


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After each step, the matches below which the posterior of reaching ``threshold`` is under
    ``tolerance``. With a uniform prior, m matches of n leave P(s >= t) = P(Bin(n + 1, t) <= m)."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        m, p = 0, 0.0
        while True:
            p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def prune(signatures: np.ndarray, least: list[int]) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the pairs that no step drops."""
    n = len(signatures)
    label = np.arange(n)
    edges = []
    for i in range(n - 1):
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        matches = np.zeros(len(rest), np.int32)
        for k, need in enumerate(least):
            if not len(rest):
                break
            part = slice(k * STEP, (k + 1) * STEP)
            matches += (signatures[rest, part] == signatures[i, part]).sum(axis=1, dtype=np.int32)
            alive = matches >= need
            rest, matches = rest[alive], matches[alive]
        for j in rest:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                edges.append((i, int(j)))
    return edges


def pruned_edges(least: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in sorted_groups(batches, ["band", "_bi", "_bj"]):
            if len(group) < 2:
                continue
            keys = group["key"].to_numpy()
            found = prune(np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(len(group), HASHES), least)
            if found:
                a, b = zip(*found)
                yield pd.DataFrame({"a": keys[list(a)], "b": keys[list(b)]})

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; columns of the membership matrix go in bounded chunks."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    codes, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner, place = owner[shared], place[shared]
    place = np.unique(place, return_inverse=True)[1]
    out = np.zeros((n, n), np.int64)
    width = 8192
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [start, start + width])
        m = np.zeros((n, min(width, int(place[-1]) + 1 - start)), np.float32)
        m[owner[a:b], place[a:b] - start] = 1
        out += (m @ m.T).astype(np.int64)
    return out


def verified(threshold: float):
    """One row per member with links in its block pair: key, links, other (its least linked root)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[bytes, int] = {}
        for group in sorted_groups(batches, ["group", "_bi", "_bj"]):
            group = group.drop_duplicates("key").sort_values("key", ignore_index=True)
            if len(group) < 2:
                continue
            sets = [np.unique(shingles(t, cache)) for t in group["text"]]
            own = group["_own"].to_numpy()
            size = np.array([len(s) for s in sets])
            if len(sets) == 2:
                common = np.intersect1d(sets[0], sets[1], assume_unique=True).size
                inter = np.array([[size[0], common], [common, size[1]]])
            else:
                inter = overlaps(sets)
            linked = inter * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-9
            np.fill_diagonal(linked, False)
            if group["_bi"].iloc[0] != group["_bj"].iloc[0]:  # pairs within a block count in its own group
                linked &= own[:, None] != own[None, :]
            links = linked.sum(axis=1)
            label = np.arange(len(sets))
            while True:
                new = np.minimum(label, np.where(linked, label[None, :], len(sets)).min(axis=1, initial=len(sets)))
                if (new == label).all():
                    break
                label = new
            some = np.flatnonzero(links)
            if len(some):
                keys = group["key"].to_numpy()
                yield pd.DataFrame({"key": keys[some], "links": links[some], "other": keys[label[some]]})

    return run


def text_key(text: Column) -> Column:
    """Content address of a text; null for null."""
    return F.unhex(F.md5(text))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), n_links (different texts
    that reach the threshold), n_copies (rows with the identical text), and key, class_key (contents)."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    signed = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(  # text keeps null ids apart from numbers
        signatures, "doc_id string, key binary, signature binary, bands array<long>")
    signed = staged(signed.withColumn("doc_id", F.col("doc_id").cast("long")), "join-signatures")
    texts = signed.groupBy("key").agg(F.min("doc_id").alias("holder"), F.count("*").alias("n_copies"),
                                      F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    texts = staged(texts, "join-texts")

    banded = texts.filter("signature IS NOT NULL").select("key", F.explode("bands").alias("band"))
    shared = staged(banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "join-bands")
    members = banded.join(shared, "band").join(texts.select("key", "signature"), "key")
    members = in_blocks(members, "n", "key", PRUNE_BLOCK).select("band", "_bi", "_bj", "key", "signature")
    members = members.repartition("band", "_bi", "_bj").sortWithinPartitions("band", "_bi", "_bj")
    left = members.mapInPandas(pruned_edges(least_matches(threshold, tolerance)), "a binary, b binary")
    groups = staged(components(left.distinct(), "join-candidates"), "join-groups")

    sizes = staged(groups.groupBy("root").agg(F.count("*").alias("n")), "join-sizes")
    groups = groups.join(sizes, "root").join(texts.select("key", "holder"), "key")
    groups = groups.select(F.col("key").alias("_k"), F.col("root").alias("group"), "n", "holder").hint("shuffle_hash")
    held = rows.join(groups, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("holder")))
    held = in_blocks(held, "n", "key", VERIFY_BLOCK).select("group", "_bi", "_bj", "_own", "key", "text")
    held = held.repartition("group", "_bi", "_bj").sortWithinPartitions("group", "_bi", "_bj")
    links = staged(held.mapInPandas(verified(threshold), "key binary, links long, other binary"), "join-links")

    counts = links.groupBy("key").agg(F.sum("links").alias("n_links"))
    classes = components(links.select(F.col("key").alias("a"), F.col("other").alias("b")), "join-classes")
    per = texts.select("key", "holder", "n_copies").join(counts, "key", "left").join(classes, "key", "left")
    per = staged(per.withColumn("root", F.coalesce("root", "key")), "join-per-text")
    # the class is named by its least document: least doc_id, then least content
    first = staged(per.groupBy("root").agg(F.min(F.struct(F.col("holder").isNull(), "holder", "key")).alias("m")), "join-first")
    per = per.join(first, per["root"].eqNullSafe(first["root"])).select(
        F.col("key").alias("_k"), F.col("m.holder").alias("class_id"), F.col("m.key").alias("class_key"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")
    per = staged(per, "join-result")
    docs = signed.select("doc_id", "key")
    return docs.join(per, docs["key"].eqNullSafe(per["_k"])).select(
        "doc_id", "class_id", "n_links", "n_copies", "key", "class_key")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row of ``docs`` (all columns) per class: the one with the least doc_id, then content."""
    found = near_duplicates(docs, threshold, tolerance)
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("key").eqNullSafe(F.col("class_key")))
    first = first.groupBy("doc_id", "key").agg(F.count("*").alias("_n"))
    first = staged(first.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "_n"), "join-keep")
    rows = docs.withColumn("_key", text_key(F.col("text")))
    rows = rows.join(first.hint("shuffle_hash"), F.col("_key").eqNullSafe(F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    once = rows.filter("_n = 1").select(*docs.columns)
    again = rows.filter("_n > 1").dropDuplicates(["doc_id", "_key"]).select(*docs.columns)
    return once.unionByName(again)
