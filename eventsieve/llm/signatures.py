"""Ranked lexical search over bit-sliced Bloom signatures.

Scores are those of a saturating term weight with whole-number arithmetic: a term of weight
w = floor(1000 ln((2N + 2) / (2 df + 1))) that occurs tf times in a document of m adds
w * (10**9 tf div (1000 tf + 12 m)), where m = 75 + (25 n N div L) grows with the document's length n.

The index. A document's signature is a Bloom filter over its terms and, for terms that occur more
often, over (term, level) for every entry of ``LEVELS`` that tf reaches. Documents with about as many
keys share a block; the block's signatures are stored sliced: row j holds bit j of all its documents,
so the documents that may hold a key are the AND of ``HASHES`` rows. Rows answer whether a term is
there too often, never too seldom.

A search. For an item and a block, the slices of its terms' levels are summed, each weighed with what
the step to that level can add at most (tf below the next level, the document's own m). The sum is an
upper bound of the score of every document of the block. The documents with the largest bounds are
scored exactly; the score of the last one that the item needs is a threshold, and every document
whose bound doesn't fall below it is then scored exactly from its text. Nothing else is left out, so
the result is exact whatever the Bloom filters say.

Items are taken in blocks of bounded size against all documents. What reaches the driver is
bounded: an item block's terms with their weights and thresholds, and a bitmap of the terms' hashes.

Defined results: a null text has no terms and is in no ranking; texts of any length are read whole;
every row of the documents is one document, also when ids repeat; ids may be null (last among equal
scores); items without terms have no results, an item id that repeats is ranked once for each of its
rows; empty tables give an empty result. Other columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

TOP = 20
#: Occurrences from which a term has one level more.
LEVELS = (1, 2, 3, 4, 5, 6, 8, 11, 16, 24, 40, 80, 200, 1000)
#: Bloom filter: rows a key sets, least bits a key, bits in a block (rows x documents), blocks read at once.
HASHES, KEY_BITS, BLOCK_BITS, READ_BLOCKS = 4, 12, 1 << 23, 16
#: Documents scored for an item to find its threshold; terms of one item block; hashes the df table tells apart.
SEEDS, ITEM_TERMS, HASH_SLOTS = 40, 200_000, 1 << 22
#: Parts of an item's found rows (a few of each partition) that are ranked apart before the rest is.
MERGE = 16
#: Terms whose hash or number a Python worker keeps.
KNOWN_TERMS = 500_000

_SEPARATE = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_SEPARATE).split() if text else []


class Hashes(dict):
    """Hash of a term, remembered for a bounded number of terms."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= KNOWN_TERMS:
            self.clear()
        got = self[term] = xxhash.xxh64_intdigest(term)
        return got


_hashes = Hashes()


def key_rows(hashes: np.ndarray, levels: np.ndarray, rows: int) -> np.ndarray:
    """The rows [key, HASHES] that the keys (term hash, level) set among ``rows``."""
    with np.errstate(over="ignore"):
        h = (hashes ^ (levels.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(rows)).astype(np.int64)


def signature_rows(keys: int) -> int:
    """Rows of the blocks for documents of so many keys: a power of two times ``KEY_BITS``."""
    return KEY_BITS * max(8, 1 << (keys - 1).bit_length())


class OpenBlock:
    """Documents of one signature size that still wait for their block to fill."""

    def __init__(self, rows: int) -> None:
        self.rows, self.most = rows, max(8, BLOCK_BITS // rows)
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.set: list[np.ndarray] = []

    def add(self, doc_id: int | None, n: int, hashes: np.ndarray, levels: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(n)
        self.set.append(key_rows(hashes, levels, self.rows).ravel().astype(np.int32))

    def sliced(self) -> tuple[int, list[int | None], list[int], bytes]:
        bits = np.zeros((self.rows, len(self.ids)), bool)
        for column, rows in enumerate(self.set):
            bits[rows, column] = True
        return self.rows, self.ids, self.sizes, np.packbits(bits, axis=1).tobytes()


INDEX = "rows int, doc_ids array<long>, sizes array<long>, bits binary, term binary, df long"


def build_index(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """Written index: blocks of signatures (``rows`` set), and for the terms whose hash is in
    ``slots`` the number of documents that hold them, in parts (``term`` set)."""
    small_batches(docs.sparkSession)
    wanted = np.zeros(HASH_SLOTS, bool)
    wanted[slots] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))
    # a term of tf occurrences reaches LEVELS[0..level_of[tf]]
    level_of = np.searchsorted(LEVELS, np.arange(LEVELS[-1] + 1), side="right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, held, blocks = np.unpackbits(shared.value).astype(bool), Counter(), {}

        def batch_of(made: list[tuple], found: Counter) -> pa.RecordBatch:
            rows, ids, sizes, bits = zip(*made) if made else [()] * 4
            n, m = len(made), len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([*rows, *[None] * m], pa.int32()), pa.array([*ids, *[None] * m], pa.list_(pa.int64())),
                 pa.array([*sizes, *[None] * m], pa.list_(pa.int64())), pa.array([*bits, *[None] * m], pa.binary()),
                 pa.array([*[None] * n, *found], pa.binary()), pa.array([*[None] * n, *found.values()], pa.int64())],
                ["rows", "doc_ids", "sizes", "bits", "term", "df"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                tf = Counter(words)
                own = list(tf)
                hashes = np.fromiter(map(_hashes.__getitem__, own), np.uint64, len(own))
                for i in np.flatnonzero(counted[(hashes % np.uint64(HASH_SLOTS)).astype(np.int64)]):
                    held[own[i]] += 1
                reach = level_of[np.minimum(np.fromiter(tf.values(), np.int64, len(own)), LEVELS[-1])]
                key = np.repeat(hashes, reach)
                level = np.arange(len(key)) - np.repeat(np.cumsum(reach) - reach, reach)
                rows = signature_rows(len(key))
                block = blocks.get(rows) or blocks.setdefault(rows, OpenBlock(rows))
                block.add(doc_id, len(words), key, level)
                if len(block.ids) == block.most:
                    yield batch_of([blocks.pop(rows).sliced()], Counter())
            if len(held) > KNOWN_TERMS:
                yield batch_of([], held)
                held = Counter()
        for rows in list(blocks):
            yield batch_of([blocks.pop(rows).sliced()], Counter())
        if held:
            yield batch_of([], held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(rows.mapInArrow(run, INDEX), "signatures")


@dataclass
class Items:
    """A block of items: per item its row number, terms (numbers into ``terms``) and their weights
    (repeats of a term multiply its weight)."""

    terms: list[bytes]
    number: list[int]
    own: list[np.ndarray]
    weight: list[np.ndarray]


def lengths(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of so many terms."""
    if len(sizes) and int(sizes.max()) < 2**62 // (25 * max(n_docs, 1)):
        return 75 + 25 * sizes * n_docs // max(n_terms, 1)
    return np.array([75 + 25 * int(n) * n_docs // max(n_terms, 1) for n in sizes], np.int64)


def part(tf: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    return 10**9 * tf // (1000 * tf + 12 * m)


class Block:
    """A block of the index, open to questions about one item block."""

    def __init__(self, rows: int, sizes: np.ndarray, bits: bytes, items: Items, n_docs: int, n_terms: int) -> None:
        self.n = len(sizes)
        slices = np.frombuffer(bits, np.uint8).reshape(rows, -1)
        hashes = np.fromiter(map(_hashes.__getitem__, items.terms), np.uint64, len(items.terms))
        m, most = lengths(sizes, n_docs, n_terms), int(sizes.max())
        self.items, self.steps, self.present = items, [], []
        before, there = np.zeros(self.n, np.int64), np.arange(len(hashes))
        for level, least in enumerate(LEVELS):
            if least > most or not len(there):
                break
            up_to = min(most, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else most
            # a term at this level adds at most what ``up_to`` occurrences add
            gain = part(np.minimum(up_to, sizes), m)
            self.steps.append(gain - before)
            before = gain
            rows_of = key_rows(hashes[there], np.full(len(there), level), rows)
            held = slices[rows_of[:, 0]]
            for j in range(1, HASHES):
                held = held & slices[rows_of[:, j]]
            if level:  # a level counts only where all lower ones do
                held &= self.present[-1][1][np.searchsorted(self.present[-1][0], there)]
            some = held.any(axis=1)
            there, held = there[some], held[some]
            self.present.append((there, held))

    def bounds(self, item: int) -> np.ndarray:
        """Upper bounds of the item's scores of all documents of the block."""
        own, weight, total = self.items.own[item], self.items.weight[item], np.zeros(self.n, np.int64)
        for step, (there, held) in zip(self.steps, self.present):
            at = np.searchsorted(there, own)
            at[at == len(there)] = 0
            here = there[at] == own if len(there) else np.zeros(len(own), bool)
            if not here.any():
                break
            bits = np.unpackbits(held[at[here]], axis=1, count=self.n)
            # exact in doubles: weights of an item sum to far less than 2**53
            total += step * (weight[here].astype(float) @ bits).astype(np.int64)
        return total


def _order_id(ids: np.ndarray) -> np.ndarray:
    return np.array([2**63 - 1 if i is None else i for i in ids], np.int64)


def _bounded(index: DataFrame, items: Items, n_docs: int, n_terms: int, limits: dict[int, tuple[int, int]] | None) -> DataFrame:
    """Without limits, the ``SEEDS`` documents of the largest bounds of every item and partition
    (q, doc_id, bound). With them, (doc_id, qs): the items whose limit (score, doc_id) the bound of
    a document reaches, by falling score, then rising id."""
    shared = index.sparkSession.sparkContext.broadcast((items, limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, limits = shared.value
        best: dict[int, list[tuple[int, int, int | None]]] = {q: [] for q in items.number} if limits is None else {}
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = np.array(row["doc_ids"], object), np.array(row["sizes"], np.int64)
                order = _order_id(ids)
                block = Block(row["rows"], sizes, row["bits"], items, n_docs, n_terms)
                found: dict[int, list[int]] = {}
                for i, q in enumerate(items.number):
                    bound = block.bounds(i)
                    if limits is None:
                        top = np.lexsort((order, -bound))[:SEEDS]
                        best[q] += [(-int(bound[d]), int(order[d]), ids[d]) for d in top if bound[d] > 0]
                        best[q] = sorted(best[q], key=lambda t: t[:2])[:SEEDS]
                    else:
                        score, last = limits[q]
                        for d in np.flatnonzero((bound > score) | ((bound == score) & (order <= last))):
                            found.setdefault(int(d), []).append(q)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[d] for d in found], pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))], ["doc_id", "qs"])
        if limits is None:
            rows = [(q, doc_id, -bound) for q, top in best.items() for bound, _, doc_id in top]
            q, doc_id, bound = zip(*rows) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(bound, pa.int64())], ["q", "doc_id", "bound"])

    blocks = index.filter("rows IS NOT NULL").select("rows", "doc_ids", "sizes", "bits")
    return blocks.mapInArrow(run, "q long, doc_id long, bound long" if limits is None else "doc_id long, qs array<long>")


def _scored(docs: DataFrame, wanted: DataFrame, items: Items, n_docs: int, n_terms: int) -> DataFrame:
    """Exact scores (q, doc_id, score) of the items ``qs`` for all rows of the documents ``wanted``;
    of every partition only the best ``TOP`` of an item."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        place, number = {q: i for i, q in enumerate(items.number)}, {t: i for i, t in enumerate(items.terms)}
        best: dict[int, list[tuple[int, int, int | None]]] = {}
        for batch in batches:
            for doc_id, text, qs in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("qs").to_pylist()):
                words = terms(text.as_py())
                tf = np.zeros(len(items.terms), np.int64)
                for t, c in Counter(words).items():
                    if (i := number.get(t)) is not None:
                        tf[i] = c
                m = lengths(np.array([len(words)]), n_docs, n_terms)[0]
                order = 2**63 - 1 if doc_id is None else doc_id
                for q in set(qs):
                    i = place[q]
                    score = int((items.weight[i] * part(tf[items.own[i]], m)).sum())
                    if score > 0:
                        best.setdefault(q, []).append((-score, order, doc_id))
            best = {q: sorted(top, key=lambda t: t[:2])[:TOP] for q, top in best.items()}
        rows = [(q, doc_id, -score) for q, top in best.items() for score, _, doc_id in top]
        q, doc_id, score = zip(*rows) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())], ["q", "doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = wanted.select(F.col("doc_id").alias("_id"), "qs")
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "qs")
    return rows.mapInArrow(run, "q long, doc_id long, score long")


def _best(rows: DataFrame, by: str, top: int) -> DataFrame:
    """The ``top`` rows of every item: first of each of ``MERGE`` parts of an item, then of these."""
    for keys in (["q", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE))], ["q"]):
        w = Window.partitionBy(*keys).orderBy(F.desc(by), F.asc_nulls_last("doc_id"))
        rows = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return rows


def item_terms(items: DataFrame) -> DataFrame:
    """(q, item_id, term, times) of written rows of items (q, item_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(q, i, t, c) for q, i, text in zip(*(batch.column(c).to_pylist() for c in ("q", "item_id", "text"))) for t, c in Counter(terms(text)).items()]
            q, i, t, c = zip(*rows) if rows else [()] * 4
            slot = [xxhash.xxh64_intdigest(x) % HASH_SLOTS for x in t]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(t, pa.binary()), pa.array(c, pa.int64()), pa.array(slot, pa.int32())],
                ["q", "item_id", "term", "times", "slot"])

    rows = items.select("q", F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "q long, item_id long, term binary, times long, slot int")


def _item_block(weighed: DataFrame) -> Items:
    rows = weighed.select("q", "term", "times", "w").collect()  # about ITEM_TERMS rows
    names = sorted({r["term"] for r in rows})
    number, by = {t: i for i, t in enumerate(names)}, {}
    for r in rows:
        by.setdefault(r["q"], []).append((number[r["term"]], r["times"] * r["w"]))
    own = {q: sorted(x) for q, x in by.items()}
    return Items([bytes(t) for t in names], sorted(own), [np.array([i for i, _ in own[q]]) for q in sorted(own)],
                 [np.array([w for _, w in own[q]], np.int64) for q in sorted(own)])


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of every item."""
    spark: SparkSession = docs.sparkSession
    items = staged(benchmark.select(F.monotonically_increasing_id().alias("q"), "item_id", "text"), "items")  # fixes the numbers
    words = staged(item_terms(items), "item-terms")
    slots = np.array([r["slot"] for r in words.select("slot").distinct().collect()], np.int64)  # at most HASH_SLOTS
    index = build_index(docs, slots)
    blocks = index.filter("rows IS NOT NULL")
    total = blocks.select(F.size("sizes").cast("long").alias("n"), F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    n_docs, n_terms = (int(x or 0) for x in total.agg(F.sum("n"), F.sum("l")).first())
    out = "q long, doc_id long, score long, rank int"
    if not n_docs or not len(slots):
        results = spark.createDataFrame([], out)
    else:
        df = index.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.coalesce("df", F.lit(0)) + 1))).cast("long").alias("w")
        weighed = staged(words.join(df, "term", "left").select("q", "term", "times", weight), "item-weights")
        parts = -(-weighed.count() // ITEM_TERMS)
        found = []
        for k in range(parts):
            block = _item_block(weighed.filter(F.pmod(F.xxhash64("q"), F.lit(parts)) == k))
            if not block.number:
                continue
            small_batches(spark, READ_BLOCKS)
            seeds = staged(_best(_bounded(index, block, n_docs, n_terms, None), "bound", SEEDS), "seeds")
            small_batches(spark)
            seeds = seeds.groupBy("doc_id").agg(F.collect_set("q").alias("qs"))
            scored = _best(_scored(docs, seeds, block, n_docs, n_terms), "score", top).filter(F.col("rank") == top)
            last = {r["q"]: (r["score"], 2**63 - 1 if r["doc_id"] is None else r["doc_id"]) for r in scored.collect()}  # one row an item
            limits = {q: last.get(q, (1, 2**63 - 1)) for q in block.number}
            small_batches(spark, READ_BLOCKS)
            near = staged(_bounded(index, block, n_docs, n_terms, limits), "candidates")
            small_batches(spark)
            # rows of one id count once, so a list is no longer than the item block
            near = near.select("doc_id", F.explode("qs").alias("q")).distinct().groupBy("doc_id").agg(F.collect_list("q").alias("qs"))
            found.append(staged(_best(_scored(docs, near, block, n_docs, n_terms), "score", top), "ranked"))
        results = found[0]
        for more in found[1:]:
            results = results.union(more)
    results = results.select("q", "doc_id", "score", F.col("rank").cast("int").alias("rank"))
    return results.join(items.select("q", "item_id"), "q").select(F.col("item_id").cast("long").alias("item_id"), "rank", "doc_id", "score")
