"""Small tables with the odd cases that every operator has to take."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("ghijklmnopqrstuv") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_docs(spark, more=()):
    """Nulls in every column, empty, blank and very long texts, repeated rows, a clashing column."""
    rows = [
        (1, prose(1, 120), "en", "a", 1), (1, prose(1, 120), "en", "a", 1), (2, "", "en", "a", 0), (3, None, None, None, None),
        (None, prose(2, 90), "fr", "b", 5), (None, None, None, None, None), (4, " \t\n ", "en", None, 3),
        (5, prose(3, 30_000), "de", "b", 9), (6, prose(1, 120), "en", "c", 1), (7, "one", "en", "c", 3),
        (8, "é ß 漢字 😀\n\nx", "de", "c", 3), *more,
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "key", "kept", "blob", "spans", "target", "taken", "rid", "band", "score", "source_size"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def none_of(spark):
    return spark.createDataFrame([], SCHEMA)


def duck(sql: str, **tables):
    """Rows of a DuckDB query over Spark tables, as sorted tuples by column name."""
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    rel = con.sql(sql)
    names = list(rel.columns)
    order = sorted(names)
    return rows([dict(zip(names, r)) for r in rel.fetchall()], order)


def rows(records, order):
    def norm(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(norm(r[c]) for c in order) for r in records), key=lambda t: [(x is None, str(x)) for x in t])


def collected(df):
    order = sorted(df.columns)
    return rows([r.asDict() for r in df.collect()], order)
