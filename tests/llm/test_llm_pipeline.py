"""The stages one by one on the driver's smallest tables, each against a plain reading of its task."""

import corpus_pipeline
import pytest
from conftest import SF001
from frames import none_of, odd_docs, prose
from test_llm_ngram_join import slow

from eventsieve.llm import pieces, quality, secrets
from eventsieve.llm.common import staged, table


def test_stages(spark):
    docs = table(spark, SF001, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF001), "t")
        assert out.columns == docs.columns, name
        kept.append(out)
        docs = out
    good, single, masked, mixed = kept
    base = [quality.count_text(r["text"]) for r in table(spark, SF001, "documents").collect()]
    assert good.count() <= sum(not (c[0] < 50 or 100 * c[4] > 50 * c[0]) for c in base)
    want = {c for _, c, _, _ in slow([(r["doc_id"], r["text"]) for r in good.collect()])}
    ids = [r["doc_id"] for r in single.collect()]
    assert sorted(ids) == sorted(want)
    assert sorted(r["doc_id"] for r in masked.collect()) == sorted(ids)
    left = masked.select(secrets.scan(masked["text"]).alias("s")).filter("size(s) > 0").count()
    assert left == 0
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= set(ids) and set(times.values()) <= {1, 2}
    last = corpus_pipeline.STAGES[-1][1](spark, mixed, SF001)
    machine = pieces.Transducer(pieces.read_model(pieces.MODEL))
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    for r in last.collect():
        assert r["round_trip"] and list(r["ids"]) == machine.encode(text[r["doc_id"]])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_and_empty_tables(spark, scratch, empty):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns; no rows at all."""
    more = [(100 + i, prose(i, 90), "en", "ab"[i % 2], 1) for i in range(12)] + [(None, prose(3, 90), None, None, None)]
    docs = none_of(spark) if empty else odd_docs(spark, more)
    labels = [] if empty else [(100, 1, 0), (None, 0, 0), (101, None, None), (5, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, scratch), "t")
        assert docs.columns == columns, name
        kept = {r["doc_id"] for r in docs.collect()}
        assert empty or {100, 111} <= kept or name == "source mix", name
        assert not kept & {2, 3, 4, 7, 8}, name  # too short or without a text
    last = corpus_pipeline.STAGES[-1][1](spark, docs, scratch)
    assert last.count() == docs.count() and (empty or last.filter("NOT round_trip").isEmpty())


def test_every_contract_query_is_registered():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in E.queries()
