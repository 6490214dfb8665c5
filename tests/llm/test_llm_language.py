import binascii

from frames import none_of, odd_docs

from eventsieve.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out AND lang IS NOT NULL").collect()
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    sure = [r for r in held if not r["rejected"]]
    assert sum(r["lang"] == r["lang_pred"] for r in sure) >= 0.98 * len(sure) and len(sure) >= 0.9 * len(held)
    for r in held[:20]:
        assert binascii.crc32(str(r["doc_id"]).encode()) % 3 == 1


def test_odd_documents(spark):
    docs = odd_docs(spark, [(60, "123 ### ...", "en", "a", 1)])
    out = {(r["doc_id"], r["lang_pred"]): r for r in language.identify(docs).collect()}
    for key in ((3, "und"), (2, "und"), (4, "und"), (60, "und")):
        assert out[key]["score"] == 0.0 and out[key]["rejected"]
    assert all(k[1] != "und" and 0 < r["score"] <= 1 for k, r in out.items() if k[0] in (5, 6, 7, 8))
    assert language.identify(none_of(spark)).count() == 0
    nothing = language.identify(docs.withColumn("lang", docs["lang"].cast("string")).filter("lang IS NULL"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_same_rows_give_the_same_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = language.fit(docs), language.fit(docs.repartition(5))
    assert (a.weights == b.weights).all() and a.reject_below == b.reject_below
