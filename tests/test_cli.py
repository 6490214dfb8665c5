"""The three command-line jobs end to end on the sf0.001 feed: ingest, summary, recover."""

from __future__ import annotations

from conftest import SF001

from eventsieve.plans import cli
from eventsieve.sources import fixtures as fx
from eventsieve.sources.readers import read_raw

LISTS = ["--types", ",".join(fx.FIXTURE_EVENT_TYPES), "--sources", ",".join(fx.FIXTURE_SOURCES)]


def test_cli_jobs(spark, scratch):
    fx.raw_lines(spark, SF001).write.parquet(f"{scratch}/in")
    out = cli.main(["ingest", "--source", "parquet", "--input", f"{scratch}/in", "--raw", f"{scratch}/raw",
                    "--rejects", f"{scratch}/rejects", "--metrics", f"{scratch}/metrics", "--checkpoint",
                    f"{scratch}/ck", "--name", "n1", "--available-now", "--timeout", "600", *LISTS], spark)
    assert (out["total_records"], out["valid_records"], out["rejected_records"]) == (1000, 900, 100)
    gate = cli.main(["summary", "--raw", f"{scratch}/raw", "--curated", f"{scratch}/curated"], spark)
    assert gate["top_items"]["row_count"] == 900 and gate["low_stock_alerts"]["row_count"] == 74
    fx.catalog(spark, SF001).write.option("header", "true").csv(f"{scratch}/catalog")
    more = cli.main(["summary", "--raw", f"{scratch}/raw", "--curated", f"{scratch}/curated", "--rejects",
                     f"{scratch}/rejects", "--catalog", f"{scratch}/catalog"], spark)
    assert more["kpis"]["row_count"] == 1 and more["insights"]["row_count"] == 4 and more["categories"]["schema_ok"]
    rec = cli.main(["recover", "--rejects", f"{scratch}/rejects", "--raw", f"{scratch}/raw", "--ledger",
                    f"{scratch}/ledger", "--run", "r1", "--source-map", '{"external-api": "app"}', *LISTS], spark)
    assert rec["recovered"] == 51
    again = cli.main(["recover", "--rejects", f"{scratch}/rejects", "--raw", f"{scratch}/raw", "--ledger",
                      f"{scratch}/ledger", "--run", "r2", "--source-map", '{"external-api": "app"}', *LISTS], spark)
    assert again["recovered"] == 0
    assert read_raw(spark, f"{scratch}/raw").count() == 951
