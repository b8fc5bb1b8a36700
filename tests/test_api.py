"""Class-style API: table-backed CDC handler, quality store, router, backfill."""

import datetime as dt
import json

import pytest

from tributary import api
from tributary.fixed import CLICKSTREAM_SCHEMA
from tributary.plans import catalog as CAT

CDC = ("op string, ts_ms bigint, seq bigint, before struct<user_id:string,name:string,"
       "email:string>, after struct<user_id:string,name:string,email:string>")


def test_cdc_handler_snapshots(spark, tmp_path):
    h = api.CDCHandler(spark, str(tmp_path / "user_dim"))
    with pytest.raises(ValueError, match="Dimension table not found"):
        h.apply_cdc_batch(spark.createDataFrame([], CDC))
    users = spark.createDataFrame([("u1", "Alice", "alice@test.com")],
                                  "user_id string, name string, email string")
    h.initialize_dimension_table(users, now=dt.datetime(2024, 1, 1))
    upd = spark.createDataFrame([("u", 1704070000000, 1, ("u1", None, None),
                                  ("u1", "Alice Smith", "alice@test.com"))], CDC)
    h.apply_cdc_batch(upd)
    cur = h.read().filter("is_current").collect()
    assert [(r.name, r.version) for r in cur] == [("Alice Smith", 2)]
    h.apply_cdc_batch(spark.createDataFrame([("d", 1704080000000, 2, ("u1", None, None), None)],
                                            CDC))
    assert h.read().filter("is_current").count() == 0


def test_quality_store_roundtrip(spark, tmp_path):
    store = api.QualityMetricsStore(spark, str(tmp_path / "metrics"))
    assert store.get_quality_history().count() == 0
    df = spark.createDataFrame([("e1", "u1", "t", "v", "s1")],
                               "event_id string, user_id string, timestamp string, "
                               "event_type string, session_id string")
    assert store.log(api.DataQualityChecker().run_checks(df, "bronze")) == 2
    assert store.get_quality_history("bronze_null_check").count() == 1


def test_router_and_silver_gold_facades(spark):
    raw = spark.createDataFrame(
        [(json.dumps({"event_id": "e1", "user_id": "U1", "timestamp": "2024-01-01T00:00:00Z",
                      "event_type": "page_view", "session_id": "s"}),), ("{bad",)],
        "value string")
    ok, dlq = api.EventRouter(CLICKSTREAM_SCHEMA, "clickstream-events").route(raw)
    assert [r.key for r in ok.collect()] == ["U1"] and dlq.count() == 1
    silver = api.process_silver(CAT.bronze(spark, "/root/testdata/sf0.001"))
    assert api.GoldAggregations.conversion_rate(silver).count() > 0
    assert api.SilverTransformations.clean_strings is not None


def test_backfill_manager(spark, tmp_path):
    bf = api.BackfillManager(spark, str(tmp_path / "delta" / "bronze"), partitions=3)
    assert bf.get_starting_offsets() == {"startingOffsets": "earliest"}
    assert "startingOffsetsByTimestamp" in bf.get_starting_offsets(
        timestamp=dt.datetime(2024, 1, 15))
    paths = bf.full_backfill(CAT.click_messages(spark, "/root/testdata/sf0.001"))
    assert paths["gold"].endswith("/backfill/gold")
    assert spark.read.parquet(paths["silver"]).count() > 0


def test_backfill_silver_partitioned_by_date(spark, tmp_path):
    from tributary.plans import backfill as BF
    from tributary.sources.tables import write_overwrite

    bronze = CAT.bronze(spark, "/root/testdata/sf0.001")
    write_overwrite(bronze, str(tmp_path / "bronze"))
    BF.backfill_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"),
                       partition_by_date=True)
    out = spark.read.parquet(str(tmp_path / "silver"))
    assert "event_date" in out.columns
    assert out.count() == api.process_silver(bronze).count()
    day = out.select("event_date").first()[0]
    pruned = out.filter(out.event_date == day)
    assert "PartitionFilters: [isnotnull(event_date" in pruned._jdf.queryExecution() \
        .executedPlan().toString()
