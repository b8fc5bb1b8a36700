"""Quality checks (F7) and dashboard metrics (F8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators import metrics as M
from tributary.operators import quality as Q

NOW = dt.datetime(2024, 2, 1)
BRONZE = "event_id string, user_id string, timestamp string, event_type string, session_id string"


def scores(df):
    return {r.check_name: (r.score, r.passed, r.record_count) for r in df.collect()}


def test_bronze_complete_and_half(spark):
    chk = Q.DataQualityChecker()
    full = spark.createDataFrame([("e1", "u1", "t", "page_view", "s1")], BRONZE)
    s = scores(chk.run_checks(full, "bronze", now=NOW))
    assert s == {"bronze_schema_validation": (1.0, True, 1), "bronze_null_check": (1.0, True, 1)}
    half = spark.createDataFrame([("e1", "u1", "t", "v", "s1"), (None, "u1", "t", "v", "s1")],
                                 BRONZE)
    s = scores(chk.run_checks(half, "bronze", now=NOW))
    assert s["bronze_schema_validation"][0] == 0.5
    assert s["bronze_null_check"][0] == 0.75 and not s["bronze_null_check"][1]


def test_empty_frame_scores_one(spark):
    chk = Q.DataQualityChecker()
    empty = spark.createDataFrame([], BRONZE)
    assert all(v[0] == 1.0 and v[1] for v in scores(chk.run_checks(empty, "bronze")).values())


def test_silver_dedup_and_timestamps(spark):
    chk = Q.DataQualityChecker()
    schema = "event_id string, event_timestamp timestamp"
    uniq = spark.createDataFrame([("e1", NOW), ("e2", NOW)], schema)
    s = scores(chk.run_checks(uniq, "silver", now=NOW))
    assert s["silver_dedup_check"][0] == 1.0 and s["silver_timestamp_validity"][0] == 1.0
    dup = spark.createDataFrame([("e1", NOW), ("e1", NOW + dt.timedelta(days=1))], schema)
    s = scores(chk.run_checks(dup, "silver", now=NOW))
    assert s["silver_dedup_check"][:2] == (0.5, False)
    assert s["silver_timestamp_validity"][0] == 0.5


def test_missing_columns_and_details(spark):
    chk = Q.DataQualityChecker()
    gold = spark.createDataFrame([(1,)], "other int")
    r = chk.run_checks(gold, "gold", now=NOW).first()
    assert r.score == 1.0 and r.details == "Threshold: 1.0"


def test_custom_and_grouped(spark):
    chk = Q.DataQualityChecker(defaults=False)
    chk.register_check(Q.QualityCheck("nulls", "silver", 0.9, kind="null_rate", fields=["x"]))
    chk.register_check(Q.QualityCheck("it's set", "silver", 0.6, check_fn=lambda df: F.avg(
        F.col("x").isNotNull().cast("double"))))
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "g string, x int")
    out = chk.run_checks(df, "silver", now=NOW, by={"grp": F.col("g")}).collect()
    got = {(r.grp, r.check_name): (r.score, r.passed) for r in out}
    assert got == {("a", "nulls"): (0.5, False), ("b", "nulls"): (1.0, True),
                   ("a", "it's set"): (0.5, False), ("b", "it's set"): (1.0, True)}
    chk.register_check(Q.QualityCheck("whole", "silver", 0.5, check_fn=lambda df: 0.25))
    with pytest.raises(ValueError, match="whole"):
        chk.run_checks(df, "silver", now=NOW, by={"grp": F.col("g")})
    whole = {r.check_name: r.score for r in chk.run_checks(df, "silver", now=NOW).collect()}
    assert whole["whole"] == 0.25 and whole["it's set"] == pytest.approx(2 / 3)


def test_failed_checks_are_warned_of(spark, tmp_path, caplog):
    rows = [("c1", "bronze", 1.0, True, 1, "Threshold: 0.99", NOW),
            ("c2", "silver", 0.5, False, 1, "Threshold: 1.0", NOW)]
    with caplog.at_level("WARNING"):
        Q.log_results(spark.createDataFrame(rows, Q.RESULT_SCHEMA), str(tmp_path / "m"))
    assert "c2" in caplog.text and "c1" not in caplog.text


def test_views_read_every_result(spark):
    from tributary.operators import metrics as M

    rows = [(f"c{i}", "silver", 0.0, False, 1, "", NOW) for i in range(1500)]
    m = spark.createDataFrame(rows, Q.RESULT_SCHEMA)
    assert M.failed_checks(m).count() == 1500 and M.latest_quality(m).count() == 1000


def test_history_filter(spark):
    rows = [("c1", "bronze", 1.0, True, 1, "Threshold: 0.99", NOW),
            ("c2", "silver", 0.5, False, 1, "Threshold: 1.0", NOW + dt.timedelta(hours=1))]
    m = spark.createDataFrame(rows, Q.RESULT_SCHEMA)
    assert [r.check_name for r in Q.quality_history(m).collect()] == ["c2", "c1"]
    assert Q.quality_history(m, "c1").count() == 1


def test_overview_values_and_empty(spark):
    epm = spark.createDataFrame([(n,) for n in (10, 20, 30)], "event_count long")
    conv = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), 0.05),
                                  (dt.datetime(2024, 1, 1, 0, 5), 0.10)],
                                 "window_start timestamp, conversion_rate double")
    q = spark.createDataFrame([(0.9, True), (1.0, False)], "score double, passed boolean")
    r = M.overview(epm, conv, q).first()
    assert r.total_events == 60 and r.conversion_rate == pytest.approx(10.0)
    assert r.avg_quality == pytest.approx(95.0) and r.failed_checks == 1
    e = M.overview(epm.limit(0), conv.limit(0), q.limit(0)).first()
    assert (e.total_events, e.conversion_rate, e.avg_quality, e.failed_checks) == (0, 0.0, 0.0, 0)


def test_top_products_ties(spark):
    pop = spark.createDataFrame([("p2", 5.0), ("p1", 5.0), ("p3", None), ("p4", 1.0)],
                                "product_id string, total_revenue double")
    out = [(r.product_id, r.total_revenue) for r in M.top_products(pop, n=3).collect()]
    assert out == [("p1", 5.0), ("p2", 5.0), ("p4", 1.0)]


def test_read_or_empty(spark, tmp_path):
    df = M.load_or_empty(spark, str(tmp_path / "missing"), Q.RESULT_SCHEMA)
    assert df.count() == 0 and df.schema == Q.RESULT_SCHEMA


def test_missing_fail_option(spark):
    chk = Q.DataQualityChecker(missing="fail")
    r = chk.run_checks(spark.createDataFrame([(1,)], "other int"), "gold", now=NOW).first()
    assert r.score == 0.0 and not r.passed


def test_overview_since(spark):
    epm = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), 10) for h in range(3)],
                                "window_start timestamp, event_count long")
    empty_conv = spark.createDataFrame([], "window_start timestamp, conversion_rate double")
    empty_q = spark.createDataFrame([], "score double, passed boolean")
    r = M.overview(epm, empty_conv, empty_q, since=F.lit(dt.datetime(2024, 1, 1, 1))).first()
    assert r.total_events == 20


def test_per_table_gold_checks(spark):
    from tributary.operators import gold as G
    from tributary.plans import catalog as CAT

    chk = Q.DataQualityChecker(per_table_gold=True, missing="fail")
    silver = CAT.silver(spark, "/root/testdata/sf0.001")
    scores = {}
    for table, fn in G.GOLD_TABLES.items():
        for r in chk.run_checks(fn(silver), f"gold.{table}", now=NOW).collect():
            scores[r.check_name] = (r.score, r.passed)
    assert set(scores) == {f"gold_{t}_completeness" for t in Q.GOLD_MEASURES}
    assert all(v == (1.0, True) for v in scores.values())


def test_loaders_are_ordered(spark):
    """The queries are compared as sets, so the order is checked here."""
    from tributary.operators import metrics

    t = [f"2024-01-0{d} 00:00:00" for d in (1, 2, 3)]
    epm = spark.createDataFrame([(t[1], "view"), (t[0], "view"), (t[1], "click"), (t[2], "add")],
                                "window_start string, event_type string").repartition(3)
    assert [tuple(r) for r in metrics.events_by_window(epm).collect()] == [
        (t[0], "view"), (t[1], "click"), (t[1], "view"), (t[2], "add")]
    conv = epm.select("window_start").distinct()
    assert [r[0] for r in metrics.conversions_by_window(conv).collect()] == t
    pop = spark.createDataFrame([("b", 1.0, t[0]), ("a", None, t[0]), ("c", 9.0, t[1]), ("a", 1.0, t[2])],
                                "product_id string, total_revenue double, window_start string").repartition(3)
    assert [r[0] for r in metrics.products_by_revenue(pop).collect()] == ["c", "a", "b", "a"]
    runs = spark.createDataFrame([("x", t[0]), ("y", t[2]), ("x", t[2]), ("x", t[1])],
                                 "check_name string, timestamp string").repartition(3)
    assert [tuple(r) for r in metrics.latest_quality(runs, 3).collect()] == [("x", t[2]), ("y", t[2]), ("x", t[1])]
