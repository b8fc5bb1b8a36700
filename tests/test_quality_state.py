"""Quality scores merged from states against one pass over all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators.quality import DataQualityChecker, QualityCheck
from tributary.streaming import quality_state as S

T0 = dt.datetime(2024, 1, 1)
PART, BOUND = "CAST(to_date(kafka_timestamp) AS STRING)", "CAST(date_add(to_date(part), 1) AS TIMESTAMP)"
SCHEMA = "event_id string, user_id string, kafka_timestamp timestamp, event_timestamp timestamp"


def checker():
    c = DataQualityChecker(defaults=False)
    for name, kind, fields, threshold in [("req", "required_fields", ["event_id", "user_id", "gone"], 0.9),
                                          ("nulls", "null_rate", ["event_id", "user_id"], 0.95),
                                          ("dup", "duplicates", ["event_id"], 1.0),
                                          ("time", "timestamp_validity", ["event_timestamp"], 0.8)]:
        c.register_check(QualityCheck(name, "silver", threshold, "", kind, fields))
    return c


def rows(rng, n):
    out = []
    for _ in range(n):
        at = T0 + dt.timedelta(hours=rng.randint(0, 95))
        out.append((rng.choice([None, *[f"e{i}" for i in range(n)]]), rng.choice([None, "u", "v"]), at,
                    rng.choice([None, at, at, at + dt.timedelta(days=2)])))
    return out


def whole(df, by_part):
    if by_part:
        out = checker().run_checks(df, "silver", by={"part": F.expr(PART)}, run_time=F.expr(BOUND))
        return sorted((r.part, r.check_name, round(r.score, 9), r.passed, r.record_count, r.details)
                      for r in out.collect())
    # of the layer: every row against the bound of its own day
    days = df.withColumn("part", F.expr(PART)).withColumn("ok", F.col("event_timestamp") <= F.expr(BOUND)).withColumn(
        "event_timestamp", F.when(F.col("ok"), F.col("event_timestamp")))
    out = checker().run_checks(days, "silver", now=dt.datetime(2100, 1, 1))
    return sorted((r.check_name, round(r.score, 9), r.passed, r.record_count, r.details) for r in out.collect())


def merged(spark, root, by_part):
    out = S.scores(spark, root, "silver", checker(), by_part).collect()
    return sorted(((r.part,) if by_part else ()) + (r.check_name, round(r.score, 9), r.passed, r.record_count, r.details)
                  for r in out)


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_batches_equal_one_pass(spark, tmp_path, seed):
    """Days that get rows in several batches; keys that repeat in a batch, in a
    day over batches, and over days."""
    rng, so_far, root = random.Random(seed), None, str(tmp_path)
    for batch in range(3):
        df = spark.createDataFrame(rows(rng, 60), SCHEMA)
        so_far = df if so_far is None else so_far.unionAll(df)
        assert S.add_batch(spark, root, df, "silver", F.expr(PART), batch, F.expr(BOUND), checker())
        assert not S.add_batch(spark, root, df, "silver", F.expr(PART), batch, F.expr(BOUND), checker())    # again: nothing
        for by_part in (True, False):
            assert merged(spark, root, by_part) == whole(so_far, by_part)


def test_a_new_day_reads_no_earlier_rows(spark, tmp_path):
    root = str(tmp_path / "q")
    first = tmp_path / "day1"
    day1 = spark.createDataFrame(rows(random.Random(3), 40), SCHEMA)
    day1.write.parquet(str(first))
    S.add_batch(spark, root, spark.read.parquet(str(first)), "silver", F.expr(PART), 0, F.expr(BOUND), checker())
    for f in first.iterdir():
        f.unlink()                              # the data of the first batch is gone
    day2 = spark.createDataFrame(rows(random.Random(4), 40), SCHEMA)
    S.add_batch(spark, root, day2, "silver", F.expr(PART), 1, F.expr(BOUND), checker())
    assert merged(spark, root, True) == whole(day1.unionAll(day2), True)
    # one small row for each day, check and scope
    assert spark.read.parquet(f"{root}/states").count() <= 2 * 5 * 5


def test_empty_batch_and_checks_without_states(spark, tmp_path):
    root = str(tmp_path)
    assert S.add_batch(spark, root, spark.createDataFrame([], SCHEMA), "silver", F.expr(PART), 0, F.expr(BOUND), checker())
    assert S.scores(spark, root, "silver", checker()).count() == 0
    own = DataQualityChecker(defaults=False)
    own.register_check(QualityCheck("mine", "silver", 1.0, check_fn=lambda df: 1.0))
    assert S.add_batch(spark, root, spark.createDataFrame([], SCHEMA), "silver", F.expr(PART), 1, F.expr(BOUND), own) is False


def test_all_keys_null(spark, tmp_path):
    df = spark.createDataFrame([(None, "u", T0, T0), (None, "u", T0, T0)], SCHEMA)
    S.add_batch(spark, str(tmp_path), df, "silver", F.expr(PART), 0, F.expr(BOUND), checker())
    assert merged(spark, str(tmp_path), True) == whole(df, True)
