"""SCD type 2 on the F5 fixture and the ordered multi-change cases."""

import datetime as dt

import pytest

from tributary.operators import scd2 as C
from tributary.operators.ordered import ordered_scan

LOAD = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 2, 1)
CDC = ("op string, ts_ms bigint, seq bigint, "
       "before struct<user_id:string,name:string,email:string>, "
       "after struct<user_id:string,name:string,email:string>")


def dim0(spark):
    users = spark.createDataFrame([("u1", "Alice", "alice@test.com")],
                                  "user_id string, name string, email string")
    return C.initialize_dimension(users, now=LOAD)


def ch(op, uid, name=None, ms=0, seq=0):
    img = (uid, name or f"{uid}-{seq}", f"{uid}@x")
    before = (uid, None, None) if op in ("u", "d") else None
    after = img if op != "d" else None
    return (op, 1704067200000 + ms, seq, before, after)


def apply(spark, changes, **kw):
    df = spark.createDataFrame(changes, CDC) if changes else spark.createDataFrame([], CDC)
    out = C.scd2_apply(dim0(spark), df, now=NOW, **kw).collect()
    return sorted((r.user_id, r.version, r.is_current) for r in out), out


def test_init(spark):
    r = dim0(spark).collect()
    assert len(r) == 1 and r[0].is_current and r[0].version == 1 and r[0].effective_to is None


def test_create(spark):
    rows, _ = apply(spark, [ch("c", "u2", ms=1000)])
    assert rows == [("u1", 1, True), ("u2", 1, True)]


def test_update(spark):
    rows, out = apply(spark, [ch("u", "u1", "Alice Smith", ms=1000)])
    assert rows == [("u1", 1, False), ("u1", 2, True)]
    closed = [r for r in out if not r.is_current][0]
    current = [r for r in out if r.is_current][0]
    assert closed.effective_to is not None and closed.effective_to == current.effective_from
    assert current.name == "Alice Smith"


def test_delete(spark):
    rows, _ = apply(spark, [ch("d", "u1", ms=1000)])
    assert rows == [("u1", 1, False)]


@pytest.mark.parametrize("changes,expected", [
    ([ch("c", "u3", ms=1, seq=1), ch("u", "u3", ms=2, seq=2)],
     [("u1", 1, True), ("u3", 1, False), ("u3", 2, True)]),
    ([ch("u", "u1", ms=1, seq=1), ch("u", "u1", ms=2, seq=2)],
     [("u1", 1, False), ("u1", 2, False), ("u1", 3, True)]),
    ([ch("u", "u1", ms=1, seq=1), ch("d", "u1", ms=2, seq=2)],
     [("u1", 1, False), ("u1", 2, False)]),
    ([ch("d", "u1", ms=1, seq=1), ch("c", "u1", ms=2, seq=2)],
     [("u1", 1, False), ("u1", 2, True)]),
    ([ch("c", "u1", ms=1)], [("u1", 1, False), ("u1", 2, True)]),
    ([ch("u", "u9", ms=1)], [("u1", 1, True), ("u9", 1, True)]),
    ([ch("d", "u9", ms=1)], [("u1", 1, True)]),
    ([], [("u1", 1, True)]),
    ([ch("r", "u1", ms=1)], [("u1", 1, True)]),
])
def test_ordered_cases(spark, changes, expected):
    rows, _ = apply(spark, changes)
    assert rows == expected


def test_batch_time_and_ties_by_seq(spark):
    rows, out = apply(spark, [ch("u", "u1", ms=5, seq=2), ch("u", "u1", "first", ms=5, seq=1)],
                      time_source="batch")
    assert rows == [("u1", 1, False), ("u1", 2, False), ("u1", 3, True)]
    assert [r.name for r in out if r.is_current] == ["u1-2"]


def test_missing_table(spark, tmp_path):
    with pytest.raises(ValueError, match="Dimension table not found"):
        C.apply_changes_to_table(spark, str(tmp_path / "nope"), spark.createDataFrame([], CDC),
                                 str(tmp_path / "out"))


@pytest.mark.parametrize("parts", [16, None])
def test_ordered_scan_matches_window_with_hot_key(spark, parts):
    """One key holds most rows; the range scan must equal a plain window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(
            (F.col("id") % 37).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 5000).alias("t"),
        (F.col("id") % 3 == 0).alias("flag"))
    got = ordered_scan(df, "k", ["t"], F.col("flag"), lead_of="t", count_out="rc",
                       lead_out="nxt", partitions=parts)
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t",
                     F.sum(F.col("flag").cast("int")).over(
                         w.rowsBetween(Window.unboundedPreceding, 0)).alias("rc"),
                     F.lead("t").over(w).alias("nxt"))
    a = sorted(tuple(r) for r in got.select("k", "t", "rc", "nxt").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b
    # the hot key really is spread over several ranges
    spread = (df.repartitionByRange(16, "k", "t").withColumn("p", F.spark_partition_id())
              .filter("k = 'hot'").select("p").distinct().count())
    assert spread > 1


def test_scd2_hot_user_matches_brute_force(spark):
    """A third of all changes belong to one user; the range-spread result must
    equal a plain per-user window over the same feed."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tributary.sources import feeds

    ev = feeds.read_table(spark, "/root/testdata/sf0.01", "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    changes = C.parse_changes(feeds.cdc_messages(ev))
    users = feeds.user_profiles(feeds.read_table(spark, "/root/testdata/sf0.01", "customer"))
    dim0 = C.initialize_dimension(users, now=LOAD)
    got = C.scd2_apply(dim0, changes)

    # brute force: one window per user over (initial row, changes)
    evs = C.change_events(changes)
    touched = evs.select("user_id").distinct()
    init = dim0.join(touched, "user_id", "left_semi").select(
        "user_id", "name", "email", F.lit(True).alias("opens"),
        F.col("effective_from").alias("t"), F.lit(-1).cast("bigint").alias("seq"),
        F.lit(0).alias("grp"))
    rows = init.unionByName(evs.withColumn("grp", F.lit(1)))
    w = Window.partitionBy("user_id").orderBy("t", "grp", "seq")
    scan = rows.select("*", F.lead("t").over(w).alias("nt"),
                       F.sum(F.col("opens").cast("int")).over(
                           w.rowsBetween(Window.unboundedPreceding, 0)).alias("rc"))
    want = scan.filter("opens").select(
        "user_id", "name", "email", F.col("t").alias("effective_from"),
        F.col("nt").alias("effective_to"), F.col("nt").isNull().alias("is_current"),
        F.col("rc").cast("int").alias("version")).unionByName(
        dim0.join(touched, "user_id", "left_anti"))
    a = sorted(tuple(r) for r in got.collect())
    b = sorted(tuple(r) for r in want.collect())
    assert len(a) == len(b) and a == b
    hot = got.filter(F.col("user_id") == "USER-000007").count()
    assert hot > got.count() / 4


def test_late_changes_listed(spark):
    early = ("u", 1704067200000 - 86_400_000, 1, ("u1", None, None), ("u1", "Old", "o@x"))
    fresh = ("u", 1704067200000 + 1000, 2, ("u1", None, None), ("u1", "New", "n@x"))
    df = spark.createDataFrame([early, fresh], CDC)
    late = C.late_changes(dim0(spark), df).collect()
    assert [r.name for r in late] == ["Old"]


def test_late_change_takes_its_place_in_time(spark):
    day = 86_400_000
    img = lambda n: ("u1", n, "x")
    first = spark.createDataFrame([("u", 1704067200000 + 9 * day, 1, ("u1", None, None), img("new"))], CDC)
    late = spark.createDataFrame([("u", 1704067200000 + 2 * day, 2, ("u1", None, None), img("late")),
                                  ("d", 1704067200000 + 5 * day, 3, ("u1", None, None), None)], CDC)
    out = C.scd2_apply(C.scd2_apply(dim0(spark), first), late)
    rows = [(r.name, r.effective_from.day, r.effective_to and r.effective_to.day, r.is_current, r.version)
            for r in out.orderBy("effective_from").collect()]
    assert rows == [("Alice", 1, 3, False, 1), ("late", 3, 6, False, 2), ("new", 10, None, True, 3)]


def test_initial_dimension_keeps_extra_columns(spark):
    users = spark.createDataFrame([("u1", "A", "a@x", "gold"), ("u2", "B", "b@x", "tin")],
                                  "user_id string, name string, email string, tier string")
    dim = C.initialize_dimension(users, now=LOAD)
    out = C.scd2_apply(dim, spark.createDataFrame([ch("u", "u1", "A2", ms=1000)], CDC))
    tiers = {(r.user_id, r.version): r.tier for r in out.collect()}
    assert tiers == {("u1", 1): "gold", ("u1", 2): None, ("u2", 1): "tin"}
