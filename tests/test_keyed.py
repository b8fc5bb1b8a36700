"""SCD-2 by keyed state against applying all changes at once."""

import datetime as dt
import random

from tributary.operators import scd2 as C
from tributary.streaming import keyed as K

MS0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 1000)
T0 = dt.datetime(2024, 1, 1)
CHANGE = "op string, ts_ms long, before struct<user_id:string,name:string,email:string>, " \
         "after struct<user_id:string,name:string,email:string>, seq long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def changes(spark, rows):
    """(op, minute, user, seq)"""
    return spark.createDataFrame(
        [(op, MS0 + 60_000 * m, (u, None, None), None if op == "d" else (u, f"n{s}", f"{s}@x"), s)
         for op, m, u, s in rows], CHANGE)


def run(spark, root, batch):
    batch.coalesce(1).write.mode("append").parquet(f"{root}/src")
    K.start_versions(spark.readStream.schema(batch.schema).parquet(f"{root}/src"), f"{root}/log", f"{root}/chk",
                     trigger={"availableNow": True}).awaitTermination()


def rows(df):
    return sorted((tuple(r) for r in df.select(*C.DIM_COLUMNS).collect()), key=str)


def test_ordered_batches_equal_one_application(spark, tmp_path):
    rng = random.Random(2)
    dim = C.initialize_dimension(spark.createDataFrame([(f"u{i}", f"first {i}", "e") for i in range(6)],
                                                       "user_id string, name string, email string"), now=T0)
    feed = [(rng.choice("cuuddr"), 1 + i // 3, rng.choice([f"u{k}" for k in range(9)]), i) for i in range(90)]
    before = spark.conf.get(PROVIDER, None)
    for n in range(3):
        batch = changes(spark, feed[30 * n:30 * n + 30])
        run(spark, str(tmp_path), batch if n else batch.unionByName(K.as_creates(dim)))
    assert rows(K.versions(spark, f"{tmp_path}/log")) == rows(C.scd2_apply(dim, changes(spark, feed)))
    assert K.late_changes(spark, f"{tmp_path}/log").count() == 0
    assert spark.conf.get(PROVIDER, None) == before


def test_late_and_repeated_changes_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    run(spark, root, changes(spark, [("d", 1, "a", 0), ("c", 2, "a", 1), ("u", 9, "a", 2)]))
    run(spark, root, changes(spark, [("u", 5, "a", 3), ("u", 9, "a", 2), ("u", 9, "a", 4), ("c", 1, "b", 5)]))
    got = K.versions(spark, f"{root}/log").orderBy("user_id", "version").collect()
    assert [(r.user_id, r.name, r.version, r.is_current) for r in got] == [
        ("a", "n1", 1, False), ("a", "n2", 2, False), ("a", "n4", 3, True), ("b", "n5", 1, True)]
    late = K.late_changes(spark, f"{root}/log").collect()
    assert sorted((r.name, r.t) for r in late) == [("n2", T0 + dt.timedelta(minutes=9)),
                                                  ("n3", T0 + dt.timedelta(minutes=5))]


def test_one_call_per_bucket_not_per_key(spark, tmp_path):
    """The processor alone: two batches of a bucket's changes, one call each."""
    class Value:
        kept, calls = None, 0

        def get(self):
            return self.kept

        def update(self, value):
            self.kept, self.calls = value, self.calls + 1

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    import pandas as pd
    names = ["user_id", "micros", "seq", "opens", "name", "email"]
    one = K._Versions()
    one.init(Handle())
    batches = [[(f"u{i}", 5, i, True, "n", "e") for i in range(500)],
               [("u3", 5, 3, True, "again", "e"), ("u3", 5, K.NO_SEQ, False, None, None), ("u499", 6, 0, True, "m", "e")]]
    logs = [pd.concat(one.handleInputRows((0,), iter([pd.DataFrame(b, columns=names)]), None)) for b in batches]
    assert one.newest.calls == 2 and len(one.newest.kept[0]) == 500
    assert len(logs[0]) == 500 and set(logs[0].kind) == {K.OPENED}
    assert sorted(zip(logs[1].kind, logs[1].user_id, strict=True)) == [
        (K.CLOSED, "u3"), (K.CLOSED, "u499"), (K.OPENED, "u3"), (K.OPENED, "u499")]


def test_buckets_stay_as_the_stream_began(spark, tmp_path):
    root = str(tmp_path)
    batch = changes(spark, [("c", 1, f"u{i}", i) for i in range(20)])
    batch.coalesce(1).write.parquet(f"{root}/src")
    src = spark.readStream.schema(batch.schema).parquet(f"{root}/src")
    for buckets in (3, 50):
        K.start_versions(src, f"{root}/log", f"{root}/chk", trigger={"availableNow": True},
                         buckets=buckets).awaitTermination()
        changes(spark, [("u", 2, f"u{i}", 20 + i) for i in range(20)]).coalesce(1).write.mode(
            "append").parquet(f"{root}/src")
    assert K.buckets_of(spark, f"{root}/chk") == 3
    got = K.versions(spark, f"{root}/log").collect()
    assert len(got) == 40 and sum(r.is_current for r in got) == 20
