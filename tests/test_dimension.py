"""Dimension in buckets: what a batch rewrites, snapshots, repeated batches."""

import datetime as dt

import pytest

from tributary.operators import scd2 as C
from tributary.streaming import dimension as D

T0 = dt.datetime(2024, 1, 1)
MS0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 1000)
CHANGE = "op string, ts_ms long, before struct<user_id:string,name:string,email:string>, " \
         "after struct<user_id:string,name:string,email:string>, seq long"


def users(spark, n=200):
    return spark.createDataFrame([(f"u{i}", f"name {i}", f"{i}@x") for i in range(n)],
                                 "user_id string, name string, email string")


def changes(spark, rows):
    """(op, minute, user, name)"""
    return spark.createDataFrame(
        [(op, MS0 + 60_000 * m, (u, None, None), None if op == "d" else (u, name, f"{name}@x"), i)
         for i, (op, m, u, name) in enumerate(rows)], CHANGE)


def rows(df):
    return sorted(map(tuple, df.select(*C.DIM_COLUMNS).collect()), key=str)


@pytest.fixture
def root(spark, tmp_path):
    D.create_dimension(C.initialize_dimension(users(spark), now=T0), str(tmp_path), 8)
    return str(tmp_path)


def files(spark, root, snapshot=None):
    return set(D.read_dimension(spark, root, snapshot).inputFiles())


def test_one_key_rewrites_one_bucket(spark, root):
    before = files(spark, root)
    m = D.apply_batch(spark, root, changes(spark, [("u", 5, "u7", "new")]))
    assert m.snapshot == 1 and m.rewritten == 1
    after = files(spark, root)
    gone = {f.split("/bucket=")[1].split("/")[0] for f in before - after}
    new = {f.split("/bucket=")[1].split("/")[0] for f in after - before}
    assert len(gone) == 1 and gone == new and len(after & before) == len(before) - 1
    got = rows(D.read_dimension(spark, root, keys=["u7"]))
    assert [(r[1], r[5], r[6]) for r in sorted(got, key=lambda r: r[6])] == [("name 7", False, 1), ("new", True, 2)]
    assert D.read_dimension(spark, root).count() == 201


def test_equals_one_application_of_all_changes(spark, root):
    batches = [[("u", 5, "u7", "a"), ("u", 6, "u8", "b"), ("d", 7, "u9", None)],
               [("c", 8, "fresh", "c"), ("u", 9, "u7", "d"), ("d", 9, "none", None)],
               [("r", 10, "u1", "read")], [("u", 4, "u7", "late"), ("u", 11, "u7", "e")]]
    now = C.initialize_dimension(users(spark), now=T0)
    for batch in batches:
        D.apply_batch(spark, root, changes(spark, batch))
        now = C.scd2_apply(now, changes(spark, batch))
    assert rows(D.read_dimension(spark, root)) == rows(now)
    assert D.snapshots(spark, root) == [3, 2, 1, 0]         # a batch of reads only makes none
    assert rows(D.read_dimension(spark, root, 0)) == rows(C.initialize_dimension(users(spark), now=T0))


def test_repeated_batch_and_second_source(spark, root):
    first = changes(spark, [("u", 5, "u7", "a")])
    write = D.batch_writer(spark, root, "one")
    write(first, 0)
    write(first, 0)
    write(changes(spark, [("r", 5, "u7", "a")]), 1)         # nothing applies: noted, nothing rewritten
    m = D.manifest(spark, root)
    assert m.sources == {"one": 1} and m.snapshot == 2 and m.rewritten == 0
    D.batch_writer(spark, root, "two")(changes(spark, [("u", 6, "u7", "b")]), 0)
    assert D.read_dimension(spark, root, keys=["u7"]).count() == 3
    assert D.manifest(spark, root).sources == {"one": 1, "two": 0}


def test_two_writers_and_missing_table(spark, root, tmp_path, monkeypatch):
    old = D.manifest(spark, root)
    D.apply_batch(spark, root, changes(spark, [("u", 5, "u7", "a")]))
    monkeypatch.setattr(D, "manifest", lambda *a: old)
    with pytest.raises(RuntimeError):
        D.apply_batch(spark, root, changes(spark, [("u", 5, "u8", "b")]))
    monkeypatch.undo()
    with pytest.raises(RuntimeError):
        D.create_dimension(C.initialize_dimension(users(spark), now=T0), root, 8)
    with pytest.raises(ValueError):
        D.manifest(spark, str(tmp_path / "none"))


def test_expire_keeps_what_is_named(spark, root):
    for k in range(4):
        D.apply_batch(spark, root, changes(spark, [("u", 5 + k, "u7", f"n{k}")]))
    want = rows(D.read_dimension(spark, root))
    assert D.expire(spark, root, keep=1) == 3               # the middle three; the first holds other buckets
    assert D.snapshots(spark, root) == [4] and rows(D.read_dimension(spark, root)) == want


def test_extra_columns_and_empty_buckets(spark, tmp_path):
    dim = C.initialize_dimension(spark.createDataFrame(
        [("u1", "n", "e", 5)], "user_id string, name string, email string, bucket_size long"), now=T0)
    D.create_dimension(dim, str(tmp_path), 16)
    D.apply_batch(spark, str(tmp_path), changes(spark, [("u", 5, "u1", "a"), ("c", 6, "u2", "b")]))
    got = {(r.user_id, r.version): r.bucket_size for r in D.read_dimension(spark, str(tmp_path)).collect()}
    assert got == {("u1", 1): 5, ("u1", 2): None, ("u2", 1): None}


def test_stream(spark, root, tmp_path):
    src = f"{root}/changes"
    like = changes(spark, [])
    like.write.parquet(src)
    for batch in ([("u", 5, "u7", "a")], [("u", 6, "u7", "b")]):
        changes(spark, batch).coalesce(1).write.mode("append").parquet(src)
        D.start_dimension(spark.readStream.schema(like.schema).parquet(src), root, f"{root}/chk",
                          trigger={"availableNow": True}).awaitTermination()
    assert D.read_dimension(spark, root, keys=["u7"]).count() == 3
    assert list(D.manifest(spark, root).sources.values()) == [1]
