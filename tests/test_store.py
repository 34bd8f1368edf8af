"""Versioned tables: commits by pointer, reruns, partial merges, appended parts."""

import os

import pytest
from pyspark.sql import functions as F

from poolwright.sources.store import CommitConflict, TableStore, Transaction, bucket_of


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/store")


def files(store):
    top = store.root.removeprefix("file://")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{top}/data") for f in names if f.endswith(".parquet")}


def test_a_job_rewrites_the_table_that_it_reads(spark, store):
    assert store.version().number == -1
    store.run("one", lambda tx: tx.put("t", spark.range(5).withColumn("v", F.lit(0))))
    first = store.version()

    def job(tx):
        tx.put("t", tx.read("t").withColumn("v", F.col("v") + 1))
        tx.put("t", tx.read("t").withColumn("v", F.col("v") * 10))  # reads what this run wrote

    assert store.run("two", job).number == 1 and store.version().tables["t"].rows == 5
    assert rows(store.read("t")) == [(k, 10) for k in range(5)] and rows(store.read("t", first)) == [(k, 0) for k in range(5)]


def test_a_killed_run_leaves_the_old_state_and_one_version(spark, store):
    store.run("one", lambda tx: tx.put("t", spark.range(3).toDF("k")))

    def dies(tx):
        tx.put("t", tx.read("t").select((F.col("k") + 100).alias("k")))
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        store.run("two", dies)
    assert rows(store.read("t")) == [(0,), (1,), (2,)]
    calls = []

    def job(tx):
        calls.append(1)
        tx.put("t", tx.read("t").select((F.col("k") + 100).alias("k")))

    assert [store.run("two", job).number for _ in range(3)] == [1, 1, 1] and len(calls) == 1  # a retry isn't run again
    assert rows(store.read("t")) == [(100,), (101,), (102,)] and [v.run_id for v in store.versions()] == ["one", "two"]


def test_two_writers_conflict(spark, store):
    store.run("one", lambda tx: tx.put("t", spark.range(1)))
    late = Transaction(store, "late", store.version())
    late.put("t", spark.range(9))
    store.run("fast", lambda tx: tx.put("t", spark.range(2)))
    with pytest.raises(CommitConflict):
        late.commit()
    assert store.read("t").count() == 2
    assert store.run("late", lambda tx: tx.put("t", spark.range(9))).number == 2 and store.read("t").count() == 9


def test_merge_rewrites_only_the_buckets_of_the_keys(spark, store):
    base = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"), F.lit("x").alias("w"))
    store.run("one", lambda tx: tx.put_keyed("t", base, ["k"], buckets=16))
    before = files(store)
    source = base.where(bucket_of(["k"], 16).isin(3, 7)).limit(10).select("k", F.lit("new").alias("v"))
    keys = {r.k for r in source.collect()}
    touched = []
    store.run("two", lambda tx: touched.extend(tx.merge("t", source, {"v": "overwrite"})))
    assert set(touched) <= {3, 7} and touched
    assert {r.k: r.v for r in store.read("t").collect()} == {str(k): "new" if str(k) in keys else "old" for k in range(1000)}
    after = files(store)
    assert all(after[f] == t for f, t in before.items())  # no file of the old version was touched
    named = {p for _, p in store.version().tables["t"].parts}
    assert sum("/one/" in p for p in named) == 16 - len(touched)
    store.run("three", lambda tx: tx.merge("t", spark.createDataFrame([("fresh", "new")], "k string, v string"), {"v": "overwrite"}, {"w": F.lit("y")}))
    assert rows(store.read("t").where("k = 'fresh'")) == [("fresh", "new", "y")] and store.read("t").count() == 1001


def test_append_reads_nothing(spark, store):
    store.run("one", lambda tx: tx.append("h", spark.createDataFrame([(1, "a")], "k long, v string")))
    before = files(store)
    store.run("two", lambda tx: tx.append("h", spark.createDataFrame([("b", 2)], "v string, k long")))
    assert rows(store.read("h")) == [(1, "a"), (2, "b")] and store.version().tables["h"].rows == 2
    assert {f for f in files(store)} > set(before)


def test_vacuum_keeps_what_is_named(spark, store):
    store.run("one", lambda tx: (tx.put("t", spark.range(3)), tx.put_keyed("k", spark.range(8).toDF("id"), ["id"], 4)))
    store.run("two", lambda tx: (tx.put("t", spark.range(4)), tx.merge("k", spark.range(1).toDF("id"), {})))
    tx = Transaction(store, "orphan", store.version())
    tx.put("t", spark.range(99))
    assert store.vacuum() >= 3
    assert store.read("t").count() == 4 and store.read("k").count() == 8 and [v.number for v in store.versions()] == [1]


def test_nights_on_a_store(spark, store, monkeypatch):
    """A killed night leaves nothing; run again it leaves one version; the next night starts from what it left and
    doesn't read closed placements."""
    import datetime as dt

    from poolwright.operators import apply as AP
    from poolwright.plans import nightly
    from poolwright.registry import APPLY, PLACEMENT_COLS, QUERIES, _renamed
    from poolwright.sources.fixtures import Fixtures

    t = nightly.from_fixtures(Fixtures(spark, "/root/testdata/sf0.001", APPLY))
    real = AP.audit_rows

    def dies(*a):
        raise KeyboardInterrupt

    monkeypatch.setattr(AP, "audit_rows", dies)
    with pytest.raises(KeyboardInterrupt):
        nightly.run_night(store, t, APPLY)
    assert store.versions() == []
    monkeypatch.setattr(AP, "audit_rows", real)
    first = {r.metric: r.value for r in nightly.run_night(store, t, APPLY).collect()}
    assert {r.metric: r.value for r in nightly.run_night(store, t, APPLY).collect()} == first and len(store.versions()) == 1
    history = _renamed(store.read("placements_open").unionByName(store.read("placements_closed")), PLACEMENT_COLS)
    assert rows(history.fillna("")) == rows(QUERIES["ap6_placements_refreshed"][0](spark, "/root/testdata/sf0.001").fillna(""))
    assert first["companies_moved"] == store.read("moves").count() > 0 and first["companies"] == store.read("companies").count()

    scanned = []
    load = TableStore._load
    monkeypatch.setattr(TableStore, "_load", lambda self, table, parts: (lambda p: (scanned.extend(p), load(self, table, p))[1])(list(parts)))
    later = APPLY.with_(run_id="run-2000-01-02", run_date=dt.date(2000, 1, 2), run_ts=dt.datetime(2000, 1, 2, 2, 30))
    nightly.run_night(store, t, later)
    assert scanned and not any("placements_closed" in p for p in scanned)
    assert [v.run_id for v in store.versions()] == [APPLY.run_id, later.run_id]
    assert store.read("placements_open").groupBy("companyId").count().where("count > 1").count() == 0
    assert store.read("audits").where(F.col("createdAt") == F.lit("2000-01-02 02:30:00").cast("timestamp_ntz")).count() == store.version().tables["moves"].rows
