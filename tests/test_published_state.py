import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from quillon.sources import published, readers
from quillon.streaming import jobs, state


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    with pytest.raises(ValueError, match="no table"):
        published.read(spark, path)
    assert published.publish(df, path) == 0
    with pytest.raises(Exception, match="half way"):
        published.publish(df.withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("half way")).cast("long")).otherwise(0)), path)
    assert rows_of(published.read(spark, path)) == rows_of(df)
    with pytest.raises(ValueError, match="3 rows break positive"):
        published.publish(df.withColumn("v", F.col("id") - 2), path, rules={"positive": F.col("v") > 0, "there": F.col("id").isNotNull()})
    assert rows_of(published.read(spark, path)) == rows_of(df) and len(files(path)) == len(files(path + "/" + published.current(spark, path)["parts"][""]))
    assert published.publish(published.read(spark, path).filter("id < 10"), path, rules={"small": F.col("id") < 10}, counts={"even": F.col("id") % 2 == 0}) == 1
    assert published.current(spark, path)["seen"] == {"n_rows": 10, "small": 0, "even": 5}
    assert published.read(spark, path).count() == 10 and published.read(spark, path, 0).count() == 100
    assert published.vacuum(spark, path, keep=1) == 1 and published.read(spark, path).count() == 10
    with pytest.raises(ValueError, match="there already"):
        published._announce(spark, path, {"number": 1})


def test_rules_and_counts_make_the_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(1000).withColumn("v", F.col("id") % 7).mapInArrow(count, "id long, v long")
    published.publish(df, str(tmp_path / "t"), rules={"v": F.col("v") < 7}, counts={"zero": F.col("v") == 0})
    assert made.value == 1000 and published.current(spark, str(tmp_path / "t"))["seen"] == {"n_rows": 1000, "v": 0, "zero": 143}


def test_upsert_rewrites_the_buckets_it_must(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(300)], "k string, v long")
    assert published.upsert(df.limit(0), path, keys=["k"], buckets=16) == []
    assert published.read(spark, path).count() == 0
    published.upsert(df, path)
    before = files(path)
    some = spark.createDataFrame([("k5", -5), ("new", 1)], "k string, v int")
    written = published.upsert(some, path, note="n")
    assert 1 <= len(written) <= 2 and published.current(spark, path)["note"] == "n"
    after = files(path)
    assert all(after[f] == t for f, t in before.items()), "files that were there stay as they are"
    kept = {p for b, p in published.current(spark, path)["parts"].items() if int(b) not in written}
    assert len(kept) == 16 - len(written) and all(any(k in f for f in before) for k in kept)
    want = sorted([(f"k{i}", i) for i in range(300) if i != 5] + [("k5", -5), ("new", 1)])
    assert rows_of(published.read(spark, path)) == want
    published.vacuum(spark, path, keep=1)
    assert rows_of(published.read(spark, path)) == want and len(files(path)) < len(after)
    assert published.upsert(some.limit(0), path) == []


def stage_rows(spark, rows):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([(r, s, start + timedelta(hours=h), i, x) for r, s, h, i, x in rows], "run long, stage string, ts timestamp, event_id long, status string")


def test_state_with_late_and_repeated_events_and_a_restart(spark, tmp_path):
    folder, kept, done = (str(tmp_path / x) for x in ("in", "kept", "done"))
    batches = [
        [(1, "a", 0, 1, "started"), (1, "a", 1, 2, "complete"), (2, "a", 0, 3, "started"), (None, "a", 0, 4, "started"), (3, "b", 0, 5, None)],
        [(1, "a", 1, 2, "complete"), (1, "a", 0, 6, "failed"), (2, "b", 30, 7, "started"), (1, "a", 1, 8, "failed")],
        [(9, "z", 200, 9, "started")],
        [(2, "a", 201, 10, "complete"), (1, "a", 3, 11, "started")],
    ]
    sizes = []
    for rows in batches:
        stage_rows(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(stage_rows(spark, rows).schema).parquet(folder)
        query = state.keep_state(state.track(stream, delay="10 hours", stuck_after="24 hours"), kept, done, buckets=4)
        query.awaitTermination()
        sizes += [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"] if o["operatorName"] == "applyInPandasWithState"]
    got = {(r["run"], r["stage"]): (r["status"], r["attempts"], r["n_events"], r["stuck"]) for r in state.state_now(spark, kept).collect()}
    # event 11 came when the watermark was past it; stage (2, b) has been started since hour 30, (2, a) was stuck and went on
    assert got == {(1, "a"): ("failed", 1, 4, False), (2, "a"): ("complete", 1, 2, False), (2, "b"): ("started", 1, 1, True), (3, "b"): ("", 0, 1, False), (9, "z"): ("started", 1, 1, False)}
    assert sizes[-1] == len(got)
    assert all(r["change_no"] >= 3 for r in state.state_now(spark, kept).filter("run = 2 and stage = 'a'").collect())


def test_fold_in_any_order():
    events = pd.DataFrame({"us": [5, 3, 5, 1], "event_id": [1, 9, 2, 4], "status": ["started", "complete", "failed", "started"]})
    whole = state.fold(state.EMPTY, events)
    assert whole == ("failed", 5, 2, 2, 1, 5, 4, 0)
    for k in range(1, 4):
        assert state.fold(state.fold(state.EMPTY, events[k:]), events[:k]) == whole


def test_rows_wait_for_layers_that_come_later(spark, tmp_path):
    folder, layers, out, parked, done = (str(tmp_path / x) for x in ("in", "layers", "out", "parked", "done"))
    rows = [(i, i % 4, 0.5, 0.5, 0.5) for i in range(12)]
    kinds = "id long, k long, l1 double, l2 double, l3 double"

    def go(some, known):
        spark.createDataFrame(some, kinds).coalesce(1).write.mode("append").parquet(folder)
        published.upsert(spark.createDataFrame([(k, 0.25) for k in known], "k long, l4 double"), layers, keys=["k"], buckets=2)
        jobs.attach_layers(spark.readStream.schema(kinds).parquet(folder), layers, out, parked, done, key="k").awaitTermination()
        return {r["id"] for r in spark.read.parquet(out).collect()}, {r["id"] for r in published.read(spark, parked).collect()}

    assert go(rows[:6], [0]) == ({0, 4}, {1, 2, 3, 5})
    assert go(rows[6:], [1]) == ({0, 4, 8, 1, 5, 9}, {2, 3, 6, 7, 10, 11})
    scored, waiting = go(rows[:0] or [(12, 9, 0.1, 0.1, 0.1)], [2, 3])
    assert scored == set(range(12)) and waiting == {12}
    assert spark.read.parquet(out).filter("status = 'ok'").count() == 12


def test_a_bucketed_side_is_not_shuffled(spark):
    cache = readers.bucketed(spark.range(2000).withColumn("v", F.col("id") * 3), "id", 8)
    rows = spark.range(5000).withColumn("id", F.col("id") % 2000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rows.join(cache, "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.filter("v = 3 * id").count() == 5000
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert "Exchange" not in cache.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
