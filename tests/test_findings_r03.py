"""What the findings of round 3 were about: work that grew where it should not."""

import inspect
import tracemalloc
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillon.operators import labels, models, routing, stats
from quillon.plans import q_fusion, q_io, q_tables
from quillon.streaming import state


def test_resolve_lists_grams_of_distinct_names_only(spark, monkeypatch):
    """Grams were listed for each entry, and the lists sent to the driver."""
    seen, plain = [], routing.containing

    def watched(names, name, texts, text):
        seen.append((texts.count(), texts.select(text).distinct().count()))
        found = plain(names, name, texts, text)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
        return found

    monkeypatch.setattr(routing, "containing", watched)
    names = spark.range(400).select(F.concat(F.lit("C"), F.col("id")).alias("code"), F.when(F.col("id") % 2 == 0, "red bolt").otherwise("BLUE RING").alias("name"), F.concat(F.lit("about "), F.col("id")).alias("text"), F.col("id").alias("first"))
    texts = spark.createDataFrame([("Large Brand#1", 3, 5), ("Small Brand#2", 9, 7), ("Small Brand#11", 4, 2)], "text string, n long, first long")
    queries = spark.createDataFrame(
        [(1, "brand#1", "C399"), (2, "brand#1", None), (3, "BOLT", "none"), (4, "x BLUE y", None), (5, "nothing", None), (6, None, "C7"), (7, "", None), (8, "nothing", None), (8, "brand#2", None)], "query_id long, name string, code string"
    )
    rows = sorted(tuple(r) for r in routing.resolve(queries, texts, names).collect())
    assert rows == [
        (1, "about 399", "exact_id"), (2, "Small Brand#11", "text_contains"), (3, "about 0", "name_contains"), (4, "about 1", "token"), (5, None, "none"), (6, "about 7", "exact_id"), (7, None, "none"),
        (8, "Small Brand#2", "text_contains"), (8, "Small Brand#2", "text_contains"),
    ]
    assert seen and all(n == distinct for n, distinct in seen)


def test_state_by_aggregation_is_the_state_by_timers(spark, tmp_path):
    """The query called Python once for each key of each batch."""
    start = datetime(2024, 1, 1)
    batches = [
        [(1, "a", 0, 1, "started"), (1, "a", 1, 2, "complete"), (2, "a", 0, 3, "started"), (None, "a", 0, 4, "started"), (3, "b", 0, 5, None)],
        [(1, "a", 1, 2, "complete"), (1, "a", 0, 6, "failed"), (2, "b", 30, 7, "started"), (1, "a", 1, 8, "failed")],
        [(9, "z", 200, 9, "started")],
        [(2, "a", 201, 10, "complete"), (1, "a", 3, 11, "started")],
    ]
    folder, got = str(tmp_path / "in"), {}
    for rows in batches:
        df = spark.createDataFrame([(r, s, start + timedelta(hours=h), i, x) for r, s, h, i, x in rows], "run long, stage string, ts timestamp, event_id long, status string")
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        for name, changes, mode in (("timers", state.track(stream, delay="10 hours", stuck_after="24 hours"), "append"), ("totals", state.totals(stream, delay="10 hours"), "update")):
            query = state.keep_state(changes, str(tmp_path / name), str(tmp_path / f"{name}-done"), buckets=4, mode=mode)
            query.awaitTermination()
            if name == "totals":
                assert not any("Pandas" in o["operatorName"] for p in query.recentProgress for o in p["stateOperators"])
        for name in ("timers", "totals"):
            kept = state.state_now(spark, str(tmp_path / name))
            kept = kept if name == "timers" else state.stuck_now(kept, delay="10 hours", stuck_after="24 hours")
            got[name] = sorted(map(tuple, kept.select("run", "stage", "status", "attempts", "first_ts", "last_ts", "n_events", "stuck").collect()))
        assert got["totals"] == got["timers"]
    assert [r[0] for r in got["totals"] if r[-1]] == [2] and "track" not in inspect.getsource(q_tables.stage_state_stream)


def test_files_of_a_stream_grow_in_number_not_in_size(spark, sf, monkeypatch):
    """Each half of the candidates came in two files, each written and read by one task."""
    paths, plain = [], q_tables.new_path
    monkeypatch.setattr(q_tables, "new_path", lambda spark, name: paths.append(plain(spark, name)) or paths[-1])
    monkeypatch.setattr(q_tables, "TASK_ROWS", 250)
    want = {r["target_id"]: r["n"] for r in q_tables.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("target_id")).agg(F.count("*").alias("n")).collect()}
    got = {r["target_id"]: r["n"] + r["parked"] for r in q_tables.stream_layers(spark, sf).collect()}
    sizes = [r["n"] for r in spark.read.parquet(next(p for p in paths if "/candidates-" in p)).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert got == want and len(sizes) > 4 and max(sizes) <= 2 * 250


def test_resamples_are_drawn_in_bounded_numbers(spark, monkeypatch):
    """A task drew 100 resamples of all targets at once."""
    long = spark.range(100_000).select(F.lit("m").alias("metric"), F.col("id").alias("target_id"), F.sin("id").alias("value"))
    v = np.array([r["value"] for r in long.orderBy("target_id").collect()])
    kept, cls = {}, type(long)
    monkeypatch.setattr(cls, "mapInArrow", lambda df, run, schema, *a: kept.setdefault("run", run) and df.select("metric", F.lit(0.0).alias("m")))
    stats.bootstrap_median(long, reps=100)
    batch = pa.RecordBatch.from_arrays([pa.array(["m"]), pa.array([1]), pa.array([v])], ["metric", "_first", "_v"])
    first = next(kept["run"](iter([batch])))  # what is loaded at first is not counted
    tracemalloc.start()
    again = next(kept["run"](iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [np.median(v[stats.draws(42, np.arange(i, i + 1), len(v))[0]]) for i in (1, 50, 100)]
    assert again.equals(first) and again.num_rows == 100 and [again.column(1)[i].as_py() for i in (0, 49, 99)] == want
    assert most < 100 << 20


def test_a_network_trains_in_one_job_a_round(spark, monkeypatch):
    """Each step of L-BFGS was a job over all rows."""
    monkeypatch.setattr(models, "PART_ROWS", 1000, raising=False)
    df = spark.range(6000).select(F.sin("id").alias("a"), F.cos(F.col("id") * 0.7).alias("b")).withColumn("label", (F.col("a") * F.col("b") > 0).cast("int"))
    spark.sparkContext.setJobGroup("network", "train_mlp")
    model = models.train_mlp(df, ["a", "b"], (16, 8), rounds=10)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("network")) <= 45
    assert models.predict(model, df).filter("(p > 0.5) <> (label = 1)").count() < 300
    assert models.train_mlp(df, ["a", "b"], (16, 8), rounds=10).stages[-1].weights == model.stages[-1].weights
    one = df.limit(40).withColumn("a", F.lit(1.0)).withColumn("b", F.lit(2.0))  # equal rows are on one side of the hash
    assert models.predict(models.train_mlp(one, ["a", "b"], (4,), rounds=2), one).filter("p between 0 and 1").count() == 40


def test_pairs_are_shuffled_once_for_cleaning_and_not_for_a_split(spark):
    """Conflicts, first rows and the split each shuffled and sorted all rows."""
    df = spark.range(5000).select((F.col("id") % 7).alias("t"), (F.col("id") % 450).alias("k"), F.when(F.col("id") % 11 > 0, F.col("id") % 450 % 2).when(F.col("id") % 5 == 0, 1).alias("label"), (-F.col("id")).alias("o"))
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    cleaned = labels.clean_pairs(df, ["t", "k"], ["o"])
    found, first, kinds = sorted(map(tuple, cleaned.collect())), {}, {}
    for t, k, label, o in sorted(map(tuple, df.filter("label is not null").collect()), key=lambda r: r[3]):
        first.setdefault((t, k), (t, k, label, o))
        kinds.setdefault((t, k), set()).add(label)
    assert found == sorted(r for x, r in first.items() if len(kinds[x]) == 1) and any(len(x) == 2 for x in kinds.values())
    assert plan(labels.clean_pairs(df, ["t", "k"], ["o"])).count("Exchange hashpartitioning") == 1
    parts = labels.stratified_split(cleaned, ["t", "k"], held=0.3)
    assert "Exchange hashpartitioning" not in plan(parts)
    by_hash = cleaned.withColumn("h", labels.hash_order(42, F.col("t"), F.col("k"))).collect()
    for label in (0, 1):
        order = [(r["t"], r["k"]) for r in sorted(by_hash, key=lambda r: r["h"]) if r["label"] == label]
        assert {(r["t"], r["k"]) for r in parts.filter(f"label = {label} and split = 'heldout'").collect()} == set(order[: round(len(order) * 0.3)])


def test_metrics_are_made_once_and_no_task_has_all_of_them(spark, sf, monkeypatch):
    """Both tiers made the metrics; the report's median was taken by one task."""
    names, plain, given = [], q_fusion.saved, []
    monkeypatch.setattr(q_fusion, "saved", lambda df, name: names.append(name) or plain(df, name))
    assert q_fusion.metrics_by_tier(spark, sf).count() and names == ["metrics"]
    report = q_io.writers.report
    monkeypatch.setattr(q_io.writers, "report", lambda summary, statuses: given.append(summary) or report(summary, statuses))
    q_io.snk_report(spark, sf)
    plan = given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "median(" not in plan and "percentile(" not in plan and given[0].count() == 1
