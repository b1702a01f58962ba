import math

import pytest
from pyspark.sql import functions as F

from temblor.model import evaluate, importances, prepare, split, train
from temblor.plans import driver, modeling
from temblor.streaming import alert_messages, score

SF = "/root/testdata/sf0.001"


def test_small_forest_end_to_end(spark):
    rows = modeling.training_rows(spark, SF)
    clean = prepare(rows, keep=["id"])
    tr, te = split(clean, 0.8, 42, key="id")
    tr2, te2 = split(clean, 0.8, 42, key="id")
    assert sorted(r.id for r in te.collect()) == sorted(r.id for r in te2.collect())
    model = train(tr, num_trees=5, max_depth=4)
    m = evaluate(model, te).first()
    assert m.test_rows == te.count() and math.isfinite(m.rmse) and m.mae <= m.rmse + 1e-9
    imp = importances(model).collect()
    assert len(imp) == 4 and abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    q = driver.quakes_view(spark, SF).withColumnsRenamed(
        {k: v for k, v in modeling.RENAME.items() if k != "magnitude"})
    scored = score(model, q.withColumn("id", F.col("id").cast("string"))
                   .withColumn("place", F.lit(None).cast("string")), threshold=0.0)
    assert scored.count() == q.count()
    al = alert_messages(scored).first()
    assert al.subject.startswith("M ")
    assert "place=n/a" in al.body


def test_gate_drops_bad_rows(spark):
    df = spark.createDataFrame([("1.5", "2", "-3", "4", "5.0"), ("None", "2", "3", "4", "5")],
                               ",".join(f"{c} string" for c in
                                        ["source_depth_km", "source_gap_deg", "source_latitude",
                                         "source_longitude", "source_magnitude"]))
    assert prepare(df).count() == 1


def test_scoring_batch_routes_skipped_rows(spark, tmp_dir):
    import json
    import os

    from temblor.streaming import prepare_scoring_input, scoring_batch
    rows = modeling.training_rows(spark, SF)
    model = train(prepare(rows), num_trees=3, max_depth=3)
    msgs = spark.createDataFrame([
        (json.dumps({"id": "a", "magnitude": 3.0, "time": 1.7e12, "gap": 10.0, "latitude": 1.0,
                     "longitude": 2.0, "depth": 5.0}),),
        (json.dumps({"id": "b", "magnitude": 3.0, "time": 1.7e12, "gap": None, "latitude": 1.0,
                     "longitude": 2.0, "depth": 5.0}),)], "value string")
    fn = scoring_batch(model, os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "a"),
                       os.path.join(tmp_dir, "s"), threshold=0.0)
    batch = prepare_scoring_input(msgs)
    fn(batch, 7)
    fn(batch, 7)  # replayed epoch: replaced, not duplicated
    preds = spark.read.parquet(os.path.join(tmp_dir, "p"))
    assert [r.id for r in preds.collect()] == ["a"]
    assert [r.id for r in spark.read.parquet(os.path.join(tmp_dir, "s")).collect()] == ["b"]
    assert spark.read.parquet(os.path.join(tmp_dir, "a")).count() == 1


def test_forest_as_expression_equals_the_model(spark, tmp_dir):
    import os

    from pyspark.sql import functions as F

    from temblor.model import forest as m
    from temblor.session import scratch_path
    i = F.col("id")
    rows = spark.range(400).select(
        "id", *[((i * k) % 97 / 7).cast("float").alias(c)
                for k, c in zip((3, 5, 11, 13), m.FEATURES)],
        ((i * 17) % 31 / 10).cast("float").alias(m.LABEL))
    model = m.train(rows, num_trees=7, max_depth=6)
    path = scratch_path(spark, "models", "expression")
    m.save(model, path)
    prediction = m.forest_prediction(spark, path)
    # also values between and on the thresholds, and far outside
    other = rows.withColumn(m.FEATURES[0], F.when(i % 3 == 0, F.lit(-1e30)).otherwise(
        F.col(m.FEATURES[0]) + 0.001))
    for df in (rows, other):
        both = model.transform(df).withColumn("again", prediction)
        assert both.where(~F.col("prediction").eqNullSafe(F.col("again"))).count() == 0
    gap = rows.withColumn(m.FEATURES[2], F.lit(None).cast("float"))
    assert gap.select(prediction.alias("p")).where("p IS NOT NULL").count() == 0


def test_forest_expression_walks_batches_also_beside_the_number_line(spark, tmp_dir):
    import os

    from temblor.model import forest as m
    i = F.col("id")
    rows = spark.range(300).select(
        "id", *[((i * k) % 97 / 7).cast("float").alias(c)
                for k, c in zip((3, 5, 11, 13), m.FEATURES)],
        ((i * 17) % 31 / 10).cast("float").alias(m.LABEL))
    model = m.train(rows, num_trees=5, max_depth=5)
    m.save(model, os.path.join(tmp_dir, "forest"))
    again = m.forest_prediction(spark, os.path.join(tmp_dir, "forest"))
    odd = rows.withColumn(m.FEATURES[1], F.element_at(F.array(*[
        F.lit(x).cast("float") for x in ("Infinity", "-Infinity", "3.25", "-0.0")]),
        F.pmod(i, F.lit(4)).cast("int") + 1))
    both = model.transform(odd).withColumn("again", again)
    assert both.where(~F.col("prediction").eqNullSafe(F.col("again"))).count() == 0
    # not a number is above every threshold, so it goes right at each
    nan = rows.withColumn(m.FEATURES[1], F.lit("NaN").cast("float")).select(again.alias("p"))
    far = rows.withColumn(m.FEATURES[1], F.lit("Infinity").cast("float")).select(again.alias("p"))
    assert nan.collect() == far.collect()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan  # no interpreted walk a row


EVENTS = 2_000


@pytest.fixture()
def one_split(spark, tmp_dir, monkeypatch):
    """Events in one file of one row group, worth four tasks."""
    from temblor.model import forest as m
    monkeypatch.setattr(m, "ROWS_WORTH_A_TASK", EVENTS // 4)
    _events(spark).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    return tmp_dir


def _events(spark):
    i = F.col("id")
    return spark.range(0, EVENTS, 1, 1).select(
        i.alias("event_id"),
        F.timestamp_seconds(1_704_067_200 + i * 97).cast("timestamp_ntz").alias("ts"),
        (i * 7 % 50).alias("user_id"), F.lit("click").alias("event_type"),
        ((i * 31) % 211 / 2).alias("value"), F.lit("{}").alias("props"))


def _by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_model_agreement_scores_once(spark, one_split, monkeypatch):
    from temblor.model import forest as m
    scored = []
    real = m.forest_prediction
    monkeypatch.setattr(m, "evaluate", lambda *a, **k: scored.append("evaluate"))
    monkeypatch.setattr(m, "forest_prediction",
                        lambda *a, **k: scored.append("walk") or real(*a, **k))
    got = modeling.model_agreement(spark, one_split)
    assert tuple(got.first()) == (EVENTS, 0, True, True) and scored == ["walk"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "UDF" not in plan  # a plain pass over what was scored


def test_stream_score_agreement_walks_batches(spark, one_split):
    got = modeling.stream_score_agreement(spark, one_split)
    same = F.col("same_prediction") & F.col("same_alert") & F.col("same_errors")
    assert got.count() == got.where(same).count() == EVENTS
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan


def test_scored_events_of_one_split_are_dealt_over_tasks(spark, one_split):
    scored = modeling.scored_events(spark, one_split)
    sizes = _by_task(scored)
    assert len(sizes) == 4 and sum(sizes) == EVENTS and max(sizes) <= 1.1 * EVENTS / 4


def test_stream_scores_one_landed_file_with_several_tasks(spark, one_split):
    scored = modeling.stream_scored_events(spark, one_split)
    assert scored.count() == scored.select("id").distinct().count() == EVENTS
    assert len(scored.inputFiles()) == 4  # one of each task; the landed table is one file


def test_alerts_of_one_split_are_dealt_over_tasks(spark, one_split, monkeypatch):
    monkeypatch.setattr(modeling, "DRIVER_ALERT_THRESHOLD", 0.0)
    sizes = _by_task(modeling.alerts(spark, one_split))
    assert len(sizes) == 4 and sum(sizes) == EVENTS


def test_forest_is_fitted_by_several_tasks_and_not_shaped_by_the_files(spark, one_split, tmp_dir):
    from temblor.model import forest as m
    assert m.task_count(0) == m.task_count(EVENTS // 4) == 1
    assert m.task_count(36_000_000) == 144  # no more than 250,000 rows in one
    seen = []
    for path in (one_split, f"{tmp_dir}/other"):
        if path != one_split:  # the same rows, backwards and in five files
            (_events(spark).repartitionByRange(5, F.desc("event_id"))
             .write.parquet(f"{path}/events.parquet"))
        rows = modeling.training_rows(spark, path)
        assert len(_by_task(rows)) == 4
        dealt = m.spread_in_order(prepare(rows, keep=["id"]), 4)
        assert len(_by_task(dealt)) == 4
        forest = train(dealt, num_trees=4, max_depth=4).stages[-1]
        seen.append(forest.toDebugString.splitlines()[1:])  # the first names the model's id
    assert seen[0] == seen[1]


def test_model_metrics_of_one_split(spark, one_split):
    metrics = modeling.model_metrics(spark, one_split).first()
    assert 0.1 * EVENTS < metrics.test_rows < 0.3 * EVENTS and math.isfinite(metrics.rmse)


def test_training_rows_of_a_task_lie_beside_close_ones(spark, one_split):
    from temblor.model import forest as m
    rows = prepare(modeling.training_rows(spark, one_split), keep=["id"])
    dealt = m.spread_in_order(rows, 4)
    assert sorted(dealt.collect()) == sorted(rows.collect())
    ends = rows.agg(*[f(c) for c in m.FEATURES for f in (F.min, F.max)]).first()
    middle = [(ends[2 * i] + ends[2 * i + 1]) / 2 for i in range(4)]
    tasks = dealt.select(*m.FEATURES).rdd.glom().collect()
    assert len(tasks) == 4
    for task in tasks:
        halves = [tuple(x >= at for x, at in zip(row, middle)) for row in task]
        # each combination of halves is one run of rows, not met again and again
        assert sum(a != b for a, b in zip(halves, halves[1:])) < 16 < len(halves)


def test_order_of_training_rows_with_single_and_unbounded_values(spark):
    from temblor.model import forest as m
    i = F.col("id")
    rows = spark.range(60).select(
        "id", F.lit(2.5).cast("float").alias(m.FEATURES[0]),
        F.when(i % 7 == 0, F.lit("Infinity")).when(i % 7 == 1, F.lit("-Infinity"))
        .otherwise(i.cast("string")).cast("float").alias(m.FEATURES[1]),
        F.when(i % 5 != 0, i).cast("float").alias(m.FEATURES[2]),
        F.when(i % 9 == 0, F.lit("NaN")).otherwise("1").cast("float").alias(m.FEATURES[3]))
    assert sorted(r.id for r in m.spread_in_order(rows, 3).collect()) == list(range(60))
    assert m.spread_in_order(rows.where("id < 0"), 3).count() == 0


def test_forest_is_the_same_with_node_ids_kept(spark, one_split):
    from temblor.model import forest as m
    rows = m.spread_in_order(prepare(modeling.training_rows(spark, one_split), keep=["id"]), 4)
    seen = [train(rows, num_trees=6, max_depth=6, keep_node_ids=kept).stages[-1]
            for kept in (False, True)]
    assert [f.getCacheNodeIds() for f in seen] == [False, True]
    one, other = [f.toDebugString.splitlines()[1:] for f in seen]  # the first names the model's id
    assert one == other


def test_fit_has_no_task_that_costs_more_than_its_rows():
    from temblor.model import forest as m
    assert [m.fit_task_count(n) for n in (0, 100_000, 600_000, 6_000_000, 36_000_000)] == [
        1, 5, 12, 48, 144]
    assert m.task_count(600_000) == 30


def test_fit_gets_rows_prepared_once_and_keeps_node_ids_on_some_tables(spark, one_split,
                                                                       monkeypatch):
    from temblor.model import forest as m
    given = []
    real = m.train

    def small(df, **kw):
        given.append((len(_by_task(df)), kw["keep_node_ids"], df.inputFiles()))
        return real(df, num_trees=2, max_depth=2, **kw)
    monkeypatch.setattr(m, "train", small)
    for most in (EVENTS, EVENTS - 1):
        monkeypatch.setattr(m, "ROWS_WITH_NODE_IDS", most)
        monkeypatch.setattr(modeling, "_model_path", lambda *a, most=most: f"{one_split}/m{most}")
        modeling.fitted(spark, one_split)
    assert [x[:2] for x in given] == [(4, True), (4, False)]
    for *_, files in given:  # rows that were prepared and written once, not the events again
        assert files and all("training_rows" in f for f in files)
