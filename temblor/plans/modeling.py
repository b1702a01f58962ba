"""Model questions over the driver tables. SQL cannot fit the forest, but it
knows what checks of it must return: the saved nodes, walked by a Column
expression, give every prediction again (``*_agreement``); the other outputs
have rows-only checks.

Training rows come from ``quakes_view`` renamed to the model's column names.
The fitted pipeline is kept under the shared checkpoint folder, one per input
directory, so the four model outputs share one fit. A table's files may be few
splits: what is done for each event is dealt over tasks by the number of rows.
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ..functions.timefn import ts_to_epoch_ms
from ..model import forest as m
from ..session import land, scratch_path
from ..sources.files import input_tag, path_exists
from ..sources.feed import publish_json
from ..streaming.scoring import (ALERT_THRESHOLD, alert_messages, prepare_scoring_input, score,
                                 score_columns, scoring_batch)
from . import driver

RENAME = {"depth": "source_depth_km", "gap": "source_gap_deg",
          "latitude": "source_latitude", "longitude": "source_longitude",
          "magnitude": "source_magnitude"}


def _rows(spark, sf_dir):
    return driver.table(spark, sf_dir, "events").count()


def _tasks(spark, sf_dir):
    return m.task_count(_rows(spark, sf_dir))


def _quakes(spark, sf_dir):
    """``quakes_view``, its rows dealt over tasks."""
    ev = driver.table(spark, sf_dir, "events")
    return driver.quakes_from_events(m.spread(ev, _tasks(spark, sf_dir)))


def training_rows(spark, sf_dir):
    q = _quakes(spark, sf_dir).withColumnsRenamed(RENAME)
    return q.select("id", *m.FEATURES, m.LABEL)


def _model_path(spark, sf_dir):
    """One model per input: keyed by the events files and the parameters."""
    tag = input_tag(spark, [f"{sf_dir}/events.parquet"], m.FEATURES, 0.8, 42)
    return scratch_path(spark, "models", f"magnitude-{tag}", unique=False)


def fitted(spark, sf_dir):
    """(model, test rows): fit once per input, then reuse the saved model."""
    clean = m.prepare(training_rows(spark, sf_dir), keep=["id"])
    train_df, test_df = m.split(clean, 0.8, 42, key="id")
    path = _model_path(spark, sf_dir)
    if path_exists(spark, f"{path}/metadata/_SUCCESS") and path_exists(
            spark, f"{path}/stages"):
        return m.load(path), test_df
    rows = _rows(spark, sf_dir)
    tasks = m.fit_task_count(rows)
    if tasks > 1:  # read twice to be put in order: prepared once
        train_df = land(train_df, "training_rows")
    model = m.train(m.spread_in_order(train_df, tasks),
                    keep_node_ids=rows <= m.ROWS_WITH_NODE_IDS)
    m.save(model, path)
    return model, test_df


def model_metrics(spark, sf_dir):
    model, test = fitted(spark, sf_dir)
    return m.evaluate(model, test)


def feature_importance(spark, sf_dir):
    model, _ = fitted(spark, sf_dir)
    return m.importances(model)


def scored_events(spark, sf_dir):
    model, _ = fitted(spark, sf_dir)
    q = _quakes(spark, sf_dir).withColumnsRenamed(RENAME)
    df = (q.withColumnRenamed("source_magnitude", "magnitude")
           .withColumn("id", F.col("id").cast("string"))
           .withColumn("place", F.lit(None).cast("string")))
    return score(model, df)


# The derived magnitudes are small: predictions lie around 1, few above this.
DRIVER_ALERT_THRESHOLD = 1.2


def alerts(spark, sf_dir):
    scored = scored_events(spark, sf_dir).drop("alert", "error_abs", "error_squared")
    return alert_messages(score_columns(scored, DRIVER_ALERT_THRESHOLD))


def _unequal(a, b):
    return F.count_if(~a.eqNullSafe(b)).alias("unequal")


def model_agreement(spark, sf_dir):
    """Predictions of all training and test rows by the fitted pipeline and by
    its nodes as an expression: rows, how many differ, and whether RMSE, MAE and
    R^2 of the test rows are the same from ``evaluate``, from Spark's evaluator
    and from plain aggregates over the expression; whether the importances are
    shares in descending order."""
    model, _ = fitted(spark, sf_dir)
    rows = m.prepare(training_rows(spark, sf_dir), keep=["id"])
    again = m.forest_prediction(spark, _model_path(spark, sf_dir))
    # Scored once in both ways; what follows are plain passes over two numbers a row.
    rows = land(model.transform(rows).withColumn("again", again)
                .select("id", m.LABEL, "prediction", "again"), "model_agreement")
    _, test = m.split(rows, 0.8, 42, key="id")
    counts = rows.agg(F.count(F.lit(1)).alias("rows_scored"),
                      _unequal(F.col("prediction"), F.col("again")))
    own = m.metrics_of(test).first()
    off = F.col(m.LABEL) - F.col("again")
    plain = test.agg(
        F.sqrt(F.avg(F.pow(off, 2))).alias("rmse"), F.avg(F.abs(off)).alias("mae"),
        (1 - F.avg(F.pow(off, 2)) / F.var_pop(m.LABEL)).alias("r2")).first()
    same = all(abs(own[k] - plain[k]) < 1e-6 and abs(own[k] - RegressionEvaluator(
        labelCol=m.LABEL, metricName=k).evaluate(test)) < 1e-6 for k in ("rmse", "mae", "r2"))
    shares = [r["importance"] for r in m.importances(model).collect()]
    ranked = abs(sum(shares) - 1) < 1e-9 and shares == sorted(shares, reverse=True)
    return counts.withColumns({"metrics_agree": F.lit(same), "importances_agree": F.lit(ranked)})


AGREEMENT_SQL = """
SELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS unequal, true AS metrics_agree,
       true AS importances_agree FROM events"""


def stream_score_agreement(spark, sf_dir):
    """Each event that the stream scored: its magnitude, whether prediction, alert
    flag and errors are what the nodes as an expression give."""
    scored = stream_scored_events(spark, sf_dir)
    again = m.forest_prediction(spark, _model_path(spark, sf_dir))
    off = F.col("again") - F.col("magnitude")
    return scored.withColumn("again", again).select(
        F.col("id").cast("long").alias("id"), F.round("magnitude", 6).alias("magnitude"),
        (F.col("prediction") == F.col("again")).alias("same_prediction"),
        (F.col("alert") == (F.col("again") >= ALERT_THRESHOLD)).alias("same_alert"),
        ((F.col("error_abs") == F.abs(off)) & (F.col("error_squared") == F.pow(off, 2)))
        .alias("same_errors"))


SCORE_AGREEMENT_SQL = f"""
WITH {driver.QUAKES_SQL}
SELECT id, round(magnitude, 6) AS magnitude, true AS same_prediction, true AS same_alert,
       true AS same_errors FROM quakes"""


def stream_scored_events(spark, sf_dir):
    """P1/P2 as a stream: events -> JSON messages -> decode -> score ->
    foreachBatch (predictions + alerts, replay-safe) -> predictions table."""
    from .streams import quake_stream
    model, _ = fitted(spark, sf_dir)
    q = m.spread(quake_stream(spark, sf_dir), _tasks(spark, sf_dir))
    msgs = publish_json(q.select(F.col("id").cast("string").alias("id"), "magnitude",
                                 F.lit(None).cast("string").alias("place"),
                                 ts_to_epoch_ms("time", ntz=True).cast("double").alias("time"),
                                 "gap", "latitude", "longitude", "depth"))
    rows = prepare_scoring_input(msgs)
    root = scratch_path(spark, "streams", "scoring")
    pred_path, alert_path = f"{root}/predictions", f"{root}/alerts"
    query = (rows.writeStream.outputMode("append")
             .option("checkpointLocation", f"{root}/_checkpoint")
             .foreachBatch(scoring_batch(model, pred_path, alert_path, f"{root}/skipped"))
             .trigger(availableNow=True).start())
    query.awaitTermination()  # to the end; raises what ended the stream
    return spark.read.parquet(pred_path).drop("run_id", "epoch_id")


QUERIES = {
    "model_metrics": model_metrics,
    "feature_importance": feature_importance,
    "scored_events": scored_events,
    "alerts": alerts,
    "stream_scored_events": stream_scored_events,
    "model_agreement": model_agreement,
    "stream_score_agreement": stream_score_agreement,
}

ORACLE_SQL = {
    "model_agreement": AGREEMENT_SQL,
    "stream_score_agreement": SCORE_AGREEMENT_SQL,
}
