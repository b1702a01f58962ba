"""Magnitude model: prepare, split, fit, evaluate, importances, persist."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import SIGNED_NUMBER, gated_cast

FEATURES = ["source_depth_km", "source_gap_deg", "source_latitude", "source_longitude"]
LABEL = "source_magnitude"

# Rows a task reads: from the first figure on a table is dealt over more tasks, up
# to TASKS, and then over so many that none has more than the second.
ROWS_WORTH_A_TASK = 20_000
ROWS_PER_TASK = 250_000
TASKS = 48
# The fit sends the sums of every node of a level from each task, however few rows it
# has. Above the first figure a task is worth it only with so many rows as the second.
FIT_TASKS = 12
ROWS_WORTH_A_FIT_TASK = 50_000
# Up to so many rows the fit keeps the node of each row in each tree (400 bytes a row, of
# several levels at once) instead of walking down again at each level; the forest is the same.
ROWS_WITH_NODE_IDS = 1_000_000
# Times that each feature's range is halved to find rows that lie close together.
HALVINGS = 4


def task_count(rows: int) -> int:
    """Tasks for ``rows``. It follows from the rows alone, not from the cluster or
    from the files, so that the same rows give the same forest everywhere."""
    return max(1, min(-(-rows // ROWS_WORTH_A_TASK), TASKS), -(-rows // ROWS_PER_TASK))


def fit_task_count(rows: int) -> int:
    """Tasks of the fit for ``rows``, never more than ``task_count``."""
    return min(task_count(rows), max(FIT_TASKS, -(-rows // ROWS_WORTH_A_FIT_TASK)))


def spread(df: DataFrame, tasks: int) -> DataFrame:
    """Rows dealt evenly over ``tasks``, however few splits their files have (a
    Parquet row group is one split); a table worth one task stays as it is."""
    return df.repartition(tasks) if tasks > 1 else df


def spread_in_order(df: DataFrame, tasks: int, near=FEATURES) -> DataFrame:
    """As ``spread``, with the same rows in the same order in each task at every
    run: the forest draws its samples by task and position.

    Rows close to each other in the columns ``near`` follow one another in a task.
    They take the same paths down the trees, whose nodes and sums are then likely still
    in the processor's caches: in the order of ids the deepest level took over twice the time."""
    if tasks <= 1:
        return df
    return (df.repartition(tasks, *df.columns)
              .sortWithinPartitions(_cell(df, near), *df.columns))


def _cell(df: DataFrame, columns) -> Column:
    """Number of a row's cell when the ranges of ``columns`` are halved in turn, again
    and again: close rows have close numbers, and the rows alone decide them."""
    ends = df.agg(*[end(c).cast("double").alias(f"{name} {c}") for c in columns
                    for name, end in (("low", F.min), ("high", F.max))]).first()
    halvings = min(HALVINGS, 60 // len(columns))
    cells = []
    for c in columns:
        low, high = ends[f"low {c}"], ends[f"high {c}"]
        # One value, none, or not a number: a single cell.
        scale = 2.0 ** halvings / (high - low) if low is not None and high > low else 0.0
        place = F.floor((F.col(c).cast("double") - F.lit(low or 0.0)) * F.lit(scale))
        cells.append(F.least(place, F.lit(2 ** halvings - 1).cast("long")))
    number = F.lit(0).cast("long")
    for bit in reversed(range(halvings)):
        for cell in cells:
            number = F.shiftleft(number, 1).bitwiseOR(F.shiftright(cell, bit).bitwiseAND(F.lit(1)))
    return number


def prepare(df: DataFrame, features=FEATURES, label: str = LABEL,
            pattern: str = SIGNED_NUMBER, keep=()) -> DataFrame:
    """Keep features + label, number-gated cast to float, drop rows with a null.

    The default pattern accepts signs and exponents (southern and western
    coordinates are kept); pass ``STRICT_UNSIGNED`` for the unsigned-only gate."""
    cols = list(features) + [label]
    return (df.select(*keep, *[gated_cast(c, pattern, "float").alias(c) for c in cols])
              .dropna(subset=cols))


def split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42,
          key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Seeded split. With ``key`` the split is a hash of the key, so it does not
    depend on partitioning or row order (repeatable across runs and clusters)."""
    if key is None:
        return tuple(df.randomSplit([train_fraction, 1 - train_fraction], seed=seed))
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))
    cut = int(round(train_fraction * 10_000))
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def part_of(bucket, train_below: int):
    """'train' or 'test' by a bucket number that any engine can repeat."""
    return F.when(bucket < train_below, "train").otherwise("test")


def build_pipeline(features=FEATURES, label: str = LABEL, num_trees: int = 100,
                   max_depth: int = 10, seed: int = 42,
                   keep_node_ids: bool = False) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid="skip")
    forest = RandomForestRegressor(featuresCol="features", labelCol=label,
                                   numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                   cacheNodeIds=keep_node_ids, checkpointInterval=-1)
    return Pipeline(stages=[assembler, forest])


def train(df: DataFrame, features=FEATURES, label: str = LABEL, num_trees: int = 100,
          max_depth: int = 10, seed: int = 42, keep_node_ids: bool = False) -> PipelineModel:
    return build_pipeline(features, label, num_trees, max_depth, seed, keep_node_ids).fit(df)


def evaluate(model: PipelineModel, test: DataFrame, label: str = LABEL) -> DataFrame:
    """RMSE, MAE and R^2 in one distributed pass (one-row result)."""
    return metrics_of(model.transform(test), label)


def metrics_of(scored: DataFrame, label: str = LABEL) -> DataFrame:
    """RMSE, MAE and R^2 of rows with a ``prediction``, in one distributed pass."""
    p = scored.select(F.col(label).cast("double").alias("y"), F.col("prediction").alias("p"))
    s = p.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.pow(F.col("y") - F.col("p"), 2)).alias("sse"),
              F.sum(F.abs(F.col("y") - F.col("p"))).alias("sae"),
              F.sum("y").alias("sy"), F.sum(F.pow(F.col("y"), 2)).alias("syy"))
    sst = F.col("syy") - F.pow(F.col("sy"), 2) / F.col("n")
    return s.select(
        F.col("n").alias("test_rows"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (F.col("sae") / F.col("n")).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("sse"), sst)).alias("r2"))


def forest_prediction(spark: SparkSession, path: str, features=FEATURES) -> Column:
    """The saved forest at ``path`` as a Column: its prediction from the feature
    columns, equal to that of ``transform``, null if a feature is null.

    The nodes (bounded by trees and depth) go to the tasks as flat arrays, in which
    a batch of rows walks down each tree together, so a table can be scored, or a
    score be checked, without the model's own code."""
    stage = f"{path}/stages/*_RandomForestRegressor_*"
    node = F.col("nodeData")
    nodes = spark.read.parquet(f"{stage}/data").select(
        "treeID", node["id"].alias("id"), node["leftChild"].alias("l"),
        node["rightChild"].alias("r"), node["split"]["featureIndex"].alias("f"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("t"),
        node["prediction"].alias("p")).orderBy("treeID", "id").toPandas()
    depth = json.loads(spark.read.text(f"{stage}/metadata").first()[0])["paramMap"]["maxDepth"]
    walk = F.pandas_udf(_walker(nodes, int(depth)), "double")
    x = [F.col(c).cast("double") for c in features]
    usable = F.forall(F.array(*x), lambda v: v.isNotNull())
    return F.when(usable, walk(*x))


def _walker(nodes: pd.DataFrame, depth: int):
    """Function of the feature columns that walks the ``nodes``, sorted by tree and
    number: a tree's nodes are numbered from 0 without gaps."""
    number = np.arange(len(nodes))
    roots = number[nodes["id"].to_numpy() == 0]
    root = np.repeat(roots, np.diff(np.append(roots, len(nodes))))
    leaf = nodes["l"].to_numpy() < 0
    # A leaf is where it stays, on both sides.
    child = np.stack([np.where(leaf, number, root + nodes["l"].to_numpy()),
                      np.where(leaf, number, root + nodes["r"].to_numpy())], 1).ravel()
    feature = np.where(leaf, 0, nodes["f"].to_numpy()).astype("int64")
    threshold = np.where(leaf, np.inf, nodes["t"].to_numpy(dtype="float64", na_value=np.inf))
    value = nodes["p"].to_numpy()

    def walk(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy() for c in columns], 1).ravel()
        row = np.arange(len(columns[0])) * len(columns)
        total = np.zeros(len(row))
        for first in roots:  # summed in the order of the trees, as the model does
            at = np.full(len(row), first)
            for _ in range(depth):
                right = ~(x[row + feature[at]] <= threshold[at])
                at = child[2 * at + right]
            total += value[at]
        return pd.Series(total / len(roots))
    return walk


def importances(model: PipelineModel, features=FEATURES) -> DataFrame:
    """Feature importances by name, largest first (one row per feature)."""
    spark = SparkSession.getActiveSession()
    vals = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, vals)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
