"""Tree ensembles as node tables.

A fitted forest or boosted ensemble is written out as one row per node. Scoring takes the table as arrays and walks the
trees in a column expression, a level at a time for a whole Arrow batch of rows, so it runs over any frame, needs no model
object on the executors and can be held against the pipeline's own ``transform``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NODES = ("tree int, node int, feature int, threshold double, left int, right int, prediction double, weight double")


def node_table(model: PipelineModel, path: str, spark: SparkSession | None = None) -> DataFrame:
    """Write the ensemble at the end of ``model`` below ``path`` as rows ``NODES`` and return the table.

    ``node`` counts over all trees, in the order in which the model was saved; ``left`` and ``right`` are node
    numbers too, -1 at a leaf. A row goes left if its feature is at most ``threshold``. ``weight`` is the tree's.
    """
    spark, ensemble = spark or SparkSession.active(), model.stages[-1]
    ensemble.write().overwrite().save(f"{path}/ensemble")
    data = spark.read.parquet(f"{path}/ensemble/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.read.parquet(f"{path}/ensemble/treesMetadata").toDF("tree", "described", "weight")
    before = Window.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    trees = (data.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))  # one row per tree
             .select("tree", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))

    def number(child):
        return F.when(F.col(child) < 0, F.lit(-1)).otherwise(F.col(child) + F.col("start")).cast("int")

    rows = data.join(trees, "tree").join(weights, "tree").select(
        "tree", (F.col("id") + F.col("start")).cast("int").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        number("leftChild").alias("left"), number("rightChild").alias("right"), "prediction", "weight")
    rows.write.mode("overwrite").parquet(f"{path}/nodes")
    return spark.read.schema(NODES).parquet(f"{path}/nodes")


def scaled_vector(model: PipelineModel):
    """The pipeline's feature vector as an array column, scaled as its scaler does."""
    assembler, scaler = model.stages[0], model.stages[1]
    values = []
    for name, mean, std in zip(assembler.getInputCols(), scaler.mean, scaler.std):
        factor = 1.0 / float(std) if std else 0.0
        values.append((F.coalesce(F.col(name).cast("double"), F.lit(float("nan"))) - F.lit(float(mean))) * F.lit(factor))
    return F.array(*values)


def walker(rows: list, depth: int, trees: int | None):
    """The function from feature rows (a matrix) to predictions: the weighted sum of the trees' leaves in the order of the
    trees, or their average over ``trees``. A leaf leads to itself. Tasks need only numpy for it, not this package."""
    def column(name, kind):
        return np.array([r[name] or 0 for r in rows], kind)

    here, leaf = np.arange(len(rows)), column("left", np.int64) < 0
    left, right = (np.where(leaf, here, column(c, np.int64)) for c in ("left", "right"))
    feature = np.where(leaf, 0, column("feature", np.int64))
    threshold, prediction = column("threshold", np.float64), column("prediction", np.float64)
    first: dict = {}
    for r in rows:
        first.setdefault(r["tree"], (r["node"], r["weight"]))
    roots = [first[t] for t in sorted(first)]

    def walk(x: np.ndarray) -> np.ndarray:
        total, values, row = np.zeros(len(x)), x.ravel(), np.arange(len(x)) * x.shape[1]
        for root, weight in roots:
            at = np.full(len(x), root)
            for _ in range(depth):
                below = np.where(values[row + feature[at]] <= threshold[at], left[at], right[at])
                if np.array_equal(below, at):
                    break
                at = below
            total += prediction[at] * weight
        return total / trees if trees else total

    return walk


def predict(df: DataFrame, nodes: DataFrame, model: PipelineModel, output: str) -> DataFrame:
    """Adds ``output``: the ensemble's prediction by ``nodes``. Of ``model`` only the feature names, the scaling, the
    depth and the kind of ensemble are read."""
    ensemble = model.stages[-1]
    averaged = isinstance(ensemble, RandomForestRegressionModel)
    rows = [r.asDict() for r in nodes.orderBy("node").collect()]  # bounded by the model: at most trees x 2 ** (depth + 1)
    walk = walker(rows, max(int(ensemble.getOrDefault("maxDepth")), 1), len(ensemble.treeWeights) if averaged else None)
    width = len(model.stages[0].getInputCols())

    @F.arrow_udf("double")
    def walked(vectors: pa.Array) -> pa.Array:
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        return pa.array(walk(values.reshape(len(vectors), width)), pa.float64())

    return df.withColumn(output, walked(scaled_vector(model)))
