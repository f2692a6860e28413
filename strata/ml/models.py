"""Regression models over the gold tables.

Training data is the KPI rollup (one row per location, clock hour, weekend flag and level),
so it stays small however large the mart grows; scoring is a narrow ``transform`` over any
batch or streaming frame, with no shuffle.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.metrics import predicted_congestion_index
from strata.functions.rounding import round_half_even
from strata.ml import ensembles
from strata.ml.evaluation import regression_metrics, split_bucket

# Model features and labels.
SPEED_FEATURES = ("avg_current_speed", "avg_free_flow_speed", "avg_temperature", "avg_humidity",
                  "avg_aqi", "hour", "day_of_week")
SPEED_LABEL = "avg_current_speed"
AQI_FEATURES = ("avg_temperature", "avg_humidity", "avg_pressure", "avg_wind_speed",
                "avg_current_speed", "hour")
AQI_LABEL = "avg_aqi"

# Columns the analytics table may lack.
CONSTANT_DEFAULTS = {"avg_pressure": 1013.0, "avg_wind_speed": 4.2, "day_of_week": 3}
FREE_FLOW_FACTOR = 1.3
# Feature / label null fills.
SPEED_FILL = 20.0
AQI_FILL = 2.0
# Scoring defaults.
SCORING_DEFAULTS = {"pressure": 1013.0, "wind_speed": 4.0, "day_of_week": 3}

SPLIT_SEED = 42
TRAIN_PERCENT = 80
ROW_KEYS = ("city_name", "hour", "is_weekend", "congestion_level")


class Trained(NamedTuple):
    model: PipelineModel
    metrics: dict


def add_missing_defaults(df: DataFrame) -> DataFrame:
    """Fill absent columns (free-flow speed derives from current speed)."""
    cols = {}
    if "avg_free_flow_speed" not in df.columns and "avg_current_speed" in df.columns:
        cols["avg_free_flow_speed"] = F.col("avg_current_speed") * F.lit(FREE_FLOW_FACTOR)
    for name, value in CONSTANT_DEFAULTS.items():
        if name not in df.columns:
            cols[name] = F.lit(value)
    return df.withColumns(cols) if cols else df


def split(df: DataFrame, keys: Sequence[str] = ROW_KEYS, train_percent: int = TRAIN_PERCENT,
          seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """A hash split on the row key; unlike ``randomSplit`` it does not depend on the
    partitioning, so reruns and resized clusters give the same sets."""
    marked = df.withColumn("__bucket", split_bucket([k for k in keys if k in df.columns], seed))
    return (marked.filter(F.col("__bucket") < train_percent).drop("__bucket"),
            marked.filter(F.col("__bucket") >= train_percent).drop("__bucket"))


def feature_rows(df: DataFrame, features: Sequence[str] = SPEED_FEATURES, label: str = SPEED_LABEL,
                 fill: float = SPEED_FILL) -> DataFrame:
    """P14 + P15 + X1: the analytics rows with every feature and the label present and filled."""
    columns = list(dict.fromkeys([*features, label]))
    return add_missing_defaults(df).fillna(fill, subset=columns)


def _pipeline(features: Sequence[str], label: str, estimator, prefix: str) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol=f"{prefix}_raw", handleInvalid="keep")
    scaler = StandardScaler(inputCol=f"{prefix}_raw", outputCol=f"{prefix}_features", withMean=True, withStd=True)
    estimator = estimator.setFeaturesCol(f"{prefix}_features").setLabelCol(label).setPredictionCol(f"{prefix}_prediction")
    return Pipeline(stages=[assembler, scaler, estimator])


def _metrics(pred: DataFrame, label: str, prediction: str, names: Sequence[str], train: DataFrame) -> dict:
    """X6 on the test set, in one job with the row counts of both sets; R2 is 1.0 when the test set has at most one row."""
    row = (regression_metrics(pred, by=(), label=label, prediction=prediction)
           .withColumn("train_rows", train.agg(F.count(F.lit(1))).scalar()).first())
    out = {{"r2": "r2_score"}.get(n, n): row[{"r2": "r2_score"}.get(n, n)] for n in names}
    return out | {"train_rows": row.train_rows, "test_rows": row.rows}


FIT_PARTITIONS = 8


def _materialize(df: DataFrame, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Cut the lineage before an iterative fit: the trees, the scaler and the metrics then read
    the checkpointed table in the shared checkpoint folder instead of re-running the gold job.

    Bagging depends on how rows are dealt, so they are dealt by a hash of the row into a fixed
    number of partitions, whatever their count.
    """
    from strata.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.repartition(partitions, *df.columns).sortWithinPartitions(*df.columns).checkpoint(eager=True)


def train_speed(df: DataFrame, drop_label_from_features: bool = True, num_trees: int = 100,
                max_depth: int = 12, seed: int = 42) -> Trained:
    """Random forest for the current-speed average.

    ``drop_label_from_features=False`` reproduces the preset exactly, where the label is also a
    feature (and the score is meaningless).
    """
    feats = [f for f in SPEED_FEATURES if not (drop_label_from_features and f == SPEED_LABEL)]
    data = _materialize(feature_rows(df, feats, SPEED_LABEL, SPEED_FILL))
    train, test = split(data)
    rf = RandomForestRegressor(numTrees=num_trees, maxDepth=max_depth, seed=seed, featureSubsetStrategy="all")
    model = _pipeline(feats, SPEED_LABEL, rf, "speed").fit(train)
    metrics = _metrics(model.transform(test), SPEED_LABEL, "speed_prediction", ("rmse", "mae", "r2"), train)
    return Trained(model, metrics)


def train_aqi(df: DataFrame, max_iter: int = 120, step_size: float = 0.05, max_depth: int = 6,
              seed: int = 42) -> Trained:
    """Gradient-boosted trees for the AQI average."""
    data = _materialize(feature_rows(df, AQI_FEATURES, AQI_LABEL, AQI_FILL))
    train, test = split(data)
    gbt = GBTRegressor(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth, seed=seed)
    model = _pipeline(AQI_FEATURES, AQI_LABEL, gbt, "aqi").fit(train)
    metrics = _metrics(model.transform(test), AQI_LABEL, "aqi_prediction", ("rmse", "r2"), train)
    return Trained(model, metrics)


def metrics_frame(spark, trained: dict[str, Trained]) -> DataFrame:
    rows = [(name, metric, None if v is None else float(v))
            for name, t in trained.items() for metric, v in sorted(t.metrics.items())]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def score(df: DataFrame, speed_model: PipelineModel, aqi_model: PipelineModel,
          current_speed: str = "current_speed", free_flow_speed: str = "free_flow_speed",
          temperature: str = "temperature", humidity: str = "humidity", aqi: str = "aqi",
          hour: str = "hour", defaults: dict = SCORING_DEFAULTS,
          nodes: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """X5 + P16 + P17: predicted speed and AQI (one decimal) and the derived congestion index.

    Row columns map onto the model features; pressure, wind speed and day of week come from
    the row when present, else from the scoring defaults. With ``nodes``, the node tables of the two models
    (``ensembles.node_table``), the trees are walked in column expressions instead of ``transform``.
    """
    def pick(name: str):
        return F.col(name) if name in df.columns else F.lit(defaults[name])

    feats = df.withColumns({
        "avg_current_speed": F.col(current_speed).cast("double"),
        "avg_free_flow_speed": F.col(free_flow_speed).cast("double"),
        "avg_temperature": F.col(temperature).cast("double"),
        "avg_humidity": F.col(humidity).cast("double"),
        "avg_aqi": F.col(aqi).cast("double"),
        "avg_pressure": pick("pressure").cast("double"),
        "avg_wind_speed": pick("wind_speed").cast("double"),
        "day_of_week": pick("day_of_week"),
        "hour": F.col(hour),
    })
    if nodes:
        scored = ensembles.predict(feats, nodes[0], speed_model, "speed_prediction")
        scored = ensembles.predict(scored, nodes[1], aqi_model, "aqi_prediction")
    else:
        scored = aqi_model.transform(speed_model.transform(feats))
    out = scored.withColumns({
        "predicted_speed": round_half_even(F.col("speed_prediction"), 1),
        "predicted_aqi": round_half_even(F.col("aqi_prediction"), 1),
        "derived_congestion_index": predicted_congestion_index(F.col("speed_prediction"), F.col(free_flow_speed)),
    })
    helper = [c for c in out.columns if c.startswith(("speed_", "aqi_")) and c not in df.columns]
    helper += [c for c in ("avg_current_speed", "avg_free_flow_speed", "avg_temperature", "avg_humidity",
                           "avg_aqi", "avg_pressure", "avg_wind_speed") if c not in df.columns]
    return out.drop(*helper)


def save(model: PipelineModel, path: str) -> None:
    """K11."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """K11."""
    return PipelineModel.load(path)
