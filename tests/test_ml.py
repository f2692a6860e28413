"""Models (X1-X6, P14-P17, K11) with small forests so the test stays quick."""

from pyspark.sql import functions as F

from strata.ml import ensembles, evaluation, models
from strata.operators import gold
from strata.plans import driver
from strata.session import scratch_path


def test_train_score_save_load(spark, sf_small):
    kpi = gold.kpi_rollup(driver._mart(spark, sf_small), order_by=None)
    assert set(models.add_missing_defaults(kpi).columns) >= {"avg_pressure", "avg_wind_speed", "day_of_week"}
    tr, te = models.split(kpi)
    a = {tuple(r) for r in tr.select("city_name", "hour", "is_weekend", "congestion_level").collect()}
    b = {tuple(r) for r in te.select("city_name", "hour", "is_weekend", "congestion_level").collect()}
    assert not (a & b) and len(a) + len(b) == kpi.count()
    speed = models.train_speed(kpi, num_trees=5, max_depth=4)
    aqi = models.train_aqi(kpi, max_iter=5, max_depth=3)
    assert set(speed.metrics) >= {"rmse", "mae", "r2_score"} and set(aqi.metrics) >= {"rmse", "r2_score"}
    mart = driver._mart(spark, sf_small)
    scored = models.score(mart, speed.model, aqi.model)
    assert scored.count() == mart.count()
    lo, hi = scored.selectExpr("min(derived_congestion_index)", "max(derived_congestion_index)").first()
    assert 0.0 <= lo <= hi <= 100.0
    path = scratch_path(spark, "test-model")
    models.save(speed.model, path)
    again = models.load(path).transform(models.add_missing_defaults(kpi).fillna(20.0))
    assert again.count() == kpi.count()


def made_kpi(spark, n=600):
    """KPI-like rows whose speed follows from the free-flow speed and the hour."""
    hour, free = F.pmod(F.col("id"), F.lit(24)), F.pmod(F.xxhash64("id"), F.lit(40)) + 30.0
    return spark.range(n).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("city_name"), hour.cast("int").alias("hour"),
        F.lit(0).alias("is_weekend"), F.lit("Low").alias("congestion_level"), free.alias("avg_free_flow_speed"),
        (free - F.when(hour.between(8, 18), 20.0).otherwise(5.0)).alias("avg_current_speed"),
        F.lit(25.0).alias("avg_temperature"), F.when(F.col("id") % 9 > 0, 60.0).alias("avg_humidity"),
        (F.pmod(F.xxhash64("id"), F.lit(5)) + 1.0).alias("avg_aqi"))


def test_quality_with_the_label_left_out_and_node_tables(spark):
    kpi = made_kpi(spark)
    speed, aqi = models.train_speed(kpi, num_trees=15, max_depth=6), models.train_aqi(kpi, max_iter=8, max_depth=3)
    assert models.SPEED_LABEL not in speed.model.stages[0].getInputCols()
    assert speed.metrics["r2_score"] > 0.9 and speed.metrics["train_rows"] + speed.metrics["test_rows"] == 600
    for trained, label in ((speed, "speed"), (aqi, "aqi")):
        nodes = ensembles.node_table(trained.model, scratch_path(spark, "test-nodes"), spark)
        by_tree = {r.tree: r for r in nodes.groupBy("tree").agg(
            F.count("*").alias("n"), F.count_if(F.col("left") < 0).alias("leaves")).collect()}
        assert all(r.n == 2 * r.leaves - 1 for r in by_tree.values())  # every inner node has two children
        rows_ = models.feature_rows(kpi, models.SPEED_FEATURES + models.AQI_FEATURES, models.AQI_LABEL)
        rows_ = rows_.unionByName(rows_.limit(3).withColumn("avg_aqi", F.lit(None).cast("double")))
        both = ensembles.predict(trained.model.transform(rows_), nodes, trained.model, "by_nodes")
        off = F.abs(F.col(f"{label}_prediction") - F.col("by_nodes"))
        most, n = both.agg(F.max(off), F.count(off)).first()
        assert most < 1e-9 and n == 603  # the sum over trees may differ in its last bits


def test_trees_are_walked_a_batch_at_a_time(spark):
    import time

    import numpy as np
    kpi = made_kpi(spark)
    trained = models.train_speed(kpi, num_trees=5, max_depth=6)
    nodes = ensembles.node_table(trained.model, scratch_path(spark, "test-nodes"), spark)
    scored = ensembles.predict(models.feature_rows(kpi), nodes, trained.model, "by_nodes")
    assert "ArrowEvalPython" in scored._jdf.queryExecution().executedPlan().toString()  # was a walk of each row by itself
    found = [r.asDict() for r in nodes.orderBy("node").collect()]
    x = np.random.default_rng(1).normal(size=(100_000, 6))
    x[::7, 0], x[::5, 4] = np.nan, np.nan  # a missing feature goes right
    start = time.process_time()
    got = ensembles.walker(found, 6, 5)(x)
    assert time.process_time() - start < 10  # the walk of each row by itself took about a millisecond a row
    roots = sorted({r["tree"]: r for r in reversed(found)}.items())
    for i in range(0, 100_000, 997):
        total = 0.0
        for _, at in roots:
            while at["left"] >= 0:
                at = found[at["left"] if x[i, at["feature"]] <= at["threshold"] else at["right"]]
            total += at["prediction"] * 1.0
        assert got[i] == total / 5
    assert len(ensembles.walker(found, 6, 5)(x[:0])) == 0


def test_metrics_of_many_models_in_one_pass(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    rows_ = [(m, float(i % 7) * m, float(i % 7) * m + (i % 3) - 1) for m in (1, 2, 3) for i in range(50)]
    scored = spark.createDataFrame(rows_, "model int, label double, prediction double")
    extra = spark.createDataFrame([(4, 2.0, 3.0), (5, 1.0, None), (6, 2.0, 2.0), (6, 2.0, 1.0)], scored.schema)
    got = {r.model: r for r in evaluation.regression_metrics(scored.unionByName(extra)).collect()}
    for m in (1, 2, 3):
        part = scored.where(F.col("model") == m)
        for name in ("rmse", "mae", "r2"):
            want = RegressionEvaluator(metricName=name).evaluate(part)
            assert abs(got[m][{"r2": "r2_score"}.get(name, name)] - want) < 1e-4
    assert (got[4].rows, got[4].rmse, got[4].r2_score) == (1, 1.0, 1.0)
    assert 5 not in got and got[6].r2_score is None
    none = evaluation.regression_metrics(scored.limit(0), by=()).first()
    assert (none.rows, none.rmse) == (0, None)


def test_scaling_and_split_do_not_depend_on_partitioning(spark):
    kpi = models.feature_rows(made_kpi(spark))
    columns = ["avg_free_flow_speed", "avg_temperature", "hour"]
    scaled = evaluation.scale(kpi, columns, evaluation.scaler(kpi, columns))
    m, s, constant = scaled.agg(F.avg("hour"), F.stddev_samp("hour"), F.max(F.abs("avg_temperature"))).first()
    assert abs(m) < 1e-9 and abs(s - 1) < 1e-9 and constant == 0.0  # a column that does not vary
    parts = [{r.city_name for r in models.split(kpi.repartition(n))[1].collect()} for n in (1, 7)]
    assert parts[0] == parts[1] and 60 < len(parts[0]) < 180
