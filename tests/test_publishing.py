"""Idempotent epochs (K6, K8), incremental publish (K9, K10) and topics into bronze (ST1, W5)."""

import logging

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import gold, silver
from strata.plans import driver, medallion
from strata.session import scratch_path
from strata.sinks import landing_zone, publishing, writers
from strata.sources import topics
from tests.conftest import rows

TOPIC = "traffic-raw-events"
SCHEMA = schemas.TRAFFIC_SCHEMA


def frame(spark, *cities):
    t = spark.createDataFrame([(c, "t", 30.0) for c in cities], "city_name string, timestamp string, current_speed double")
    return writers.publish_frame(t, None)


def landed(spark, path):
    return [c for c, in rows(landing_zone.read_epochs(spark, path, TOPIC, SCHEMA), "city_name")]


def test_a_replayed_epoch_lands_once(spark):
    path = scratch_path(spark, "test-epochs")
    run = writers.publish_batch(path, writer="s")
    for epoch, cities in ((0, "AB"), (1, "C"), (1, "C"), (0, "AB")):
        run(frame(spark, *cities), epoch)
    assert landed(spark, path) == ["A", "B", "C"]
    assert rows(landing_zone.ledger(spark, path), "epoch", "route") == [("s-0", "landing"), ("s-1", "landing")]


def test_an_epoch_that_died_before_its_ledger_row_is_replaced(spark, monkeypatch):
    path = scratch_path(spark, "test-epochs")
    run = writers.publish_batch(path, writer="s")
    run(frame(spark, "A"), 0)
    with monkeypatch.context() as m:
        m.setattr(landing_zone, "record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run(frame(spark, "B", "C"), 1)
    assert landed(spark, path) == ["A"]  # its folder is there, its ledger row is not
    run(frame(spark, "B"), 1)
    assert landed(spark, path) == ["A", "B"]


def test_a_partial_broker_failure_lands_once_and_is_logged(spark, monkeypatch, caplog):
    path, broker = scratch_path(spark, "test-epochs"), []

    def half(frame, servers, epoch):
        broker.extend((epoch, r.key) for r in frame.orderBy("key").limit(1).collect())
        raise RuntimeError("broker went away")

    monkeypatch.setattr(writers, "write_topics", half)
    run = writers.publish_batch(path, "host:9092", writer="s")
    with caplog.at_level(logging.ERROR):
        for _ in range(2):
            run(frame(spark, "A", "B"), 0)
    assert landed(spark, path) == ["A", "B"] and broker == [("s-0", "A")]
    assert "broker went away" in caplog.text
    row = landing_zone.ledger(spark, path).first()
    assert row.route == "landing" and "broker went away" in row.failure
    monkeypatch.setattr(writers, "write_topics", lambda frame, servers, epoch: broker.append((epoch, "C")))
    assert writers.publish(frame(spark, "C"), path, "host:9092", "s-1") == "topics"
    header = "headers array<struct<key: string, value: binary>>"
    records = spark.createDataFrame([(k, [("epoch", e.encode())]) for e, k in broker] + [("D", None)], f"key string, {header}")
    assert rows(landing_zone.only_routed(records, spark, path), "key") == [("C",), ("D",)]


def test_publish_copies_only_what_changed(spark):
    base = scratch_path(spark, "test-publish")
    src, dst = f"{base}/src", f"{base}/dst"
    assert tuple(publishing.publish_layer(spark, src, dst, "x").first()) == ("x", 0, 0, 0, 0)
    t = spark.createDataFrame([("007", 1), ("B", 2), ("MIDDLE EAST", 3)], "city_name string, v int")
    writers.write_layer(t, src)
    first = publishing.publish_layer(spark, src, dst, "x").first()
    assert (first.total_files, first.uploaded_files, first.skipped_files) == (3, 3, 0) and first.bytes > 0
    again = publishing.publish_layer(spark, src, dst, "x").first()
    assert (again.total_files, again.uploaded_files, again.skipped_files) == (3, 0, 3)
    read = lambda: rows(publishing.read_as_text(spark, dst), "city_name", "v")
    assert read() == rows(t)  # "007" keeps its zeros
    writers.write_layer(t.where("v = 2").withColumn("v", F.lit(20)), src, replace="partitions")
    third = publishing.publish_layer(spark, src, dst, "x").first()
    assert (third.uploaded_files, third.skipped_files) == (1, 2) and ("B", 20) in read()
    writers.write_layer(t.where("v < 3"), src)  # a location is gone
    publishing.publish_layer(spark, src, dst, "x")
    assert read() == [("007", 1), ("B", 2)]


def test_publish_of_a_table_without_partitions(spark):
    base = scratch_path(spark, "test-publish")
    spark.range(5).write.parquet(f"{base}/src")
    assert publishing.publish_layer(spark, f"{base}/src", f"{base}/dst").first().skipped_files == 0
    assert publishing.publish_layer(spark, f"{base}/src", f"{base}/dst").first().uploaded_files == 0
    assert publishing.read_as_text(spark, f"{base}/dst").count() == 5


def records(spark, frame_, partitions=3):
    """Published rows as a broker hands them out: dealt to partitions by key, numbered within each."""
    from pyspark.sql import Window
    part = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition")
    order = Window.partitionBy("topic", "partition").orderBy("value")
    return (frame_.select("topic", part, "key", "value")
            .withColumn("offset", (F.row_number().over(order) - 1).cast("long")))


def test_offsets_of_one_topic_partition_are_dealt_to_many_tasks(spark):
    sent = spark.range(4000).select(F.lit(TOPIC).alias("topic"), F.when(F.col("id") < 3990, 0).otherwise(1).alias("partition"),
                                    F.lit("k").alias("key"), F.col("id").cast("string").alias("value"))
    sent = sent.unionByName(sent.where("value like '%0'"))  # some orders come twice
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = topics.with_offsets(sent, F.when(F.col("value") != "7", F.col("value").cast("long")))
        tasks = dealt.groupBy("partition", F.input_file_name().alias("f")).count().where("partition = 0").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 3 and max(r["count"] for r in tasks) < 2500  # one window over the topic partition had one task
    got = dealt.orderBy("partition", "offset").collect()
    for part in (0, 1):
        assert [r.offset for r in got if r.partition == part] == list(range(sum(r.partition == part for r in got)))
    assert [r.value for r in got] == ["7"] + sorted((r.value for r in got if r.value != "7"), key=int)  # null first


def test_topic_records_without_rows(spark):
    none = spark.createDataFrame([], "topic string, partition int, key string, value string")
    assert topics.with_offsets(none, F.col("value")).count() == 0


def test_two_cuts_of_a_topic_equal_one(spark, sf_small):
    base = scratch_path(spark, "test-topics")
    events = driver._flat_traffic(spark, sf_small)
    all_ = records(spark, writers.publish_frame(events, None))
    topics.append_bronze(spark, all_, f"{base}/one", SCHEMA)
    first = all_.where("offset < 40 or partition = 1")
    out = topics.append_bronze(spark, first.unionByName(first.limit(5)), f"{base}/two", SCHEMA)  # some come twice
    assert out["batch"] == 1 and out["rows"] == first.count()
    out = topics.append_bronze(spark, all_, f"{base}/two", SCHEMA)
    assert out["batch"] == 2 and out["rows"] == all_.count() - first.count()
    assert topics.append_bronze(spark, all_, f"{base}/two", SCHEMA)["skipped"]
    columns = [f.name for f in SCHEMA.fields]
    one, two = (topics.read_bronze(spark, f"{base}/{n}", SCHEMA).select(*columns) for n in ("one", "two"))
    assert one.count() == all_.count() > 100 and rows(one) == rows(two)
    ends = {(r.topic, r.partition): r.n for r in all_.groupBy("topic", "partition").agg(F.count("*").alias("n")).collect()}
    assert {(r.topic, r.partition): r.next_offset for r in topics.stored_offsets(spark, f"{base}/two").collect()} == ends


def test_an_append_that_died_is_replaced(spark, monkeypatch):
    base = scratch_path(spark, "test-topics")
    some = records(spark, frame(spark, *"ABCDEF"), 2)
    topics.append_bronze(spark, some.where("offset < 1"), base, SCHEMA)
    before = topics.read_bronze(spark, base, SCHEMA).count()
    write = topics.write_layer
    monkeypatch.setattr(topics, "write_layer", lambda df, path: (write(df, path), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        topics.append_bronze(spark, some, base, SCHEMA)
    monkeypatch.undo()
    assert topics.read_bronze(spark, base, SCHEMA).count() == before
    topics.append_bronze(spark, some, base, SCHEMA)
    assert [c for c, in rows(topics.read_bronze(spark, base, SCHEMA), "city_name")] == list("ABCDEF")


def test_full_run_reads_on_after_a_broker_publish(spark, sf_small, monkeypatch):
    """Two runs over halves of the events; the topics are the published rows so far."""
    taken, sent = {}, []
    monkeypatch.setattr(writers, "write_topics", lambda f, servers, epoch: sent.append(f))

    def read_topics(spark_, servers, names, starting):
        taken.setdefault(names[0], []).append(starting)
        everything = sent[0]
        for f in sent[1:]:
            everything = everything.unionByName(f)
        half = F.when(F.get_json_object("value", "$.poll_id").cast("long") % 2 == 0, 0).otherwise(1)
        out = everything.where(F.col("topic") == names[0])
        from pyspark.sql import Window
        order = Window.partitionBy("partition").orderBy(half, F.get_json_object("value", "$.poll_id").cast("long"))
        return (out.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(2)).cast("int"))
                .withColumn("offset", (F.row_number().over(order) - 1).cast("long")))

    layout = medallion.Layout(scratch_path(spark, "test-w5-topics"))
    traffic, weather = driver._flat_traffic(spark, sf_small), driver._flat_weather(spark, sf_small)
    for n in (0, 1):
        log = medallion.medallion_run(spark, layout, events=tuple(
            e.where(F.col("poll_id") % 2 == n) for e in (traffic, weather)),
            train=False, export=False, bootstrap_servers="host:9092", read_topics=read_topics)
        assert log[0]["route"] == "topics" and log[1]["batch"] == n + 1
    assert taken[TOPIC][0] == "earliest" and TOPIC in taken[TOPIC][1]
    got = writers.read_layer(spark, layout.analytics, schemas.ANALYTICS_SCHEMA)
    want = gold.kpi_rollup(gold.feature_mart(silver.silver_traffic(traffic), silver.silver_weather(weather)),
                           order_by=None)
    assert got.count() > 0 and rows(got.select(*want.columns)) == rows(want)
