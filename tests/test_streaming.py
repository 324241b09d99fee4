"""Streams equal the batch result on the same rows (availableNow)."""
import os

from pyspark.sql import functions as F

from forgeline.plans import catalog as cat
from forgeline.plans import views as v
from forgeline.streaming import pipelines as st

SF = "/root/testdata/sf0.001"


def test_clean_stream_equals_batch(spark):
    batch = sorted(cat.q_sensor_clean(spark, SF).collect())
    path = st.clean_stream(v.sensor_feed(st.sensor_stream(spark, SF, "events")), cat.SENSOR_LIMITS, cat.sensor_rule())
    stream = st.clean_table(spark, path, cat.SENSOR_LIMITS, cat.sensor_rule()) \
        .select("seq", "machine_id", "ts", "temperature", "pressure", "status_label")
    assert sorted(stream.collect()) == batch


def test_change_stream_equals_batch(spark):
    from forgeline.plans import streams, telemetry
    assert sorted(streams.q_change_stream(spark, SF).collect()) == sorted(telemetry.q_value_changes(spark, SF).collect())


def test_landing_is_partitioned_by_date(spark):
    path = st.land_raw(v.sensor_feed(st.sensor_stream(spark, SF, "events")))
    local = path.replace("file:", "")
    assert any(d.startswith("date=") for d in os.listdir(local))
    assert spark.read.parquet(path).count() == v.sensor_raw(spark, SF).count()


def test_stream_checkpoint_resumes_without_duplicates(spark):
    """A second run on the same checkpoint finds nothing new (exactly once)."""
    feed = st.sensor_stream(spark, SF, "events").select("event_id", "ts")
    out = st.stream_dir(spark, "resume")
    for _ in range(2):
        q = (feed.writeStream.format("parquet").option("checkpointLocation", f"{out}/_ck")
             .trigger(availableNow=True).start(f"{out}/data"))
        q.awaitTermination()
    assert spark.read.parquet(f"{out}/data").count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_quality_stream_windows(spark):
    from forgeline.plans import streams
    rows = streams.q_quality_stream(spark, SF).collect()
    assert sum(r["n_rows"] for r in rows) == v.sensor_raw(spark, SF).count()
    assert all(0.0 <= r["missing_ratio"] <= 1.0 for r in rows)
    assert F is not None


def test_score_stream_matches_batch(spark):
    """A fitted pipeline applied to a live feed scores like the batch."""
    from forgeline.operators import models as mo
    ev = spark.read.parquet(f"{SF}/events.parquet")
    train = ev.select("value", "user_id", (F.col("event_type") == "error").cast("int").alias("y"))
    model = mo.fit_classifier(train, ["value", "user_id"], "y", kind="logistic", max_iter=10)
    live = st.sensor_stream(spark, SF, "events").select("event_id", "value", "user_id")
    path = st.run_to_table(mo.score(model, live, "p").select("event_id", "p"), "scores")
    got = {r["event_id"]: r["p"] for r in spark.read.parquet(path).collect()}
    exp = {r["event_id"]: r["p"] for r in mo.score(model, ev.select("event_id", "value", "user_id"), "p").collect()}
    assert got.keys() == exp.keys() and all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_event_time_is_session_zone_independent(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 11, 3, 1, 30),)], "ts timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for tz in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(st.utc_wall(spark, st.event_time(spark, "ts")).alias("back"),
                          F.unix_micros(st.event_time(spark, "ts")).alias("us")).first()
            got.append((r["back"], r["us"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert len(set(got)) == 1 and got[0][0] == dt.datetime(2024, 11, 3, 1, 30)


def test_stream_source_reads_a_folder_of_part_files(spark, tmp_dir):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    path = st.run_to_table(st.sensor_stream(spark, tmp_dir, "events").select("event_id"), "parts")
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_history_on_landing_table_prunes_partitions(spark):
    import datetime as dt
    from forgeline.operators.history import read_history
    path = st.land_raw(v.sensor_feed(st.sensor_stream(spark, SF, "events")))
    landed = spark.read.parquet(path)
    start, end = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 7, 12)
    h = read_history(landed, "machine_id", "ts", start, end, 5, tiebreak="seq", date_col="date")
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    exp = (landed.where(F.col("ts").between(start, end)).groupBy("machine_id").count().collect())
    got = {r["machine_id"]: r["count"] for r in h.groupBy("machine_id").count().collect()}
    assert got == {r["machine_id"]: min(5, r["count"]) for r in exp}


def test_history_compaction(spark, tmp_dir):
    from forgeline.operators.history import compact_history, retain
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "ts", "value")
    compact_history(ev, "user_id", "ts", 3, "2 days", f"{tmp_dir}/hist", tiebreak="event_id")
    back = spark.read.parquet(f"{tmp_dir}/hist")
    assert back.count() == retain(ev, "user_id", "ts", 3, "2 days", tiebreak="event_id").count()
    assert back.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 3


def test_watermark_keeps_on_time_rows_across_batches(spark, tmp_dir):
    """Two micro-batches; the second carries rows a day behind the
    watermark.  Guaranteed: every row within the delay is counted in its
    window and late rows never leak into on-time windows.  (Spark does not
    guarantee that rows beyond the watermark are dropped in update mode.)"""
    import datetime as dt
    schema = "seq long, machine_id long, ts timestamp_ntz, temperature double, pressure double"
    d0 = dt.datetime(2024, 1, 10, 12, 0)
    on_time = [(i, 1, d0 + dt.timedelta(minutes=i), 20.0, 1.0) for i in range(10)]
    late = [(100 + i, 1, dt.datetime(2024, 1, 9, 1, 0), 20.0, 1.0) for i in range(5)]       # a day behind
    also_on_time = [(200, 1, d0 + dt.timedelta(minutes=30), 20.0, 1.0)]
    src = f"{tmp_dir}/feed"
    spark.createDataFrame(on_time, schema).coalesce(1).write.parquet(f"{src}/a")
    spark.createDataFrame(late + also_on_time, schema).coalesce(1).write.parquet(f"{src}/b")
    files = sorted(f"{src}/{p}/{f}" for p in ("a", "b") for f in os.listdir(f"{src}/{p}") if f.endswith(".parquet"))
    feed_dir = f"{tmp_dir}/arrive"
    os.makedirs(feed_dir)
    for i, f in enumerate(files):   # two files arrive one per micro-batch, in order
        os.link(f, f"{feed_dir}/feed-{i}.parquet")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed_dir))
    q = st.quality_stream(stream, "ts", {"temperature": (0.0, 100.0), "pressure": (0.0, 5.0)}, "1 day", "1 hour")
    path = st.run_batches(q, "late", st.write_latest_per_key(["window_start"]))
    got = {r["window_start"]: r["n_rows"] for r in st.read_latest(spark, path, ["window_start"]).collect()}
    assert got[dt.datetime(2024, 1, 10)] == 11
    assert set(got) <= {dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 9)}
