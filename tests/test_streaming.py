import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from temblor.operators import flatten_window, window_avg
from temblor.schemas import EVENT
from temblor.sources import decode, read_store, upsert_days
from temblor.streaming import start_upsert, text_stream


def _write_msgs(folder, name, rows, mtime=None):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")
    if mtime:
        os.utime(p, (mtime, mtime))


def _ms(h, m):
    return int(dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc).timestamp() * 1000)


def _avg_stream(spark, src, watermark=None):
    ev = decode(text_stream(spark, src, max_files=1), EVENT)
    ev = ev.withColumn("time", F.col("time_ts"))
    return flatten_window(window_avg(ev, watermark=watermark))


def test_upsert_sink_update_mode_one_row_per_window(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    _write_msgs(src, "a.json", [{"id": "1", "magnitude": 3.0, "time": _ms(0, 5)}], 1000)
    _write_msgs(src, "b.json", [{"id": "2", "magnitude": 5.0, "time": _ms(0, 10)}], 2000)
    _write_msgs(src, "c.json", [{"id": "3", "magnitude": 9.0, "time": _ms(0, 50)}], 3000)
    q = start_upsert(_avg_stream(spark, src), out, ["window_start"], ck, trigger="availableNow")
    q.awaitTermination(120)
    res = {r.window_start.minute: r.avg_magnitude for r in read_store(spark, out).collect()}
    assert res == {0: 4.0, 30: 9.0}


KEYED = "k timestamp, v double"


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _rows(spark, out):
    return sorted((r.k.day, r.v) for r in read_store(spark, out).collect())


def _part_files(out):
    return {d: sorted(f for f in os.listdir(os.path.join(out, d)) if f.startswith("part-"))
            for d in sorted(os.listdir(out)) if d.startswith("event_day=")}


def test_upsert_replay_is_idempotent(spark, tmp_dir):
    out = os.path.join(tmp_dir, "store")
    fn = upsert_days(out, ["k"])
    assert read_store(spark, out) is None
    b1 = spark.createDataFrame([(_at(1), 1.0), (_at(2), 2.0)], KEYED)
    b2 = spark.createDataFrame([(_at(2), 5.0), (_at(3), 3.0)], KEYED)
    fn(b1, 0)
    fn(b2, 1)
    fn(b2, 1)  # the same epoch replayed after a crash before commit
    assert _rows(spark, out) == [(1, 1.0), (2, 5.0), (3, 3.0)]
    fn(spark.createDataFrame([], KEYED), 2)
    assert _rows(spark, out) == [(1, 1.0), (2, 5.0), (3, 3.0)]


def test_upsert_rewrites_only_the_days_of_a_batch(spark, tmp_dir, monkeypatch):
    from temblor.sources import sinks
    out = os.path.join(tmp_dir, "store")
    fn = upsert_days(out, ["k"])
    fn(spark.createDataFrame([(_at(d, h), float(d)) for d in range(1, 21) for h in (0, 7)],
                             KEYED), 0)
    before = _part_files(out)
    looked = []
    real = sinks.path_exists
    monkeypatch.setattr(sinks, "path_exists", lambda s, p: looked.append(p) or real(s, p))
    fn(spark.createDataFrame([(_at(5), 50.0)], KEYED), 1)
    after = _part_files(out)
    assert looked == [f"{out}/event_day=2024-01-05"]  # nothing else is listed
    assert {d for d in after if after[d] != before[d]} == {"event_day=2024-01-05"}
    assert [f for f in os.listdir(out) if not f.startswith(("event_day=", "_SUCCESS", "._S"))] == []
    rows = _rows(spark, out)
    assert len(rows) == 40 and (5, 50.0) in rows and (5, 5.0) in rows


def test_upsert_batch_that_fails_leaves_the_store_as_it_was(spark, tmp_dir):
    out = os.path.join(tmp_dir, "store")
    fn = upsert_days(out, ["k"])
    fn(spark.createDataFrame([(_at(1), 1.0), (_at(1, 5), 2.0)], KEYED), 0)
    bad = spark.createDataFrame([(_at(1), 9.0)], KEYED).select(
        "k", F.when(F.rand() >= 0, F.raise_error(F.lit("no"))).otherwise(F.col("v"))
        .cast("double").alias("v"))
    with pytest.raises(Exception, match="no"):
        fn(bad, 1)
    assert _rows(spark, out) == [(1, 1.0), (1, 2.0)]


def test_upsert_days_follow_utc_in_any_zone(spark, tmp_dir):
    out = os.path.join(tmp_dir, "store")
    fn = upsert_days(out, ["k"])
    late = spark.sql("SELECT timestamp'2024-01-01 23:30:00Z' AS k, 1D AS v")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for i, z in enumerate(("UTC", "Asia/Tokyo", "America/Los_Angeles")):
            spark.conf.set("spark.sql.session.timeZone", z)
            fn(late.select("k", F.lit(float(i)).alias("v")), i)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert list(_part_files(out)) == ["event_day=2024-01-01"]
    assert [r.v for r in read_store(spark, out).collect()] == [2.0]


def test_upsert_keys_without_time_and_null_keys(spark, tmp_dir):
    out = os.path.join(tmp_dir, "store")
    fn = upsert_days(out, ["n"])
    fn(spark.createDataFrame([(1, 1.0), (None, 2.0)], "n int, v double"), 0)
    fn(spark.createDataFrame([(None, 3.0)], "n int, v double"), 1)
    assert sorted(r.v for r in read_store(spark, out).collect()) == [1.0, 3.0]
    timed = os.path.join(tmp_dir, "timed")
    fn = upsert_days(timed, ["k"])
    fn(spark.createDataFrame([(None, 1.0), (_at(1), 2.0)], KEYED), 0)
    fn(spark.createDataFrame([(None, 4.0)], KEYED), 1)
    assert sorted(r.v for r in read_store(spark, timed).collect()) == [2.0, 4.0]


def test_restart_on_same_checkpoint(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    _write_msgs(src, "a.json", [{"id": "1", "magnitude": 2.0, "time": _ms(1, 0)}], 1000)
    q = start_upsert(_avg_stream(spark, src), out, ["window_start"], ck, trigger="availableNow")
    q.awaitTermination(120)
    _write_msgs(src, "b.json", [{"id": "2", "magnitude": 4.0, "time": _ms(1, 1)}], 2000)
    q = start_upsert(_avg_stream(spark, src), out, ["window_start"], ck, trigger="availableNow")
    q.awaitTermination(120)
    rows = read_store(spark, out).collect()
    assert len(rows) == 1 and rows[0].avg_magnitude == 3.0


def test_watermark_drops_late_rows(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    _write_msgs(src, "1.json", [{"id": "1", "magnitude": 3.0, "time": _ms(0, 5)}], 1000)
    _write_msgs(src, "2.json", [{"id": "2", "magnitude": 5.0, "time": _ms(5, 0)}], 2000)
    _write_msgs(src, "3.json", [{"id": "3", "magnitude": 1.0, "time": _ms(6, 0)}], 3000)
    _write_msgs(src, "4.json", [{"id": "4", "magnitude": 100.0, "time": _ms(0, 6)}], 4000)
    q = start_upsert(_avg_stream(spark, src, watermark="1 hour"), out, ["window_start"], ck,
                     trigger="availableNow")
    q.awaitTermination(120)
    res = {(r.window_start.hour, r.window_start.minute): r.avg_magnitude
           for r in read_store(spark, out).collect()}
    assert res[(0, 0)] == 3.0  # the late 100.0 came after the watermark passed 04:00


def test_pair_join_state_is_bounded(spark, tmp_dir):
    """Six time-ordered files, one per batch: with the watermark the pair
    join's state must stay near a couple of days of events, not grow with
    the whole input."""
    import time as _t

    from temblor.operators import proximity_pairs
    from temblor.plans import driver
    from temblor.plans.streams import EVENTS_SCHEMA

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    src = os.path.join(tmp_dir, "ev")
    days = [("2024-01-01", "2024-01-06"), ("2024-01-06", "2024-01-11"),
            ("2024-01-11", "2024-01-16"), ("2024-01-16", "2024-01-21"),
            ("2024-01-21", "2024-01-26"), ("2024-01-26", "2024-02-01")]
    for i, (lo, hi) in enumerate(days):
        part = ev.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
                         & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(src, f"p{i}"))
        _t.sleep(1.1)  # distinct modification times keep the file order
    stream = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    q = driver.quakes_from_events(stream).withColumn("event_ts", F.col("time").cast("timestamp"))
    pairs = proximity_pairs(q, length="1 day", watermark="1 day", event_time="event_ts")
    query = (pairs.writeStream.format("noop")
             .option("checkpointLocation", os.path.join(tmp_dir, "ck"))
             .trigger(availableNow=True).start())
    query.awaitTermination(300)
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress
              if p.get("stateOperators")]
    n = ev.count()
    print("state rows per batch:", totals, "events:", n)
    assert totals and max(totals) < 0.5 * 6 * n  # unbounded would reach 6 rows per event
    assert totals[-1] < 0.25 * 6 * n


def test_fresh_checkpoint_on_a_full_store_loses_nothing(spark, tmp_dir):
    src, out = (os.path.join(tmp_dir, x) for x in ("src", "out"))
    for i in range(5):
        _write_msgs(src, f"{i}.json", [{"id": str(i), "magnitude": float(i),
                                        "time": _ms(i, 0)}], 1000 + i)
    start_upsert(_avg_stream(spark, src), out, ["window_start"], os.path.join(tmp_dir, "ck"),
                 trigger="availableNow").awaitTermination()
    src2 = os.path.join(tmp_dir, "src2")
    _write_msgs(src2, "n.json", [{"id": "9", "magnitude": 50.0, "time": _ms(0, 1)},
                                 {"id": "8", "magnitude": 7.0, "time": _ms(9, 0)}], 9000)
    start_upsert(_avg_stream(spark, src2), out, ["window_start"], os.path.join(tmp_dir, "new"),
                 trigger="availableNow").awaitTermination()
    assert {r.window_start.hour: r.avg_magnitude for r in read_store(spark, out).collect()} == {
        0: 50.0, 1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 9: 7.0}


def test_files_are_landed_in_event_time_order(spark, tmp_dir):
    from temblor.sources import land_in_order, order_files
    path = os.path.join(tmp_dir, "feed")
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("t"))
    n = land_in_order(rows, path, "t", rows_per_file=100)
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert n == len(files) == 10
    times = [os.stat(os.path.join(path, f)).st_mtime_ns for f in files]
    assert times == sorted(set(times))
    spans = [spark.read.parquet(os.path.join(path, f)).agg(F.min("t"), F.max("t")).first()
             for f in files]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    os.utime(os.path.join(path, files[0]))  # out of order: put right again
    assert order_files(spark, path) == 10
    times = [os.stat(os.path.join(path, f)).st_mtime_ns for f in files]
    assert times == sorted(set(times))


def _events_sql(con, sf):
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")


def test_streams_read_folder_tables_in_many_batches(spark, tmp_dir, monkeypatch):
    """A table that is a folder of part files, landed as many files, one file a
    batch, equals the static result of every stream query."""
    import duckdb
    from temblor.plans import driver, streams
    sf = os.path.join(tmp_dir, "sf")
    (spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6, "event_id")
     .write.parquet(f"{sf}/events.parquet"))
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 200)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 1)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")
    for key in ("stream_window_avg", "stream_count_gt", "stream_window_metrics",
                "stream_raw_archive", "stream_all_metrics", "stream_feed_status",
                "stream_late_rows", "stream_paced_replay"):
        got = streams.QUERIES[key](spark, sf)
        want = con.execute(f"SELECT count(*) FROM ({streams.ORACLE_SQL[key]})").fetchone()[0]
        assert got.count() == want > 0, key
    got = {r.window_start: r.avg_magnitude for r in streams.stream_window_avg(spark, sf).collect()}
    want = {r[0]: r[1] for r in con.execute(
        f"SELECT window_start, avg_magnitude FROM ({driver.S1_SQL})").fetchall()}
    assert got == want


@pytest.fixture(scope="module")
def year_of_events(spark, tmp_path_factory):
    """Events spread over a year, in many files of no order."""
    sf = str(tmp_path_factory.mktemp("year"))
    (spark.read.parquet("/root/testdata/sf0.01/events.parquet").where("event_id < 3000")
     .withColumn("ts", F.expr("ts + make_dt_interval(hour(ts) % 12 * 30)"))
     .repartition(20, "event_id").write.parquet(f"{sf}/events.parquet"))
    return sf


def test_streams_keep_every_row_of_a_year_in_shuffled_files(spark, year_of_events, monkeypatch):
    """The watermark is hours, the files of the table each hold times of the
    whole year: landed in order, no row is late."""
    import duckdb
    from temblor.plans import streams
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 250)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 4)
    con = duckdb.connect()
    _events_sql(con, year_of_events)
    for key, columns in (("stream_window_avg", "window_start, avg_magnitude"),
                         ("stream_all_metrics", "minutes, window_start, num_events")):
        got = streams.QUERIES[key](spark, year_of_events).selectExpr(
            *columns.split(", ")).collect()
        want = con.execute(f"SELECT {columns} FROM ({streams.ORACLE_SQL[key]})").fetchall()
        assert sorted(map(tuple, got)) == sorted(want) and want, key


def test_pair_stream_of_a_year_frees_its_state(spark, tmp_dir, year_of_events, monkeypatch):
    import duckdb
    from temblor.plans import streams
    from temblor.streaming import runner
    progress = []
    real = runner.start_append

    def start(df, path, checkpoint, **kw):
        query = real(df, path, checkpoint, **kw)
        query.awaitTermination()
        progress.extend(query.recentProgress)
        return query
    monkeypatch.setattr(runner, "start_append", start)
    got = streams.stream_proximity_pairs(spark, year_of_events, files_per_batch=1,
                                         rows_per_file=250).count()
    con = duckdb.connect()
    _events_sql(con, year_of_events)
    want = con.execute(f"SELECT count(*) FROM ({streams.ORACLE_SQL['stream_proximity_pairs']})"
                       ).fetchone()[0]
    assert got == want > 0
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    # An event is six rows of state: 18,000 of them if nothing were freed.
    assert len(kept) >= 12 and max(kept) < 4_500, kept
    assert max(kept[6:]) <= 1.2 * max(kept[:6]), kept


def test_pair_stream_as_registered_holds_few_files_as_state(spark, year_of_events, monkeypatch):
    """Without parameters, many files are not one batch whose events are all state at once."""
    from temblor.plans import streams
    from temblor.streaming import runner
    kept = []
    real = runner.start_append

    def start(df, path, checkpoint, **kw):
        query = real(df, path, checkpoint, **kw)
        query.awaitTermination()
        kept.extend(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress
                    if p["stateOperators"])
        return query
    monkeypatch.setattr(runner, "start_append", start)
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 500)
    got = streams.QUERIES["stream_proximity_pairs"](spark, year_of_events)
    static = streams.driver.proximity_jump_pairs(spark, year_of_events)
    assert sorted(map(str, got.collect())) == sorted(map(str, static.collect())) != []
    assert 0 < max(kept) < 6_000, kept  # all 3,000 events, five rows each, before


def test_restart_key_repeats_the_batch_it_failed_on(spark, monkeypatch):
    import duckdb
    from temblor.plans import streams
    calls = []
    real = streams.upsert_days

    def noted(root, keys):
        write = real(root, keys)
        return lambda batch, epoch_id: calls.append(epoch_id) or write(batch, epoch_id)
    monkeypatch.setattr(streams, "upsert_days", noted)
    sf = "/root/testdata/sf0.001"
    got = sorted((r.window_start, r.avg_magnitude)
                 for r in streams.stream_restart(spark, sf).collect())
    assert calls[:6] == [0, 1, 2, 3, 4, 4] and max(calls) >= streams.RESTART_FILES - 1
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    assert got == sorted(con.execute("SELECT window_start, avg_magnitude FROM "
                                     f"({streams.ORACLE_SQL['stream_restart']})").fetchall())


def test_late_rows_are_kept_aside_and_replayed_epochs_replace_themselves(spark, tmp_dir):
    from temblor.streaming import read_counts, read_rows, split_late
    root = os.path.join(tmp_dir, "late")
    fn = split_late(root, "t", dt.timedelta(hours=1))

    def batch(*times):
        return spark.createDataFrame([(t,) for t in times], "t timestamp")
    fn(batch(_at(1, 5), _at(1, 1)), 0)            # nothing seen before: none is late
    second = batch(_at(1, 4), _at(1, 3), None, _at(1, 6))
    fn(second, 1)
    fn(second, 1)
    fn(spark.createDataFrame([], "t timestamp"), 2)
    fn(batch(_at(1, 5), _at(1, 4)), 3)
    counts = {r.epoch_id: (r.num_rows, r.num_late) for r in read_counts(spark, root).collect()}
    assert counts == {0: (2, 0), 1: (4, 2), 2: (0, 0), 3: (2, 1)}
    assert read_rows(spark, root, late=True).count() == 3
    assert read_rows(spark, root, late=False).count() == 5


def test_replay_goes_on_where_it_was_stopped(spark, tmp_dir):
    from temblor.sources import replay, slice_name, stage_slices
    from temblor.sources.replay import empty_folder
    staged, feed, ck = (os.path.join(tmp_dir, x) for x in ("staged", "feed", "ck"))
    times = spark.createDataFrame([(_at(1, h),) for h in (0, 0, 1, 2, 2, 2, 5)], "t timestamp")
    stage_slices(times, staged, slice_name("t", 60))
    empty_folder(spark, feed)
    seen = []

    def count(batch, epoch_id):
        seen.append((epoch_id, batch.count()))
        if len(seen) == 3 and epoch_id == 2:
            raise RuntimeError("stopped on purpose")

    def start():
        stream = (spark.readStream.schema("t timestamp").option("recursiveFileLookup", True)
                  .parquet(feed))
        return stream.writeStream.foreachBatch(count).option("checkpointLocation", ck).start()
    with pytest.raises(Exception, match="stopped on purpose"):
        replay(spark, staged, feed, start())
    query = start()
    replay(spark, staged, feed, query)
    query.stop()
    assert seen == [(0, 2), (1, 1), (2, 3), (2, 3), (3, 1)]  # the third slice again, then the rest


def test_pair_stream_keeps_five_rows_an_event(spark, tmp_dir, monkeypatch):
    from temblor.plans import streams
    from temblor.streaming import runner
    i = F.col("id")
    n = 1_440  # one a minute, over all places
    spark.range(n).select(
        i.alias("event_id"),
        F.timestamp_seconds(1_704_067_200 + i * 60).cast("timestamp_ntz").alias("ts"),
        (i * 7 % 50).alias("user_id"), F.lit("click").alias("event_type"),
        ((i * 31) % 211 / 2).alias("value"), F.lit("{}").alias("props")
    ).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    updated = []
    real = runner.start_append

    def start(*a, **kw):
        query = real(*a, **kw)
        query.awaitTermination()
        updated.extend(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress
                       if p["stateOperators"])
        return query
    monkeypatch.setattr(runner, "start_append", start)
    got = streams.stream_proximity_pairs(spark, tmp_dir)
    static = streams.driver.proximity_jump_pairs(spark, tmp_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, static.collect())) != []
    assert n < sum(updated) < 5.4 * n, updated  # 6 rows an event before
    assert all(f.endswith(".zstd.parquet") for f in got.inputFiles())
