import json
import os

from pyspark.sql import functions as F

from temblor.plans import apps, seismic
from temblor.schemas import RAW_TRACE
from temblor.sources import read_store

from .fixtures import trace_rows


def _write_csv(path):
    header = ",".join(f.name for f in RAW_TRACE.fields)
    with open(path, "w") as fh:
        fh.write(header + "\n")
        for row in trace_rows():
            vals = []
            for v in row:
                if v is None:
                    vals.append("")
                elif hasattr(v, "isoformat"):
                    vals.append(v.isoformat(sep=" "))
                else:
                    s = str(v)
                    vals.append(f'"{s}"' if "," in s or " " in s else s)
            fh.write(",".join(vals) + "\n")


def test_batch_job_writes_ten_tables(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "merge.csv")
    _write_csv(csv)
    out = apps.run_batch(spark, csv, os.path.join(tmp_dir, "raw"), target="parquet",
                         out_root=os.path.join(tmp_dir, "curated"), as_of="2021-01-01",
                         cleaned_table="cleaned_apps_test")
    assert set(out) == set(seismic.CURATED)
    counts = {n: spark.read.parquet(p).count() for n, p in out.items()}
    assert counts["EventsByRegion"] == 3
    assert counts["EarthquakeStationDistance"] == 8
    check = apps.check_tables(spark, table="cleaned_apps_test")
    assert "cleaned_apps_test" in check["tables"] and len(check["preview"]) == 5


def test_metrics_stream_app(spark, tmp_dir):
    src = os.path.join(tmp_dir, "msgs")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        for i, (m, minute) in enumerate([(3.5, 1), (4.0, 2), (1.0, 40)]):
            fh.write(json.dumps({"id": str(i), "magnitude": m, "depth": 5.0 + i, "nst": i,
                                 "latitude": 34.0, "longitude": -118.0,
                                 "time": 1704067200000 + minute * 60000}) + "\n")
    msgs = spark.readStream.format("text").load(src)
    qs = apps.start_metrics(msgs, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                            trigger=None, watermark=None,
                            names=["avgMagnitude", "numberOfEarthquakesNearLA", "closePairs",
                                   "feedStatus"])
    windows = next(q for q in qs if q.name == "windowMetrics")
    for q in qs:
        q.processAllAvailable()
    # one read and one state store for all windowed metrics
    done = [p for p in windows.recentProgress if p["numInputRows"]]
    assert len(done) == 1 and len(done[0]["sources"]) == len(done[0]["stateOperators"]) == 1
    for q in qs:
        q.stop()
    avg = {r.window_start.minute: r.avg_magnitude
           for r in read_store(spark, os.path.join(tmp_dir, "out", "avgMagnitude")).collect()}
    assert avg == {0: 3.75, 30: 1.0}
    near = read_store(spark, os.path.join(tmp_dir, "out", "numberOfEarthquakesNearLA"))
    assert near.agg(F.sum("count")).first()[0] == 3
    status = read_store(spark, os.path.join(tmp_dir, "out", "feedStatus")).collect()
    assert len(status) == 1 and status[0].total_events == 3
    pairs = spark.read.parquet(os.path.join(tmp_dir, "out", "closePairs"))
    assert {(r.id, r.previous_id) for r in pairs.collect()} == {("0", "2"), ("1", "2"), ("1", "0")}


def test_training_app(spark, tmp_dir):
    raw = spark.createDataFrame(trace_rows() * 4, RAW_TRACE)
    cleaned = seismic.preprocess(raw)
    res = apps.run_training(spark, cleaned, os.path.join(tmp_dir, "model"), num_trees=3,
                            max_depth=3)
    assert res["metrics"]["test_rows"] >= 0
    assert len(res["importances"]) == 4


def test_metrics_app_fills_all_stores(spark, tmp_dir):
    src = os.path.join(tmp_dir, "msgs")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        for i, (m, minute) in enumerate([(2.0, 0), (4.0, 1), (5.0, 59), (6.0, 61)]):
            fh.write(json.dumps({"id": str(i), "magnitude": m, "depth": 9.0 + i, "nst": i,
                                 "latitude": 34.0 if i else 0.0, "longitude": -118.0,
                                 "time": 1704067200000 + minute * 60000}) + "\n")
        fh.write(json.dumps({"id": "no time", "magnitude": 9.0}) + "\n")
    msgs = spark.readStream.format("text").load(src)
    out = os.path.join(tmp_dir, "out")
    qs = apps.start_metrics(msgs, out, os.path.join(tmp_dir, "ck"), trigger=None,
                            names=list(apps.METRIC_STORES))
    assert len(qs) == 1
    for q in qs:
        q.processAllAvailable()
        q.stop()

    def store(name, column):
        return {r.window_start.hour * 60 + r.window_start.minute: r[column]
                for r in read_store(spark, os.path.join(out, name)).collect()}
    assert store("avgMagnitude", "avg_magnitude") == {0: 3.0, 30: 5.0, 60: 6.0}
    assert store("numberOfEarthquakesTrend", "trend") == dict.fromkeys((0, 30, 60), "decrease")
    assert store("shallowEarthquakesPercentage", "percent_shallow") == {0: 50.0, 30: 0.0, 60: 0.0}
    assert store("averageNst", "average_nst") == {0: 0.5, 30: 2.0, 60: 3.0}
    assert store("totalEnergy", "total_energy")[30] == 10 ** (1.5 * 5 + 4.8)
    assert store("strongEarthquakesPerHour", "num_earthquakes_mag_gt3") == {0: 2, 60: 1}
    assert store("numberOfEarthquakesNearLA", "count") == {0: 3}
