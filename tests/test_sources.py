import json
import os

from pyspark.sql import functions as F

from temblor.operators import field_types, map_feed
from temblor.schemas import EVENT
from temblor.sources import (decode, flatten_geojson, land_raw, list_tables, preview,
                             publish_json, read_raw_csv, write_curated)

from .fixtures import trace_rows


def test_csv_multiline_and_landing(spark, tmp_dir):
    header = ",".join(f.name for f in __import__("temblor.schemas", fromlist=["RAW_TRACE"]).RAW_TRACE.fields)
    vals = ["" if v is None else str(v) for v in trace_rows()[0]]
    vals[2] = '"HH\nline2"'  # quoted field with a line break
    path = os.path.join(tmp_dir, "merge.csv")
    with open(path, "w") as fh:
        fh.write(header + "\n" + ",".join(vals) + "\n")
    df = read_raw_csv(spark, path)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].receiver_type == "HH\nline2"
    landed = land_raw(spark, path, os.path.join(tmp_dir, "raw_zone"))
    assert landed.count() == 1


def test_decode_malformed_and_publish_nulls(spark):
    msgs = spark.createDataFrame(
        [('{"id": "a", "magnitude": 4.5, "time": 1700000000123, "latitude": 1.0}',),
         ("{not json",), ('{"id": "b", "magnitude": "oops"}',)], "value string")
    out = {r.id: r for r in decode(msgs, EVENT).collect()}
    assert out["a"].time_ts.isoformat().startswith("2023-11-14T22:13:20.123")
    assert None in out  # malformed -> all-null row
    assert out.get("b") is None or out["b"].magnitude is None
    pub = publish_json(spark.createDataFrame([("x", None)], "id string, place string"))
    assert json.loads(pub.first().value) == {"id": "x", "place": None}


def test_geojson_edges(spark):
    docs = [json.dumps({"features": []}),
            json.dumps({"features": [
                {"id": "q1", "properties": {"mag": None, "place": "P", "time": 5},
                 "geometry": {"coordinates": [10.0, None, 3.0]}},
                {"id": "q2", "properties": {"mag": 2.0}, "geometry": {"coordinates": [1.0, 2.0, 3.0]}},
            ]})]
    flat = flatten_geojson(spark.createDataFrame([(d,) for d in docs], "value string"))
    rows = {r.id: r for r in flat.collect()}
    assert set(rows) == {"q1", "q2"}
    assert rows["q1"].magnitude is None and rows["q1"].latitude is None
    assert rows["q1"].longitude == 10.0 and rows["q2"].latitude == 2.0
    fed = {r.latitude: r for r in map_feed(flat).collect()}
    assert fed[None].magnitude == 0.0 and fed[2.0].place == "Unknown"


def test_field_types_and_catalog(spark, tmp_dir):
    df = spark.createDataFrame([(1.0, "a", True)], "x double, s string, b boolean")
    kinds = {r.name: r.kind for r in field_types(df).collect()}
    assert kinds == {"x": "real", "s": "string", "b": "boolean"}
    write_curated(df, "curated_demo", target="table")
    assert "curated_demo" in {r.tableName for r in list_tables(spark).collect()}
    assert preview(spark, "curated_demo").count() == 1
    assert preview(spark, "no_such_table") is None
    write_curated(df, "p", target="parquet", path=os.path.join(tmp_dir, "p"))
    assert spark.read.parquet(os.path.join(tmp_dir, "p")).count() == 1
    assert F is not None


def test_counted_rides_along(spark, tmp_dir):
    from temblor.sources import counted
    df, obs = counted(spark.range(42), "n")
    df.write.mode("overwrite").parquet(os.path.join(tmp_dir, "c"))
    assert obs.get["n"] == 42


def test_slices_are_half_open_and_cover_every_event(spark):
    from temblor.operators import replay_counts, time_slices
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts")
    out = replay_counts(ev, time_slices(ev, "ts", 15), "ts", 15).orderBy("slice_start").collect()
    assert sum(r.num_events for r in out) == ev.count()
    assert all(a.slice_end == b.slice_start for a, b in zip(out, out[1:]))
    assert out[0].slice_start.minute == 0 and out[0].slice_start.second == 0


def test_publish_json_with_key(spark):
    df = spark.createDataFrame([(7, "x")], "id long, place string")
    row = publish_json(df, key="id").first()
    assert row.key == "7" and json.loads(row.value) == {"id": 7, "place": "x"}
