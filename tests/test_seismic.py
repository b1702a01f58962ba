import datetime as dt

import pytest
from pyspark.sql import functions as F

from temblor.plans import seismic
from temblor.schemas import RAW_TRACE

from .fixtures import trace_rows


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = spark.createDataFrame(trace_rows(), RAW_TRACE)
    return seismic.preprocess(raw).cache()


def test_preprocess_types(cleaned):
    types = dict(cleaned.dtypes)
    assert types["p_travel_sec"] == "float"
    assert types["coda_end_sample"] == "float"
    assert types["source_depth_km"] == "string"
    row = cleaned.filter(F.col("source_id") == "e5").first()
    assert row.coda_end_sample == 1234.0
    assert cleaned.filter(F.col("source_id") == "e1").first().source_origin_time.microsecond == 0


def test_mechanism_split(spark):
    raw = spark.createDataFrame(trace_rows()[:1], RAW_TRACE)
    out = seismic.preprocess(raw, split_mechanism=True)
    r = out.first()
    assert (r.strike, r.dip, r.rake) == pytest.approx((67.0, 34.6, 56.7))
    assert "source_mechanism_strike_dip_rake" not in out.columns


def test_q1_keeps_ties(cleaned):
    out = seismic.biggest_per_year_network(cleaned, as_of=dt.date(2021, 1, 1)).collect()
    nc2020 = sorted(r.source_id for r in out if r.year == 2020 and r.network_code == "NC")
    assert nc2020 == ["e1", "e2"]
    assert {(r.year, r.network_code) for r in out} >= {(2019, "XX"), (2020, "NC")}


def test_q1_cutoff(cleaned):
    out = seismic.biggest_per_year_network(cleaned, as_of=dt.date(2049, 6, 1)).collect()
    assert all(r.year >= 2020 for r in out)


def test_q2_lag(cleaned):
    out = seismic.quarterly_magnitude_trend(cleaned, as_of=dt.date(2021, 1, 1)).collect()
    nc = [r for r in out if r.network_code == "NC"]
    assert [r.quarter for r in nc] == ["2020-Q1", "2020-Q3"]
    assert nc[0].prev_quarter_avg is None
    assert nc[1].change_from_prev_quarter == pytest.approx(3.5 - nc[0].avg_magnitude)


def test_q3_sigma_global(cleaned):
    out = seismic.azimuthal_gap_outliers(cleaned).collect()
    ids = {r.source_id for r in out}
    assert "e5" not in ids  # nan gap excluded
    assert all(r.gap_category in ("Normal", "Anomalous") for r in out)
    assert len({r.avg_gap for r in out}) == 1


def test_q4_numeric_depth_tiles(cleaned):
    out = seismic.depth_magnitude_profile(cleaned, rows_per_range=2).collect()
    nc = {r.depth_quartile: r for r in out if r.network_code == "NC"}
    assert set(nc) == {1, 2, 3}
    # 9.5 sorts before 10.2 numerically (text order would put 10.2 first)
    assert nc[1].min_magnitude == 4.0


def test_q5_q6(cleaned):
    q5 = seismic.p_s_time_difference(cleaned).collect()
    assert [r.year for r in q5] == [2020]
    q6 = seismic.magnitude_with_distance(cleaned).collect()
    assert q6[0].avg_magnitude == pytest.approx((4 + 4 + 2 + 3.5 + 1 + 2.5 + 1.5) / 7)


def test_q7_null_distance_first(cleaned):
    out = seismic.distance_error_profile(cleaned, tiles=10, tiebreak="source_id",
                                         rows_per_range=3).collect()
    assert sum(r.event_count for r in out) == 7  # e5 (None) and e9 (nan) dropped


def test_q8_share(cleaned):
    out = {r.network_code: r for r in seismic.events_by_region(cleaned).collect()}
    assert out["NC"].event_count == 7 and out["NC"].total_events == 9
    assert out["ONE"].event_percentage == pytest.approx(100 / 9)


def test_q9_single_row_network(cleaned):
    out = seismic.processing_time_anomalies(cleaned).collect()
    one = [r for r in out if r.network_code == "ONE"][0]
    assert one.std_dev_processing_time is None and one.processing_status == "Normal"
    xx = [r for r in out if r.network_code == "XX"][0]
    assert xx.processing_time == 60


def test_q10_bands(cleaned):
    out = {r.source_id: r for r in seismic.station_distance(cleaned).collect()}
    assert "e8" not in out
    assert out["e9"].distance_km == 0.0 and out["e9"].distance_category == "Near"
    assert out["e1"].distance_category == "Medium"  # ~54.8 km


def test_dedup_and_previous(cleaned):
    from temblor.operators import with_previous
    doubled = cleaned.unionByName(cleaned)
    assert seismic.dedup_events(doubled).count() == cleaned.count()
    per_year = seismic.magnitude_with_distance(cleaned)
    out = with_previous(per_year, "avg_magnitude", "year", change_name="chg").collect()
    assert out[0].prev_avg_magnitude is None and out[0].chg is None
