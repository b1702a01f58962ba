"""Hand-made raw trace rows (FIXTURES F1) with the documented edge cases."""

import datetime as dt

from temblor.schemas import RAW_TRACE

T0 = dt.datetime(2020, 3, 1, 10, 0, 0, 500000)


def raw_row(**kw):
    base = {f.name: None for f in RAW_TRACE.fields}
    base.update({
        "network_code": "NC", "receiver_code": "R1", "receiver_type": "HH",
        "receiver_latitude": 10.0, "receiver_longitude": 20.0, "receiver_elevation_m": 5.0,
        "p_travel_sec": 10.0, "source_id": "e1", "source_origin_time": T0,
        "source_latitude": 10.0, "source_longitude": 20.5, "source_error_sec": "1.5",
        "source_gap_deg": "100", "source_horizontal_uncertainty_km": "None",
        "source_depth_km": "10.2", "source_depth_uncertainty_km": "None",
        "source_magnitude": 3.0, "source_distance_km": 35.0, "coda_end_sample": "[[555.6]]",
        "source_mechanism_strike_dip_rake": "[[ 67.0 34.6 56.7 ]]",
        "trace_start_time": T0 + dt.timedelta(seconds=30),
    })
    base.update(kw)
    return tuple(base[f.name] for f in RAW_TRACE.fields)


def trace_rows():
    d = dt.timedelta
    return [
        raw_row(source_id="e1", source_magnitude=4.0, source_depth_km="9.5"),
        raw_row(source_id="e2", source_magnitude=4.0, source_depth_km="100"),   # tie in year+net
        raw_row(source_id="e3", source_magnitude=2.0, source_depth_km="None"),  # no depth
        raw_row(source_id="e4", source_magnitude=None, source_depth_km="10.2"),  # no magnitude
        raw_row(source_id="e5", network_code="XX", source_magnitude=5.5,
                source_origin_time=dt.datetime(2019, 1, 5, 1, 2, 3),
                trace_start_time=dt.datetime(2019, 1, 5, 1, 3, 3),
                source_gap_deg="nan", source_error_sec="None", source_distance_km=None,
                coda_end_sample="[[1234.]]"),
        raw_row(source_id="e6", source_magnitude=3.5,
                source_origin_time=T0 + d(days=200), trace_start_time=T0 + d(days=200, seconds=40),
                source_gap_deg="350", source_distance_km=100.0),
        raw_row(source_id="e7", source_magnitude=1.0, source_gap_deg="-3.5",
                source_error_sec="1e-4", source_distance_km=50.0),
        raw_row(source_id="e8", source_magnitude=2.5, source_latitude=None),
        raw_row(source_id="e9", network_code="ONE", source_magnitude=1.5,
                receiver_latitude=10.0, receiver_longitude=20.5, source_error_sec="nan"),
    ]
