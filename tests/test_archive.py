import datetime as dt
import json
import os

from temblor.streaming import archive_batch, archive_history, archive_rows, fold_days

DAY = 86_400_000


def _batch(spark, *ids_days):
    rows = [(json.dumps({"id": i, "magnitude": 1.0, "time": 1704067200000 + d * DAY + n}),)
            for n, (i, d) in enumerate(ids_days)]
    return archive_rows(spark.createDataFrame(rows, "value string"))


def _ids(spark, raw, folded):
    return sorted((r.day.day, r.id) for r in archive_history(spark, raw, folded).collect())


def _files(root):
    return [f for _, _, fs in os.walk(root) for f in fs if f.startswith("part-")]


def test_finished_days_are_folded_once(spark, tmp_dir):
    raw, folded = (os.path.join(tmp_dir, x) for x in ("raw", "folded"))
    assert fold_days(spark, raw, folded, dt.date(2024, 1, 9)) == 0
    write = archive_batch(raw)
    for epoch in range(6):
        write(_batch(spark, (f"a{epoch}", 0), (f"b{epoch}", 1), ("copy", 0)), epoch)
    write(_batch(spark, ("a5", 0), ("b5", 1), ("copy", 0)), 5)  # a replayed epoch
    before = _ids(spark, raw, folded)
    assert len(before) == 18
    assert fold_days(spark, raw, folded, dt.date(2024, 1, 2)) == 1
    assert _ids(spark, raw, folded) == before
    assert len(_files(folded)) == 1 and len(_files(raw)) >= 6
    assert fold_days(spark, raw, folded, dt.date(2024, 1, 2)) == 0  # nothing is due
    assert fold_days(spark, raw, folded, dt.date(2024, 1, 3)) == 1
    assert _ids(spark, raw, folded) == before and not _files(raw)
    assert len(_files(folded)) == 2
    day = spark.read.parquet(os.path.join(folded, "day=2024-01-01"))
    times = [r.time for r in day.collect()]
    assert times == sorted(times)


def test_late_messages_and_broken_folds(spark, tmp_dir):
    import shutil
    raw, folded = (os.path.join(tmp_dir, x) for x in ("raw", "folded"))
    write = archive_batch(raw)
    write(_batch(spark, ("a", 0), ("b", 0)), 0)
    shutil.copytree(raw, raw + "-kept")
    fold_days(spark, raw, folded, dt.date(2024, 1, 2))
    # as if the fold had ended before it removed what it had read
    shutil.copytree(raw + "-kept", raw, dirs_exist_ok=True)
    assert _ids(spark, raw, folded) == [(1, "a"), (1, "b")]
    write(_batch(spark, ("late", 0), ("new", 1)), 1)
    want = [(1, "a"), (1, "b"), (1, "late"), (2, "new")]
    assert _ids(spark, raw, folded) == want
    assert fold_days(spark, raw, folded, dt.date(2024, 1, 2)) == 1
    assert _ids(spark, raw, folded) == want
    assert len(_files(folded)) == 1 and len(_files(raw)) == 1
