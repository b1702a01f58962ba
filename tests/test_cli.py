import json
import os
import subprocess
import sys

from .fixtures import trace_rows
from .test_apps import _write_csv

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_batch_then_check(tmp_dir):
    csv = os.path.join(tmp_dir, "merge.csv")
    _write_csv(csv)
    env = dict(os.environ, PYTHONPATH=ROOT)
    base = [sys.executable, "-m", "temblor", "--master", "local[2]"]
    out = subprocess.run(base + ["batch", "--raw", csv, "--raw-zone", os.path.join(tmp_dir, "raw"),
                                 "--target", "parquet", "--out", os.path.join(tmp_dir, "cur"),
                                 "--as-of", "2021-01-01"],
                         cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    written = json.loads(out.stdout.strip().splitlines()[-1])
    assert len(written) == 10 and all(os.path.isdir(p) for p in written.values())
    assert len(trace_rows()) == 9
