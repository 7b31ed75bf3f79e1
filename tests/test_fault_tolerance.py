import json
import os
import subprocess
import sys

from conftest import SF_SMALL

JOB = os.path.join(os.path.dirname(os.path.abspath(__file__)), "jobs", "retry_job.py")


def test_merge_survives_task_retries(tmp_path):
    out = subprocess.run(
        [sys.executable, JOB, SF_SMALL, str(tmp_path / "ckpt")],
        capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["rows"] > 0 and res["equal"] and res["ids_stable"] and res["ids"] > 0
    assert res["snapshot_equal"]
