"""The command line: argument checks and one job run in a fresh process."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL
from salesmart.plans import fixtures


def run_cli(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    return subprocess.run([sys.executable, "-m", "salesmart", *args], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)


def test_unknown_action_is_rejected(tmp_path):
    res = run_cli(str(tmp_path), "publish")
    assert res.returncode == 2 and "invalid choice" in res.stderr


def test_options_belong_to_their_action(tmp_path):
    res = run_cli(str(tmp_path), "enrich", "--province", "ASIA")
    assert res.returncode == 2 and "does not take --province" in res.stderr


def test_stage_locations_runs(spark, tmp_path):
    fixtures.write_location_landing(spark, SF_SMALL, f"{tmp_path}/landing")
    res = run_cli(str(tmp_path), "stage-locations")
    assert res.returncode == 0, res.stderr[-2000:]
    summary = json.loads(res.stdout.strip().splitlines()[-1])
    assert summary["rows"] == 10 and summary["files"] >= 1
