"""The command line runs a mode end to end in its own process."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_cli_transform_prints_one_json_line(folder):
    lake = folder("cli") + "/lake"
    out = subprocess.run(
        [sys.executable, "-m", "tierline", "transform", "--source", SF, "--lake", lake,
         "--master", "local[2]"],
        cwd=REPO, capture_output=True, text=True, timeout=600, check=True)
    line = json.loads(out.stdout.strip().splitlines()[-1])
    assert line["mode"] == "transform" and line["gold_rows"] == 6000
