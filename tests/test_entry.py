import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *[k for k in e.queries() " \
       "if k.startswith('op') and k[2].isdigit() or k == 'pipeline'])"


def copy_of(tmp_path, without):
    """The tree without some of its parts."""
    to = tmp_path / "copy"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json"))
    for part in without:
        path = to / part
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    return to


@pytest.mark.parametrize("without", [("tierline/llm", "tests/llm"),
                                     ("tierline/llm", "tests/llm", "corpus_pipeline.py")])
def test_import_without_the_training_data_part(tmp_path, without):
    at = copy_of(tmp_path, without)
    out = subprocess.run([sys.executable, "-c", LIST], cwd=at, capture_output=True, text=True, timeout=120,
                         env={**os.environ, "PYTHONPATH": str(at)})
    assert out.returncode == 0, out.stderr
    n, m, *extra = out.stdout.split()
    assert int(n) == int(m) >= 86 and extra == []
