"""`python -m tillroll` publishes every stage and its metadata."""

import json
import os
import subprocess
import sys
import tempfile

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_publishes_all_tables():
    work = tempfile.mkdtemp(prefix="tillroll-cli-")
    out = subprocess.run(
        [sys.executable, "-m", "tillroll", "--sf-dir", SF_SMALL, "--database", "cli_db",
         "--master", "local[2]"],
        cwd=work, env={**os.environ, "PYTHONPATH": REPO}, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [json.loads(x) for x in out.stdout.splitlines() if x.startswith("{")]
    tables = {x["table"]: x["row_count"] for x in lines}
    assert len(tables) == 16
    assert tables["cli_db.cleaned_sales_data"] == 5876
    assert tables["cli_db.customer_insights_metadata"] == 1
