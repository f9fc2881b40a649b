"""The registry can be read without a session."""

import subprocess
import sys

from conftest import ROOT


def test_names_without_a_session():
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and len(q) > 220; print('ok')"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("ok"), done.stderr[-2000:]


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
