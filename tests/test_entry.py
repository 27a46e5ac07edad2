import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

DATA = entry.SMOKE_DIR


def test_registered_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no dataset")
def test_flagship(spark):
    assert entry.entry(spark).count() == 10


def test_listing_needs_no_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__), timeout=120)
    assert done.returncode == 0, done.stderr
