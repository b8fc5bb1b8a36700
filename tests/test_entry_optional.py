"""The entry module without packages that only the optional part needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["ahocorasick", "tributary.llm", "corpus_pipeline", "public_tokenizers"])
def test_event_queries_stay(hidden):
    code = (f"import sys; sys.modules[{hidden!r}] = None\n"
            "import __spark_entry__ as e\n"
            "names = set(e.queries())\n"
            "assert {'silver_full', 'scd2_bucketed', 'schema_drift'} <= names and set(e.oracle_sql()) <= names\n"
            "assert 'pipeline' not in names\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert "training-data queries left out" in out.stderr
