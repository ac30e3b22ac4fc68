"""The driver contract without the parts that may be absent."""

import os
import subprocess
import sys

import pytest

from workload.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", ["tradelake.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_base_queries_stay_without(absent):
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as e\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
        "print(*sorted(e.queries()))"
    )
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert found.stdout.split() == sorted(QUERIES)
