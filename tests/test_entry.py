"""The optional queries never take the event-log queries with them."""

import subprocess
import sys

import pytest

from conftest import ROOT


@pytest.mark.parametrize("missing", ["xxhash", "tokenizers", "numpy.linalg.nothing", "tidemark.llm", "corpus_pipeline"])
def test_queries_without_an_optional_package(missing):
    """A fresh interpreter in which ``missing`` cannot be imported."""
    code = f"""
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
from tidemark.catalog import QUERIES
print(len(QUERIES), len(set(QUERIES) & set(e.queries())), len(set(QUERIES) & set(e.oracle_sql())), len(e.EXTRA))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-500:]
    n, queries, sql, extra = map(int, out.stdout.split()[-4:])
    assert queries == n and sql == n
    if missing in ("xxhash", "tidemark.llm", "corpus_pipeline"):
        assert extra == 0
