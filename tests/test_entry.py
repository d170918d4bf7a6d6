"""The queries of the library are there whether or not the optional ones are."""
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(q.startswith("op") for q in e.queries()))
"""


def names(hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=hidden)], cwd=ROOT, capture_output=True, text=True)
    return done.stdout.split(), done.stderr


@pytest.mark.parametrize("missing", ["zstandard", "regex", "tableferry.llm", "corpus_pipeline"])
def test_a_missing_dependency_leaves_the_other_queries(missing):
    from contracts.oracle import ORACLE
    from contracts.queries import QUERIES

    (queries, oracle, optional), said = names(missing)
    assert (int(queries), int(oracle), optional) == (len(QUERIES), len(ORACLE), "False")
    assert missing in said or not (ROOT / "tableferry" / "llm").exists()


def test_another_missing_module_is_an_error():
    assert "pandas" in names("pandas")[1] or not (ROOT / "tableferry" / "llm").exists()
