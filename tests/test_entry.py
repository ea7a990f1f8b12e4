"""The driver contract in __spark_entry__.py."""

import importlib
import os
import subprocess
import sys

import pytest

from vintagelake.plans.queries import queries
from vintagelake.schemas import VINTAGE_COLUMNS


def test_entry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.columns == VINTAGE_COLUMNS
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries()) <= set(entry.oracle_sql())
    assert all(callable(f) for f in entry.queries().values())
    assert all(isinstance(sql, str) and sql.strip() for sql in entry.oracle_sql().values())


BLOCKED = """
import sys
sys.path.insert(0, {repo!r})
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r}:
            raise ModuleNotFoundError("blocked", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
print("FOUND", len(e.queries()), len(e.oracle_sql()), any(q.startswith("op") for q in e.queries()))
"""


@pytest.mark.parametrize("name", ["tiktoken", "public_tokenizers", "regex"])
def test_a_missing_library_of_the_corpus_operators_leaves_the_others(name):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = BLOCKED.format(repo=repo, name=name)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert f"FOUND {len(queries())} {len(queries())} False" in done.stdout, done.stderr[-1000:]
