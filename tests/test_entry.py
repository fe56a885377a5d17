"""The driver's contract, with and without the optional training-data operators."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__
from orderlens import oracle, registry

ROOT = Path(__file__).resolve().parent.parent

WITHOUT = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("orderlens.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def test_every_sql_statement_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_part():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split()[-2:] == [str(len(registry.QUERIES)), str(len(oracle.oracle_sql()))]


def test_nothing_else_uses_the_optional_part():
    for file in (ROOT / "orderlens").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "llm" not in file.read_text(), file


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["year", "month_num"]
