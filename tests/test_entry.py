"""The entry module without the training-data operators, or without a library that they need."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from enrollspark.plans.queries import QUERIES
print("NAMES", sorted(e.queries()) == sorted(QUERIES), sorted(e.oracle_sql()) == sorted(QUERIES), callable(e.entry))
"""


@pytest.mark.parametrize("name", ["zstandard", "enrollspark.llm", "corpus_pipeline"])
def test_a_missing_module_leaves_the_other_queries(name):
    out = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert "NAMES True True True" in out.stdout
