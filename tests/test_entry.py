"""The driver contract holds without the optional subpackage or a library that only it needs."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT

BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + '.'):
            raise ModuleNotFoundError('No module named ' + name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as E
q = E.queries()
print(len([n for n in q if not n.startswith('op') or not n[2].isdigit()]), set(E.oracle_sql()) <= set(q))
"""


@pytest.mark.parametrize("name", ["loanweave.llm", "corpus_pipeline", "ahocorasick", "tokenizers"])
def test_library_queries_survive_a_missing_module(name):
    out = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": ROOT}, timeout=120)
    assert out.returncode == 0, out.stderr[-500:]
    n, consistent = out.stdout.split()
    from loanweave.plans.catalog import QUERIES
    assert int(n) - ("pipeline" in out.stdout) >= len(QUERIES) and consistent == "True"
