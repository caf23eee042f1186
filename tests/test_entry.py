"""The driver contract without the optional subpackage's libraries."""

import os
import subprocess
import sys

from tests.conftest import ROOT

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r}:
            raise ModuleNotFoundError("blocked " + name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()), any(k.startswith("op") and k[2].isdigit() for k in E.queries()))
"""


def run(blocked):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, check=True,
                         env=os.environ | {"PYTHONPATH": ROOT})
    return out.stdout.split()


def test_core_queries_import_without_the_subpackage_libraries():
    from quarry.plans.testdata import QUERIES
    for library in ("tiktoken", "tokenizers", "public_tokenizers"):
        assert run([library])[::2] == [str(len(QUERIES)), "False"], library
