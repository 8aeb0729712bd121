"""The sales queries do not need the corpus operators or their libraries."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["zstandard", "public_tokenizers", "tillroll.llm"])
def test_entry_imports_without(hidden):
    code = f"""
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r} or name.startswith({hidden!r} + '.'):
            raise ModuleNotFoundError('hidden', name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as E
assert 'raw_sales' in E.queries() and 'raw_sales' in E.oracle_sql()
assert len(E.queries()) == len(E.oracle_sql()) >= 46 and not any(k.startswith('op') for k in E.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=HERE, check=True, timeout=120)
