"""What the entry module offers when packages are missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = entry.queries()
print(len(names), sum(n.startswith("op") and n[2].isdigit() for n in names), set(entry.oracle_sql()) <= set(names))
"""


def offered(name):
    return subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("name", ["public_tokenizers", "kerbcast.llm"])
def test_text_queries_are_left_out_without_what_they_need(name):
    done = offered(name)
    assert done.returncode == 0, done.stderr
    count, text, whole = done.stdout.split()
    assert int(count) > 100 and text == "0" and whole == "True"


def test_other_missing_packages_are_errors():
    assert "No module named 'pyarrow'" in offered("pyarrow").stderr
