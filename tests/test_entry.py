"""What is registered when parts of an installation are absent."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ABSENT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(len(entry.queries()), sorted(entry.queries())[0], "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("name", ["grainline.llm", "ahocorasick", "regex", "corpus_pipeline"])
def test_other_queries_are_there_without_the_text_operators(name):
    run = subprocess.run([sys.executable, "-c", ABSENT.format(name=name)], capture_output=True, text=True, cwd=ROOT)
    count, _, pipeline = run.stdout.split()
    assert int(count) > 100 and pipeline == "False", run.stderr


def test_a_missing_part_of_the_library_is_an_error():
    run = subprocess.run([sys.executable, "-c", ABSENT.format(name="grainline.plans")], capture_output=True, text=True, cwd=ROOT)
    assert run.returncode and "ImportError" in run.stderr
