"""The entry module with and without the optional text operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("cardwatch.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
"""
PRINT = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"


def printed(code):
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    return done.stdout.split()


def test_other_queries_stay_without_the_text_operators():
    n, pipeline, oracles = printed(BLOCKED + PRINT)
    assert int(n) > 80 and (pipeline, oracles) == ("False", "True")


def test_other_import_errors_are_not_hidden():
    broken = BLOCKED.replace('name.split(".")[0] == "corpus_pipeline" or name.startswith("cardwatch.llm")', 'name == "numpy"')
    done = subprocess.run([sys.executable, "-c", broken + PRINT], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "numpy" in done.stderr
