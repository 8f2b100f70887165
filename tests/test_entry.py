"""The registered queries without the corpus operators, and with broken ones."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = "import __spark_entry__ as e; print('FOUND', len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.fixture
def copy(tmp_path):
    """The tree without the folders that hold the corpus operators and their tests."""
    folder = str(tmp_path / "repo")
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    return folder


def probe(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-B", "-c", PROBE], cwd=folder, env=env, capture_output=True, text=True)


def test_entry_without_the_corpus_operators(copy):
    from annexport.plans.queries import QUERIES

    for name in ("corpus_pipeline.py", None):  # with the pipeline still there, and without it
        found = probe(copy)
        assert f"FOUND {len(QUERIES)} {len(QUERIES)} False" in found.stdout, found.stderr
        if name:
            os.remove(f"{copy}/{name}")


def test_errors_of_the_corpus_operators_are_raised(copy):
    os.makedirs(f"{copy}/annexport/llm")
    for name, text in (("__init__", ""), ("queries", "import no_such_module_of_ours\n")):
        with open(f"{copy}/annexport/llm/{name}.py", "w") as out:
            out.write(text)
    found = probe(copy)
    assert found.returncode != 0 and "no_such_module_of_ours" in found.stderr
