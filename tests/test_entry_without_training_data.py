"""The entry points in a copy of the tree without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

ASK = """
import __spark_entry__ as e
from costalloc.plans.catalog import QUERIES
names = set(e.queries())
assert set(QUERIES) <= names and set(e.oracle_sql()) >= set(QUERIES)
print(sorted(n for n in names - set(QUERIES)))
"""


def ask(folder, before=""):
    done = subprocess.run([sys.executable, "-B", "-c", before + ASK], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.strip().splitlines()[-1]


@pytest.fixture()
def copy(tmp_path):
    def make(*without):
        folder = tmp_path / "tree"
        shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *without))
        return folder

    return make


def test_without_the_folders(copy):
    """Both folders gone, the pipeline's file still there or gone as well."""
    folder = copy("llm")
    assert not os.path.exists(folder / "costalloc" / "llm") and ask(folder) == "[]"


def test_without_folders_and_pipeline(copy):
    assert ask(copy("llm", "corpus_pipeline.py")) == "[]"


def test_without_a_library_that_only_they_need(copy):
    block = "import sys\nfor m in ('xxhash', 'tiktoken', 'tokenizers'):\n    sys.modules[m] = None\n"
    assert ask(copy(), block) == "[]"


def test_other_tests_can_be_collected_without_them(copy):
    folder = copy("llm", "corpus_pipeline.py")
    run = [sys.executable, "-B", "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"]
    done = subprocess.run(run, cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stdout[-2000:]
