"""The entry without the optional subpackage, with a broken one, and without a library it needs."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import warnings; warnings.simplefilter('error', SyntaxWarning); import __spark_entry__ as e; print(len(e.queries()), len(e.LLM_QUERIES))"


def entry(folder, before=""):
    return subprocess.run([sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.fixture()
def copy(scratch):
    for name in ("reelhouse", "__spark_entry__.py"):
        (shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy)(f"{ROOT}/{name}", f"{scratch}/{name}")
    return scratch


def test_without_the_subpackage(copy):
    os.makedirs(f"{copy}/llm/__pycache__")  # what deleting the files may leave
    total, llm = map(int, entry(copy).stdout.split())
    assert llm == 0 and total >= 64


def test_a_broken_subpackage_is_an_error(copy):
    os.makedirs(f"{copy}/llm")
    open(f"{copy}/corpus_pipeline.py", "w").close()
    for text in ("import llm.nothing", "1 / 0"):
        with open(f"{copy}/llm/queries.py", "w") as f:
            f.write(text)
        assert entry(copy).returncode != 0


def test_a_missing_library_leaves_the_others(copy):
    os.makedirs(f"{copy}/llm")
    open(f"{copy}/corpus_pipeline.py", "w").close()
    with open(f"{copy}/llm/queries.py", "w") as f:
        f.write("import no_such_library")
    out = entry(copy)
    assert out.stdout.split()[1] == "0" and "no_such_library" in out.stderr
