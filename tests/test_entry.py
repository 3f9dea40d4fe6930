"""The driver's entry point, with and without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_works_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('sparrowmill.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e, bench\n"
        "assert len(e.queries()) == len(e.oracle_sql()) > 100\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_a_broken_dependency_is_not_taken_for_a_missing_subpackage(monkeypatch):
    import pytest

    real = entry.__builtins__["__import__"]

    def broken(name, *args, **kwargs):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("No module named 'numpy'", name="numpy")
        return real(name, *args, **kwargs)

    monkeypatch.setitem(entry.__builtins__, "__import__", broken)
    with pytest.raises(ModuleNotFoundError, match="numpy"):
        entry.training_data()
