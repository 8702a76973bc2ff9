"""The package without its text subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.oracle_sql())); print(*sorted(e.queries()))"], cwd=folder,
                         capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr
    return out.stdout.split("\n")[1].split()


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_without_the_text_operators(tmp_path, gone):
    skipped = shutil.ignore_patterns(*gone, ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skipped)
    left = names(tmp_path / "repo")
    assert "salary_market" in left and not any(n.startswith("op") or n == "pipeline" for n in left)


def test_entry_with_left_over_folder(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    (tmp_path / "repo/vacantia/llm/__pycache__").mkdir(parents=True)
    assert "salary_market" in names(tmp_path / "repo")


def test_the_rest_is_collected_without_the_text_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    out = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=tmp_path / "repo",
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stdout[-2000:]
    assert "test_plans" in out.stdout and "test_streaming" in out.stdout


def test_nothing_else_imports_the_text_operators():
    for folder in ("vacantia", "registry", "tests"):
        for at, dirs, files in os.walk(os.path.join(ROOT, folder)):
            if "llm" in at.split(os.sep):
                continue
            for f in files:
                if f.endswith(".py") and f != "test_entry.py":
                    text = open(os.path.join(at, f), encoding="utf-8").read()
                    assert "vacantia.llm" not in text and "corpus_pipeline" not in text, f
