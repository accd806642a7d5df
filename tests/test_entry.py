"""The driver's entry with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


def ask(folder):
    said = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    return [int(x) for x in said.stdout.split()[-3:]]


def copied(to, *without):
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.md"))
    for path in without:
        at = os.path.join(to, path)
        if os.path.isdir(at):
            shutil.rmtree(at)
        elif os.path.exists(at):
            os.remove(at)
    return to


def test_queries_without_the_corpus_operators(tmp_path):
    for k, gone in enumerate((["harrow/llm", "tests/llm"], ["harrow/llm", "tests/llm", "corpus_pipeline.py"])):
        n, oracles, corpus = ask(copied(str(tmp_path / str(k)), *gone))
        assert n > 50 and oracles > 50 and corpus == 0
