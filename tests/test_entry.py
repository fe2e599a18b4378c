"""The driver's entry, with the training-data subpackage and without it."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e, json; print('\\n' + json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def asked(folder):
    import json

    got = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=300)
    assert not got.returncode, got.stderr[-2000:]
    return json.loads(got.stdout.splitlines()[-1])


def test_every_query_of_the_ledger_has_sql():
    from quillstone.plans import registry

    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_without_the_training_data_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    for with_pipeline in (True, False):
        if not with_pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        queries, sql = asked(copy)
        assert "trial_balance" in queries and queries == sql and not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_entry_as_it_is():
    queries, _ = asked(REPO)
    assert "trial_balance" in queries
    if (REPO / "quillstone" / "llm").is_dir():
        assert sum(q.startswith("op") for q in queries) == 10 and ("pipeline" in queries) == (REPO / "corpus_pipeline.py").exists()
