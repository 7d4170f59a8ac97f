import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_optional_part(tmp_path):
    """Neither the subpackage nor the pipeline is needed by the rest."""
    (tmp_path / "lithos").mkdir()
    os.symlink(f"{ROOT}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    for name in os.listdir(f"{ROOT}/lithos"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/lithos/{name}", tmp_path / "lithos" / name)
    code = "import __spark_entry__ as e; names = e.queries(); print(len(names), any(n.startswith('op') for n in names), 'pipeline' in names)"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.stdout.split()[1:] == ["False", "False"] and int(done.stdout.split()[0]) > 100, done.stderr
