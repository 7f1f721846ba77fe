"""The entry module in a copy of the repository without the corpus operators, as the driver leaves it."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy(target, *left_out):
    def ignored(folder, names):
        at = os.path.relpath(folder, ROOT)
        return [n for n in names if n.startswith((".", "spark-", "__pycache__")) or os.path.normpath(os.path.join(at, n)) in left_out]
    shutil.copytree(ROOT, target, ignore=ignored)


def _names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    queries, sql = out.stdout.strip().split("\n")[-2:]
    return set(queries.split()), set(sql.split())


def test_entry_without_the_corpus_operators(tmp_path):
    parts = [os.path.join("adjudica", "llm"), os.path.join("tests", "llm"), "corpus_pipeline.py"]
    _copy(tmp_path / "bare", *parts)
    queries, sql = _names(tmp_path / "bare")
    assert len(queries) > 90 and sql <= queries and not any(q.startswith("op") or q == "pipeline" for q in queries)
    # any one part missing leaves the library's own queries
    _copy(tmp_path / "no_llm", *parts[:2])
    assert _names(tmp_path / "no_llm")[0] == queries
    _copy(tmp_path / "no_pipeline", parts[2])
    assert queries < _names(tmp_path / "no_pipeline")[0]


def test_other_import_errors_are_raised(tmp_path):
    _copy(tmp_path / "broken", "tests")
    with open(tmp_path / "broken" / "corpus_pipeline.py", "a") as f:
        f.write("\nimport no_such_module\n")
    code = "import __spark_entry__"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "broken", env=os.environ | {"PYTHONPATH": str(tmp_path / "broken")}, capture_output=True, text=True)
    assert out.returncode != 0 and "no_such_module" in out.stderr
