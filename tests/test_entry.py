import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


def test_queries_import_without_a_session_and_without_llm(tmp_path):
    for name in ("quillstream", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "quillstream" / "llm", ignore_errors=True)
    done = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, timeout=60)
    n, fits = done.stdout.split()
    assert int(n) >= 60 and fits == "True", done.stderr


def test_entry_runs(spark, tmp_path):
    from quillstream.queries import line_repetition

    spark.createDataFrame([(1, "a\nb\na"), (2, None), (3, "")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["max_rep"] for r in line_repetition(spark, str(tmp_path)).collect()} == {1: 2, 2: 0, 3: 0}
