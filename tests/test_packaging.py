import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config(
    "spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp")).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as entry
for name in ("knn_join", "ml_score_udf"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_python_functions_run_from_any_folder(tmp_path):
    """Workers get the package from the session, not from their working folder."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "knn_join 2500" in done.stdout and "ml_score_udf 500" in done.stdout


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    """A copy without the two folders of corpus operators, its other files as they are."""
    copy = tmp_path / "copy"
    copy.mkdir()
    for name in os.listdir(REPO):
        if name.endswith(".py"):
            shutil.copy(f"{REPO}/{name}", copy)
    for folder in ("riskweave", "tests"):
        shutil.copytree(f"{REPO}/{folder}", copy / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    assert (copy / "corpus_pipeline.py").exists() == os.path.exists(f"{REPO}/corpus_pipeline.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op1') or k == 'pipeline' for k in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    count, has = done.stdout.split()[-2:]
    assert int(count) >= 142 and has == "False"
    collect = [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"]
    done = subprocess.run(collect, cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stdout[-2000:]
