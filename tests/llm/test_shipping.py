import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys, tempfile
sys.path.insert(0, {root!r})  # the driver's path; its workers do not get it
from leafline.session import build_session
spark = build_session("elsewhere", "local[4]", {{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
    "spark.checkpoint.dir": tempfile.mkdtemp(dir=".")}})
spark.sparkContext.setLogLevel("OFF")

def seen(_):
    import importlib.util
    yield importlib.util.find_spec("leafline") is not None

assert spark.sparkContext.parallelize([0], 1).mapPartitions(seen).collect() == [False]
from leafline.llm import language_model, queries
language_model.LEARNERS = 2
for name in {names!r}:
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""
NAMES = [
    "op1_toxicity", "op2_language_model", "op5_near_duplicates", "op6_benchmark_leaks", "op8_language_id", "op10_sharding",
    "op11_periodic_runs", "op12_embedding_whitening", "op13_web_archives",
]


def test_executors_do_not_need_the_package(tmp_path):
    """A session started elsewhere, whose workers hold numpy and pyarrow only."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(root=ROOT, names=NAMES)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    got = dict(line.split() for line in out.stdout.splitlines() if line.startswith("op"))
    assert got == {n: {"op12_embedding_whitening": "4000", "op13_web_archives": "50"}.get(n, "200") for n in NAMES}, out.stderr[-3000:]
