"""Tasks must run where the package is not on the workers' path."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

# The driver alone learns where the package is; workers get the path of the environment.
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
from gradus.queries import QUERIES
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").getOrCreate()
)
seen = spark.range(1).mapInPandas(
    lambda parts: (p.assign(found=__import__("importlib.util").util.find_spec("gradus") is not None) for p in parts),
    "id long, found boolean",
)
print("on path", int(seen.first()["found"]))
for name in ("linear_workflow", "vif_select", "match_nearest"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_from_another_folder(tmp_path):
    listed = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    others = [p for p in listed if p and not (Path(p) / "gradus").exists()]
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(others)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    names = ("on path", "linear", "vif", "match")
    counts = dict(line.rsplit(maxsplit=1) for line in done.stdout.splitlines() if line.startswith(names))
    assert {k: int(v) > 0 for k, v in counts.items()} == {
        "on path": False, "linear_workflow": True, "vif_select": True, "match_nearest": True,
    }, done.stderr[-2000:]
