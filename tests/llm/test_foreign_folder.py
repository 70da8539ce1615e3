"""Every query with Python tasks where workers can't import the package."""

import os
import subprocess
import sys

import pytest

pytest.importorskip("public_tokenizers")

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's only: workers start in a folder without the package
import __spark_entry__ as entry
from yieldlab.session import get_session

spark = get_session("local[4]", app_name="foreign", shuffle_partitions=4)


def importable(batches):
    import importlib.util

    for b in batches:
        yield b.assign(found=importlib.util.find_spec("yieldlab") is not None)[["found"]]


assert not any(r.found for r in spark.range(4).mapInPandas(importable, "found boolean").collect())
queries = entry.queries()
for name in sys.argv[3:]:
    rows = queries[name](spark, sys.argv[2]).count()
    print("rows", name, rows, flush=True)
spark.stop()
"""

NAMES = [
    "op1_edit_fingerprints", "op2_simhash", "op3_hmm_score", "op4_quality", "op5_lattice", "op6_substring",
    "op7_pieces", "op9_section_tokens", "op10_warc", "op11_collocations", "op13_repair",
]


def test_queries_without_the_package_on_workers(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), REPO, SF, *NAMES], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    rows = {line.split()[1]: int(line.split()[2]) for line in done.stdout.splitlines() if line.startswith("rows ")}
    assert sorted(rows) == sorted(NAMES) and all(n > 0 for k, n in rows.items() if k != "op11_collocations")
