"""The package reaches the Python workers wherever the driver was started."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
# The workers get neither the start folder nor a path: only what the driver sends.
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from wxpipe.session import build_session, ship_package

spark = build_session("elsewhere", "local[2]", {"spark.ui.showConsoleProgress": "false"})
ship_package(spark)  # a second time is nothing new

def where(batches):
    import pyarrow as pa
    import wxpipe.functions.names as found

    for batch in batches:
        names = [found.__file__] * batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(names)], names=["file"])

files = {r.file for r in spark.range(2).mapInArrow(where, "file string").collect()}
print("FOUND", *files)
spark.stop()
"""


def test_workers_import_the_package_from_another_folder(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script), str(REPO)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240, check=False,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    found = next(x for x in done.stdout.splitlines() if x.startswith("FOUND"))
    assert "wxpipe.zip" in found
