"""The checkpoint folder comes from the session when it is configured."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from cadenza.session import build_session, ensure_checkpoint_dir
from cadenza.operators.positions import pin
spark = build_session("local[2]", shuffle_partitions=2, conf={{"spark.checkpoint.dir": {shared!r}, "spark.ui.enabled": "false"}})
print("DIR", ensure_checkpoint_dir(spark))
pin(spark.range(5))
print("CLEAN", spark.conf.get("spark.cleaner.referenceTracking.cleanCheckpoints"))
"""


def test_configured_checkpoint_dir_is_used():
    shared = os.path.join(tempfile.mkdtemp(prefix="cz-shared-"), "ckpt")
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, shared=shared)],
                         capture_output=True, text=True, timeout=300)
    lines = dict(line.split(" ", 1) for line in out.stdout.splitlines()
                 if line.startswith(("DIR ", "CLEAN ")))
    assert shared in lines["DIR"]
    assert lines["CLEAN"] == "true"
    assert any(f.startswith("part-") for _, _, names in os.walk(shared) for f in names)


GIVEN = """
import sys
sys.path.insert(0, {repo!r})
from cadenza.session import build_session
spark = build_session("local[1]", conf={{"spark.ui.enabled": "false"}})
for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"):
    print("CONF", spark.conf.get(key))
"""


def test_settings_given_elsewhere_win():
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=(
        "--conf spark.sql.session.timeZone=America/New_York "
        "--conf spark.sql.adaptive.skewJoin.skewedPartitionFactor=9 pyspark-shell"))
    out = subprocess.run([sys.executable, "-c", GIVEN.format(repo=REPO)], env=env,
                         capture_output=True, text=True, timeout=300)
    got = [line.split()[1] for line in out.stdout.splitlines() if line.startswith("CONF ")]
    assert got == ["America/New_York", "9", "128m"]
