"""Where a run may keep intermediate tables and stream checkpoints."""

import tempfile
import uuid


def scratch_dir(spark, label):
    """A fresh folder below the shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster the executors
    would each write to their own disk and lose it with the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="marketpulse-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
