"""A Spark-native analytics engine for gridded features, weak labels and training data."""

from __future__ import annotations

import os
from pathlib import Path


def importable(spark) -> None:
    """Lets Python workers find this package where the driver found it; a cluster without that folder gets it by --py-files."""
    root, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
