"""Python workers that find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

HOME = str(Path(__file__).resolve().parents[1])


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if that folder is shared.

    On a cluster without such a folder the package is installed or sent along (``--py-files``) as usual.
    """
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, HOME])
