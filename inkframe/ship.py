"""Makes this package importable on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ensure_shipped(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark application."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="inkframe-ship-")) / "inkframe_package.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(at))
    _DONE.add(sc.applicationId)
