"""The package on the executors: where their Python would not find it by itself, Spark ships it as a zip file."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[1]


def _found_anyway() -> bool:
    """Whether workers inherit a path with the package: the working folder, PYTHONPATH, or an installed package."""
    paths = {os.path.realpath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p}
    return os.path.realpath(_ROOT) in paths or _ROOT.name in ("site-packages", "dist-packages")


def ship(spark: SparkSession) -> None:
    """Once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_siltstone_shipped", False):
        return
    if not _found_anyway():
        file = Path(tempfile.mkdtemp(prefix="siltstone-zip-")) / "siltstone.zip"
        with zipfile.ZipFile(file, "w") as out:
            for source in sorted((_ROOT / "siltstone").rglob("*.py")):
                out.write(source, source.relative_to(_ROOT))
        context.addPyFile(str(file))
    context._siltstone_shipped = True
