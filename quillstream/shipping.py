"""Give the Python workers this package, wherever the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quillstream-")) / "quillstream.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(home.rglob("*.py")):
            archive.write(source, source.relative_to(home.parent).as_posix())
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)
