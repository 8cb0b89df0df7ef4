"""Makes this package importable in the Python workers of a session that was started elsewhere."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from quirework.session import scratch_folder

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers by way of the shared folder, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, f"quirework/{path.relative_to(package)}")
    target = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_folder(spark, 'code')}/quirework.zip")
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    out = system.create(target)
    try:
        out.write(packed.getvalue())
    finally:
        out.close()
    context.addPyFile(str(system.makeQualified(target).toString()))
    _sent.add(context.applicationId)
