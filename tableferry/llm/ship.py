"""Sends this package to the executors of a session, for sessions whose workers can't import it."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from tableferry.session import fresh_path

_PACKAGE = Path(__file__).resolve().parents[1]
_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: the package's modules as an archive on the workers' import path.

    The archive is written to the shared folder, and from there given out as with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    path = fresh_path(spark, "code") + ".zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(held.getvalue())
    finally:
        stream.close()
    context.addPyFile(path)
    _SENT.add(context.applicationId)
