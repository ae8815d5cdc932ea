"""Give Python workers this package, however the session was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package's sources to the executors, once for an application.

    Spark itself serves the archive from the driver. Where the workers can import the package already,
    as with ``--py-files``, this changes nothing.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(package)
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "retailtide_sources.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, root))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
