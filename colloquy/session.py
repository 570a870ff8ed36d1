"""Session helpers: code distribution to Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application.

    Spark's own file server distributes the archive, so workers need no shared
    installation of the package.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(here)
    folder = tempfile.mkdtemp()  # only the driver reads it, to serve the archive
    atexit.register(shutil.rmtree, folder, True)
    archive = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for top, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(top, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, here)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
