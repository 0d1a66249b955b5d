"""Make this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

from pyspark.sql import SparkSession

_shipped: "weakref.WeakSet" = weakref.WeakSet()


def ensure(spark: SparkSession) -> None:
    """Send the package's sources to the executors once for each Spark context."""
    sc = spark.sparkContext
    if sc in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(root)
    folder = tempfile.mkdtemp(prefix="pagemill-")
    path = os.path.join(folder, "pagemill_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, dirs, names in os.walk(root):
            dirs[:] = [x for x in dirs if x != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    _shipped.add(sc)
