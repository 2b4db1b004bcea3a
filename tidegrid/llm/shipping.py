"""Makes this library importable in Spark's Python workers, and sets how rows reach them."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Rows of whole texts are large; on either side a batch of the default 10,000 is held several times.
ROWS_PER_BATCH = 1000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once per application, as a zip that Spark serves."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tidegrid-code-"), "tidegrid.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark
