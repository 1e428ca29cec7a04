"""Readies a session: sends this package to the executors, so that their Python workers can import it, and bounds Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch; Spark's own bound is 64 MB, which JVM and worker both hold, once per core.
#: Workers make arrays of some 60 times a batch's size, and the JVM's native memory keeps buffers of that size.
BATCH_BYTES = 256 << 10
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Once per application; Spark itself hands the file to executors that come later or come back.

    The bound on batches is the session's own where that names one.
    """
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if not getattr(context, "statuta_shipped", False):
        top = Path(__file__).resolve().parent
        if top.is_dir():
            packed = Path(tempfile.mkdtemp(prefix="statuta-"), "statuta.zip")  # on the driver, which serves it
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
                for source in sorted(top.rglob("*.py")):
                    z.write(source, Path("statuta", source.relative_to(top)))
            context.addPyFile(str(packed))
        context.statuta_shipped = True
    return spark
