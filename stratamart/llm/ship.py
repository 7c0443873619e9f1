"""Prepare a session for this subpackage's Python workers.

They get the modules, as they do not see the driver's import path, and batches of bounded size: long texts would else
fill batches of 64 MB, several copies of which live in the worker and in the executor's JVM at a time.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

BATCH_BYTES = 8 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkContext:
    """Add the modules as a Python file of the context, once, and lower the session's batch size if it is larger."""
    context = spark.sparkContext
    size = int(spark.conf.get(_BYTES).rstrip("bB"))
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BYTES, f"{BATCH_BYTES}b")
    if context.applicationId not in _sent:
        here = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="stratamart-ship-")) / "stratamart_llm.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in [here.parent / "__init__.py", *sorted(here.glob("*.py"))]:
                out.write(path, path.relative_to(here.parent.parent))
        context.addPyFile(str(archive))
        _sent.add(context.applicationId)
    return context
