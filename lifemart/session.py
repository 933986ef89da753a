"""What a Spark session needs before Python code of this library runs in its tasks, and tables that are computed once."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors once for each application, wherever the driver runs it from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), "lifemart_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)


def shared(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="lifemart-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a written table, for what passes over it more than once: it is computed once, and lost executors don't take it with them."""
    path = shared(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
