"""Tables between the steps of an operator, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from fareweather.session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows and read them again: later steps start from the files.

    The path is new for each call, so nothing that a live frame reads is replaced.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete written tables that no frame in use reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Spark copies the archive from the driver to the executors itself.
    """
    if spark.conf.get("fareweather.shipped", "") == spark.sparkContext.applicationId:
        return
    package = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='fareweather-')}/fareweather.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("fareweather.shipped", spark.sparkContext.applicationId)
