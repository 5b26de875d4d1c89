"""What the operators share: cutting lineage, and a checked broadcast."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.session import shared_folder

#: Largest side, in bytes of Spark's own estimate, that is ever broadcast by hint.
BROADCAST_BYTES = 64 << 20


def _delete(spark: SparkSession, path: str) -> None:
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # the session is gone: so is what it could reach
        pass


def settle(df: DataFrame, *used: DataFrame) -> DataFrame:
    """The rows written as a table in the shared folder and read back: lineage is
    cut, the rows outlive any executor, and each use reads instead of computing
    again.  Settled tables in ``used`` are deleted, as nothing reads them any more;
    the others go when the driver's process ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for old in used:
        if (place := getattr(old, "_settled", None)) is not None:
            _delete(spark, place)
    atexit.register(_delete, spark, path)
    read = spark.read.schema(df.schema).parquet(path)
    read._settled = path
    return read


def fits(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether Spark's own estimate of the rows' size allows a broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """The broadcast hint behind a check of the size; else a shuffle join."""
    return F.broadcast(df) if fits(df) else df
