"""Tables written between two steps, in the folder that all machines of a cluster share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.  A session on one machine may do without and gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it names the folder that driver and executors share")
        app = spark.sparkContext.applicationId
        folder = _own.get(app) or _own.setdefault(app, f"file://{tempfile.mkdtemp(prefix='spanweave-')}")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once: written as Parquet to the shared folder and read from there."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def names_nothing(spark: SparkSession, path: str, error: Exception) -> bool:
    """Whether reading path failed because nothing is there.

    Also where the folder above can be read and the file system refuses the name in it for its colon, which some do: no
    such name can be stored there.  Any other refusal means that the path itself is wrong.
    """
    if isinstance(error, AnalysisException):
        return error.getCondition() == "PATH_NOT_FOUND"
    above, _, name = path.rstrip("/").rpartition("/")
    if not isinstance(error, IllegalArgumentException) or ":" not in name or not above.strip("/") or above.endswith((":", ":/")):
        return False
    exists(spark, above)
    return True


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there."""
    try:
        spark.read.text(path)
    except (AnalysisException, IllegalArgumentException) as error:
        if not names_nothing(spark, path, error):
            raise
        return False
    return True
