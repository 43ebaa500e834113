"""Intermediate tables in the folder that every executor reaches."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a session on one machine gets a folder of its own;
    on a cluster that is an error, since executors would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="tradewind-")
    return _OWN[application]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: worked out once, with a short lineage, and safe against lost executors.
    The files belong to the shared folder and go when its owner clears it."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
