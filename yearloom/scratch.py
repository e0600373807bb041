"""Intermediate datasets."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under a folder that all executors share.

    That is the session's ``spark.checkpoint.dir`` or, where it is unset, a
    folder in the warehouse. A warehouse on the driver's own disk will not do on
    a cluster and is refused there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
        one_machine = spark.conf.get("spark.master", "local").split("[")[0] == "local"
        if shared.startswith("file:") and not one_machine:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/yearloom-{label}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system Spark itself uses."""
    opened = spark._jvm.org.apache.hadoop.fs.Path(path)
    opened.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(opened, True)


def settled(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written once to a scratch folder and read back from there.

    What follows starts from files: nothing before them is computed again, also
    when executors are lost, and Spark knows their size when it plans a join.
    The folder is a new one, or ``path`` for a caller that removes it later.
    """
    path = path or scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
