"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "cardex") -> SparkSession:
    """A session with adaptive execution; sizes and scaling belong to spark-submit."""
    spark = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``, which all executors share.

    Only a local master, where driver and executors are one process, may leave the
    setting out and gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="cardex-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
