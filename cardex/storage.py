"""Folders and small published records in the file system that Spark uses."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession


def _file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it is not there."""
    found, system = _file_system(spark, path)
    system.delete(found, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, by name; nothing if it is not there."""
    found, system = _file_system(spark, path)
    if not system.exists(found):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(found))


def publish(spark: SparkSession, path: str, row: tuple, schema: str) -> None:
    """Add a record to the log at ``path``: a file of one row, seen whole or not at all."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


def published(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """All records of the logs that ``path``, maybe a pattern, names."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return existing(lambda: reader.json(path).collect(), [])


def existing(read, otherwise):
    """What ``read`` returns, or ``otherwise`` where its path does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return otherwise


def existing_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table, empty if its path does not exist yet."""
    return existing(
        lambda: spark.read.schema(schema).parquet(path), spark.createDataFrame([], schema)
    )
