"""Replacing stored files so that a job started again can finish what a lost one began.

New data is staged in ``_replacing`` below the table's folder, which readers pass
over. Once a journal beside it names what to delete and what to move, the
replacement will happen: :func:`recover` repeats deletes and moves that were cut
short, and removes staged data without a journal. Rows are never there twice; between
the deletes and the moves readers may miss some, so one job at a time
maintains a table and readers of a table in maintenance read it afterwards.
"""

import uuid

from pyspark.sql import SparkSession

STAGING = "_replacing"


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def staging(path: str) -> str:
    """A fresh folder for new data of the table at ``path``."""
    return f"{path}/{STAGING}/{uuid.uuid4().hex}"


def commit(spark: SparkSession, staged: str, deletes: list[str], moves: list[tuple[str, str]]) -> None:
    """Deletes and moves files or folders; after the journal is written, a crash cannot undo it.

    Both lists have as many entries as there are files or folders to replace.
    """
    steps = [("delete", old, "") for old in deletes] + [("move", *move) for move in moves]
    journal = spark.createDataFrame(steps, "step string, source string, target string")
    journal.coalesce(1).write.mode("overwrite").parquet(f"{staged}/journal")
    _finish(spark, staged)


def _finish(spark: SparkSession, staged: str) -> None:
    steps = spark.read.parquet(f"{staged}/journal").collect()
    for row in steps:
        if row["step"] == "delete":
            files, location = _files(spark, row["source"])
            files.delete(location, True)
    for row in steps:
        files, location = _files(spark, row["source"])
        if row["step"] == "move" and files.exists(location):
            target = _files(spark, row["target"])[1]
            files.mkdirs(target.getParent())
            if not files.rename(location, target):
                raise OSError(f"could not move {row['source']} to {row['target']}")
    discard(spark, staged)


def discard(spark: SparkSession, staged: str) -> None:
    files, location = _files(spark, staged)
    files.delete(location, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finishes or removes what earlier jobs left in the table's staging folder."""
    files, location = _files(spark, f"{path}/{STAGING}")
    if not files.exists(location):
        return
    for status in files.listStatus(location):
        staged = status.getPath().toString()
        # Spark marks a complete write, so half a journal counts as none
        if files.exists(_files(spark, f"{staged}/journal/_SUCCESS")[1]):
            _finish(spark, staged)
        else:
            discard(spark, staged)
