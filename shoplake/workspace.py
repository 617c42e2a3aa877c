"""Where jobs keep intermediate tables and checkpoints."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from shoplake import params

_local_root = None


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a folder of
    this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="shoplake-")
    return _local_root


def tune(spark: SparkSession) -> None:
    """Session settings the jobs rely on.

    Event dates are UTC days. Adaptive execution sizes shuffles and splits hot
    keys of joins; the last setting makes it do so even where the split costs
    another shuffle, as when the next step groups by the join key.
    """
    spark.conf.set("spark.sql.session.timeZone", params.TIMEZONE)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder below the shared root."""
    return f"{shared_root(spark)}/shoplake/{label}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative jobs a reliable checkpoint folder if none is set yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


@contextmanager
def session_settings(spark: SparkSession, **settings: str):
    """Apply SQL settings (``__`` stands for a dot) and restore them afterwards."""
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
