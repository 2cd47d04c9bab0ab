"""Table reading, the shared scratch folder and small session helpers."""

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that leaves the setting out, where driver and executors share one machine,
    gets a folder of its own, one per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="stairfare-")
    return _OWN[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def written(spark: SparkSession, folder: str) -> bool:
    """Whether an earlier start has left ``folder``."""
    try:
        spark.read.schema("x int").parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
