"""Session helpers: building a session for tests and finding the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "corpusloom") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    return (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("CORPUSLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local[") or spark.conf.get("spark.master", "") == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as named in spark.checkpoint.dir.

    Only where that setting is absent and the session is local does a temporary
    folder take its place; a cluster without the setting is an error, because a
    machine-local folder would be unreadable from other executors.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        at = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """checkpoint() into the shared folder: what follows survives the loss of executors."""
    spark = df.sparkSession
    at = shared_dir(spark)
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return df.checkpoint(eager=eager)


def cut_round(df: DataFrame) -> DataFrame:
    """The same for the rounds of a loop: what the planner has inferred about the columns is forgotten too.

    A checkpoint keeps the constraints of its plan, and a loop of joins and renamed columns multiplies them with every round.
    """
    spark = df.sparkSession
    done = cut_lineage(df)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False), spark)
