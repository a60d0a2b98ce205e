"""Session settings and lineage cuts shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "millrace") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder named by ``spark.checkpoint.dir``.

    Iterative operators call this once per round. The files live on shared
    storage, so a lost executor costs a re-read and not a re-run of the loop.
    """
    _set_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table as Parquet below the shared folder and read it back.

    Unlike a checkpoint it keeps columns prunable and takes pushed filters. The
    folder carries the application id; its owner clears it.
    """
    spark = df.sparkSession
    _set_folder(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _set_folder(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="millrace-checkpoint-")
        context.setCheckpointDir(folder)


def col(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def present(df: DataFrame, names, missing: str = "skip") -> list[str]:
    """Names that exist in ``df``; ``missing='error'`` makes an absent one fail."""
    found = [n for n in names if n in df.columns]
    if missing == "error" and len(found) < len(list(names)):
        raise ValueError(f"columns not found: {sorted(set(names) - set(found))}")
    return found

