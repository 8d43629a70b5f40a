"""Session helpers for local runs, and the scratch space used by writers."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "wardwise") -> SparkSession:
    """Session for tests and the benchmark; on a cluster the submitted session is used as it is."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Where none is set, a local session gets a temporary one; on a cluster that would be a folder of
    one machine, so it raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wardwise-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


_written: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete what `scratch_path` has named in this process; results not yet read are lost.

    Runs by itself when the process ends in good order.
    """
    mine, _written[:] = list(_written), []
    return discard(spark, mine)


def discard(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders through Hadoop, wherever they are; returns how many there were."""
    java, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    return sum(bool(java(p).getFileSystem(conf).delete(java(p), True)) for p in paths)


class Temporary:
    """Tables that `materialize` writes inside are deleted at the end, but for those given to `keep`.

        with Temporary(spark) as tables:
            return tables.keep(result_that_reads_them)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> Temporary:
        self._before, self._kept = list(_written), []
        return self

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        out = materialize(df, name)
        self._kept.append(_written[-1])
        return out

    def __exit__(self, *failure) -> None:
        mine = [p for p in _written if p not in self._before and p not in self._kept]
        _written[:] = [p for p in _written if p not in mine]
        discard(self.spark, mine)


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the session may have gone first
            clear_scratch(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/wardwise/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
