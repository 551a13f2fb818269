"""Session helpers: sensible defaults for stand-alone use, and tables in the shared folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "webglean", memory: str = "8g") -> SparkSession:
    """A local session for tests and benches. On a cluster, use the session the cluster gives."""
    folder = tempfile.mkdtemp(prefix="webglean-shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, named in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. Anywhere else a missing setting is
    an error: executors would write to their own disks and lose each other's rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="webglean-shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from its files, a folder for each value of ``by``.

    The rows are computed once, survive lost executors, and are removed by ``forget`` or with the
    folder, whose owner is whoever named it.
    """
    path = f"{shared_dir(df.sparkSession)}/webglean-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*saved: DataFrame) -> None:
    """Delete the files of tables made by ``cut_lineage`` that nothing reads any more."""
    for df in saved:
        spark = df.sparkSession
        folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
        for folder in folders:
            if "/webglean-" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
