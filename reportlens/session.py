"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reportlens")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session: the one ``spark.checkpoint.dir``
    names. Only a single-machine session without that setting gets a temporary
    folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="reportlens-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table to the shared checkpoint folder and read it back.

    Unlike ``checkpoint()`` this computes the last stage once, and readers can
    pick columns. Lost executors only re-read the table.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.rsplit("/", 1)[0].endswith(folder.split(":", 1)[-1].rstrip("/")) and path.rsplit("/", 1)[1].startswith("table-"):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame) -> DataFrame:
    """Spread an input of fewer splits than cores over all cores.

    A table of one small file is read by one task; row-wise text work on it
    would use one core. Inputs with enough splits are returned unchanged, so a
    large table never pays for this shuffle. Meant for a plain scan: asking a
    plan with shuffles for its partitions would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
