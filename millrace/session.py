"""Session helpers: table access, the shared scratch folder, written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_PARALLEL_SCANS = 2


def local_session(cores: int = 8, app: str = "millrace", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the one it hands you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def spread(scan: DataFrame) -> DataFrame:
    """Even out a scan that has fewer splits than the cluster has cores.

    A large input has far more splits than cores and is returned untouched, so the
    exchange is only ever paid for by small inputs. Call it on plain scans.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= _PARALLEL_SCANS * cores:
        return scan
    return scan.repartition(cores)


def limit_groups_early(spark: SparkSession, rows: int) -> None:
    """Let rank filters of up to ``rows`` rows per group run before the exchange as well.

    Spark does so only up to a threshold, which this raises for the session if needed.
    """
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(spark.conf.get(name, "1000")) < rows:
        spark.conf.set(name, str(rows))


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def written(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives lost executors.

    ``codec`` is another compression than the session's, such as a denser one for texts.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
