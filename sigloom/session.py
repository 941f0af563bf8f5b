"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
METHOD_LIMIT_CONF, METHOD_LIMIT_DEFAULT = "spark.sql.codegen.hugeMethodLimit", "65535"


def local_session(app: str = "sigloom", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local data is small in bytes but not in work: keep all cores busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only where none is named."""
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="sigloom-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def compiled_methods(spark: SparkSession) -> None:
    """Stages whose generated method is too long for the JVM to compile (8,000 bytes) run operator by operator, not interpreted.

    A limit that the cluster names itself stays.
    """
    if spark.conf.get(METHOD_LIMIT_CONF, METHOD_LIMIT_DEFAULT) == METHOD_LIMIT_DEFAULT:
        spark.conf.set(METHOD_LIMIT_CONF, "8000")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor does not replay the whole plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
