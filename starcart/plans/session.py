"""Session settings the jobs rely on, and where scratch tables may go."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizes of scan and shuffle tasks, and the most of each. The driver keeps
# track of (scan tasks) x (shuffle partitions), so beyond these numbers tasks get
# larger instead; sorts and aggregates of a larger partition spill to disk.
_SHUFFLE_BYTES = 64 * 1024**2
_MOST_PARTITIONS = 50_000
_SCAN_BYTES = 128 * 1024**2
_MOST_SCANS = 100_000

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Let Spark choose joins and split skewed keys from the sizes it measures.

    The loads partition a big table once for both its join and its ``distinct``.
    If one key turns out to be hot, its partition is split all the same
    (``forceOptimizeSkewedJoin``), and the ``distinct`` then gets a shuffle of its
    own; without skew it has none. Where every partition of the looked-up side is
    small, it is hashed instead of sorting the big side; otherwise the sort-merge
    join stays.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def sized_settings(
    input_bytes: int,
    cores: int,
    most_partitions: int = _MOST_PARTITIONS,
    most_scans: int = _MOST_SCANS,
) -> dict[str, str]:
    """Settings for a session that reads ``input_bytes`` on ``cores`` cores.

    The number of shuffle partitions is an upper bound; adaptive execution merges
    what turns out small. With more than 2,000 of them Spark reports sizes of shuffle
    blocks as averages, which would hide a hot key from it: the block-size factor
    makes outliers visible again. It has to be set when the session starts.
    """
    partitions = max(cores, min(most_partitions, math.ceil(input_bytes / _SHUFFLE_BYTES)))
    per_scan = max(
        16 * 1024**2,
        min(_SCAN_BYTES, math.ceil(input_bytes / cores)),
        math.ceil(input_bytes / most_scans),
    )
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(per_scan),
        "spark.shuffle.accurateBlockSkewedFactor": "5",
        **RUNTIME_SETTINGS,
    }


def s3a_settings(
    endpoint: str,
    access_key: str,
    secret_key: str,
    ssl: bool = False,
    path_style: bool = True,
    provider: str = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
) -> dict[str, str]:
    """Session settings for an S3-compatible store, all values from the caller.

    To be given to the session builder; ``hadoop-aws`` has to be on the class path.
    """
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.aws.credentials.provider": provider,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def scratch_root(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``, else under its warehouse.

    On a cluster a folder of one machine is refused, unless the cluster's own ``spark.checkpoint.dir``
    names it: then that path is one all executors share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        on_cluster = not spark.sparkContext.master.startswith("local[")
        if on_cluster and ("://" not in shared or shared.startswith("file:")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/starcart-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a new folder under ``scratch_root`` and read back.

    Cuts the lineage, and fixes what depends on how rows were dealt, such as a partition's number.
    """
    path = f"{scratch_root(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
