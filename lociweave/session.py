"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


COMPRESSION_ALLOWANCE = 8


def recommended_conf() -> dict[str, str]:
    """Settings the operators are designed for.

    Adaptive execution sizes and splits shuffle partitions at run time.  Splitting a skewed join
    is allowed even where it costs one more shuffle, so a variant that holds a large share of the
    rows never ends up in a single task.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; fall back to a scratch folder for local runs."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(shared)
    elif not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lociweave-"))


def written(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared checkpoint folder and read them from there, for rows that are used several times."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conf_bytes(spark: SparkSession, key: str) -> int:
    """A size setting in bytes; it may be written as ``128MB``, ``16m`` or a plain number."""
    text = spark.conf.get(key).strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for a plan (no job is run; unknown sizes come out huge)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """True if the optimizer's estimate is within Spark's own broadcast threshold.

    The estimate goes by compressed file sizes, hence the allowance.  Nothing is run to find out more:
    where the estimate is too high, adaptive execution still turns the join into a broadcast once it has
    seen the true size.
    """
    limit = conf_bytes(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold")
    return limit >= 0 and estimated_bytes(df) * COMPRESSION_ALLOWANCE <= limit


TASK_BYTES = 128 << 20
MOST_PARTS = 8192


def parts_for(df: DataFrame, least: int) -> int:
    """How many parts a table needs so that one task can hold and sort its own; at least ``least``.

    Goes by the optimizer's estimate, with the allowance above and nothing run; a table of unknown size gets ``least``.
    """
    size = estimated_bytes(df)
    if size >= 1 << 50:
        return least
    return max(least, min(MOST_PARTS, -(-size * COMPRESSION_ALLOWANCE // TASK_BYTES)))
