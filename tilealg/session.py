"""Session helpers: a local session for tests and benches, the shared scratch folder,
and the broadcast size rule every join in the library goes through."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators rely on.  AQE coalesces small shuffle partitions and splits
# skewed sort-merge-join partitions at run time; Arrow carries the tile kernels.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tilealg", extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and benches (UI off, no ports beyond Spark's)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TILEALG_DRIVER_MEMORY", "16g")))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name storage that all executors share; without it this
    raises.  Only a local session (one machine by definition) gets a fresh local folder,
    which is recorded in the session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder "
                             "that all executors share")
        d = tempfile.mkdtemp(prefix="tilealg-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes a join side may have to be broadcast (the session's auto threshold)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = str(raw).strip().lower()
    mult = 1
    for suf, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10),
                   ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suf):
            raw, mult = raw[: -len(suf)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return 10 << 20


def maybe_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast ``df`` only when its *proven* upper size bound fits the threshold.

    ``max_bytes`` must be a bound that holds whatever the data is (e.g. shape-derived:
    keys are unique, so a vector of length n has at most n rows).  Otherwise the side
    is left to a shuffle join, and AQE may still broadcast it from runtime statistics.
    """
    limit = broadcast_limit(df.sparkSession)
    if limit > 0 and max_bytes <= limit:
        return F.broadcast(df)
    return df


def bounded(df: DataFrame, max_bytes: int) -> DataFrame:
    """A join side that is broadcast if its proven bound fits the threshold and never
    otherwise: the merge hint keeps Spark from broadcasting it by an estimate of its own,
    which takes an array column for one small value."""
    out = maybe_broadcast(df, max_bytes)
    return df.hint("merge") if out is df else out


def shuffle_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    except ValueError:
        return 200
