"""Session settings and the shared folder that durable intermediate data goes to."""

from __future__ import annotations

import logging
import tempfile

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Shuffle data per reduce task: fits in memory beside a few others, and is worth a task.
REDUCE_BYTES = 200 * 1024**2


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Reduce tasks for a shuffle of that size. AQE joins what turns out small, but it does not
    cut up a plain shuffle, so the number to start from must suit the largest one."""
    return max(200, -(-shuffled_bytes // REDUCE_BYTES))


def build_session(
    app: str = "stratamart",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the library's results depend on (UTC) or run best with.

    ``shuffled_bytes`` is the expected size of the largest shuffle, about the key columns of what
    a run merges; Spark's own 200 partitions are far too few for terabytes.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Sorted runs of the same timestamps compress well, so ask for larger output slices.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
        **conf,
    }
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffled_bytes))
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    if shuffled_bytes is None and partitions == "200" and not spark.sparkContext.master.startswith("local"):
        log.warning("200 shuffle partitions suit some %d GB; state shuffled_bytes for more", 200 * REDUCE_BYTES >> 30)
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Surrogate keys and day boundaries are texts of instants: fix the zone they are written in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without one; it gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    # Spark takes this setting at its start alone, so what a session has chosen is kept with its context.
    context = spark.sparkContext
    if not hasattr(context, "stratamart_dir"):
        context.stratamart_dir = tempfile.mkdtemp(prefix="stratamart-")
    return context.stratamart_dir
