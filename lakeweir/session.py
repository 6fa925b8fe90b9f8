"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings every job relies on. All of them can be overridden by the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str,
    conf: Mapping[str, str] | None = None,
    packages: tuple[str, ...] = (),
    master: str | None = None,
) -> SparkSession:
    """Session with ``DEFAULTS`` overlaid by ``conf``.

    Connectors come in as Maven coordinates (``packages``), so a job does not
    depend on jar files lying at a fixed place on one machine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **(conf or {})}
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions_for(data_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle width for ``data_bytes`` of shuffled data.

    Two waves per core at least, so adaptive execution has something to
    coalesce, and partitions of about ``target_bytes`` on large inputs.
    """
    return max(2 * cores, -(-data_bytes // target_bytes))


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local session that names none:
    executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lakeweir-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
