"""Session helpers: a configured local session for tests/bench, and the
shared scratch/checkpoint folder every job writes intermediate data to."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "kilowatt",
                  extra: dict | None = None) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.driver.memory", os.environ.get("KILOWATT_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context)."""
    sc = spark.sparkContext
    try:
        d = sc._jsc.sc().getCheckpointDir()
        if d.isDefined():
            return d.get()
    except Exception:  # pragma: no cover - older py4j surfaces
        pass
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder. Where it is unset, a local master
    gets a folder of its own (tests); a cluster must name shared storage."""
    d = checkpoint_dir(spark)
    if d:
        return d
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    d = tempfile.mkdtemp(prefix="kilowatt-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return checkpoint_dir(spark) or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster): sinks, streams and lineage cuts of one call go here."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kilowatt-scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _fs(spark: SparkSession, path: str):
    """Hadoop path and file system of ``path``, a plain path or a URI as
    ``_metadata.file_path`` gives it. (Through the JVM: a classic session only.)"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if re.match(r"\w+:", path) else path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Paths directly below ``path``."""
    p, fs = _fs(spark, path)
    return [str(s.getPath().toString()) for s in fs.listStatus(p)]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes ``path`` and what is below it, if it exists."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def stored(df, name: str):
    """``df`` written to the shared scratch folder and read back: the lineage
    ends there, and whatever reads it sees the same rows in the same parts."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, total_cores: int, shuffle_target_bytes: int = 256 << 20,
               split_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on ``total_cores``
    task slots (e.g. 100 TB on 1000 executors × 8 cores):

    * scan splits of ``split_bytes`` (fewer, larger tasks than the 128 MB default);
    * an initial shuffle partition count that keeps each reducer near
      ``shuffle_target_bytes`` even before AQE coalesces (never fewer than 2
      waves of tasks), so a full-size shuffle does not spill per task;
    * AQE coalescing and skew-join splitting on, so hot keys are split at runtime.
    """
    parts = max(2 * total_cores, -(-input_bytes // shuffle_target_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_target_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(shuffle_target_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
