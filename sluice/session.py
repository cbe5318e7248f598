"""Session helpers: UTC semantics and a shared scratch/checkpoint root.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
store). Every intermediate table, streaming checkpoint and scratch output of
this package goes below it. Only a local master (tests, the bench) may leave it
unset and gets a temporary one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str = "local[*]",
    app_name: str = "sluice",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench; production jobs bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """hour/dayofweek/to_date and window alignment are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; set one only if unset."""
    sc = spark.sparkContext
    current = None
    try:
        current = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        current = None
    if not current:
        current = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
        if not current:
            if not sc.master.startswith("local"):
                raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="sluice-ckpt-")
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sluice/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Columnar and prunable, cuts lineage, and fixes generated ids; a lost executor
    costs a re-read. The folder goes when :func:`clear_scratch` is called.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete every staged table and scratch folder of this application's root.

    For the end of a job: results that still read staged tables become invalid.
    """
    return delete_path(spark, f"{checkpoint_root(spark).rstrip('/')}/sluice")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(conf).exists(jpath))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(conf)
    if not fs.exists(jpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly below ``path``."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isFile()]


def modified_at(spark: SparkSession, path: str) -> int | None:
    """Modification time of a file in milliseconds, or None when it does not exist."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getFileStatus(jpath).getModificationTime()) if fs.exists(jpath) else None


def read_text(spark: SparkSession, path: str) -> str:
    """The content of one small file."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(jpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create one small file with all of ``text`` or not at all: written under a name
    that readers skip, then renamed."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"could not create {path}")


def rename_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder within one file system."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(source, jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {path} to {target}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop FileSystem (used by explicit maintenance calls)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(conf)
    return bool(fs.delete(jpath, True))
