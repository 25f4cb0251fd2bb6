"""Session helpers: shared checkpoint folder, lineage cuts, partition sizing."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Input bytes one shuffle partition should stand for.
PARTITION_BYTES = 64 << 20
#: Estimates from here on are Spark's stand-in for sizes it does not know.
UNKNOWN = 1 << 55

#: How much older than the newest one a file of a stream may be; Spark's default, 7 days, drops late files for ever.
FILE_AGE = "36500d"


def local_session(cores: int | str = 8, app: str = "simloom", **conf: object) -> SparkSession:
    """A session for one machine, with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="simloom-"), "simloom")
    archive = shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir`` (Spark sets the context's
    folder from it).  Only a local master, where every task runs on this
    machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local[") or context.master == "local":
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="simloom-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return context.getCheckpointDir()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


_SCRATCH: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """This application's folder for tables between steps, in the shared folder."""
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        folder = f"{checkpoint_dir(spark)}/scratch-{application}"
        _SCRATCH[application] = folder

        def clear() -> None:
            try:
                remove(spark, folder)
            except Exception:  # the session, and with it a local folder, may be gone before
                pass

        atexit.register(clear)
    return _SCRATCH[application]


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """``df`` written to the shared folder and read again.

    Used inside iterations: the new plan is a plain scan whose size statistics
    come from the files, so the optimizer sees real sizes in every round.  The files
    are those of this application, and are deleted when its driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written`, once nothing reads it."""
    root = scratch(spark)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    seen = set()
    for name in df.inputFiles():
        folder = os.path.dirname(name)
        if folder in seen or os.path.basename(os.path.dirname(folder)) != os.path.basename(root.rstrip("/")):
            continue
        seen.add(folder)
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def _file(spark: SparkSession, path: str) -> tuple[object, object]:
    """The file system and the path of a file name."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def read_manifest(spark: SparkSession, folder: str) -> str | None:
    """The latest manifest of a folder; None if there is none."""
    system, place = _file(spark, folder)
    if not system.exists(place):
        return None
    names = [f.getPath().getName() for f in system.listStatus(place)]
    names = sorted(n for n in names if n.startswith("manifest-") and n.endswith(".json"))
    if not names:
        return None
    stream = system.open(_file(spark, f"{folder}/{names[-1]}")[1])
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_manifest(spark: SparkSession, folder: str, text: str) -> None:
    """Add a manifest to a folder: written under another name, then moved in one step, and never changed.

    Whoever reads sees the manifest before or this one, never a part of it.
    """
    system, place = _file(spark, folder)
    system.mkdirs(place)
    names = [f.getPath().getName() for f in system.listStatus(place)]
    last = max((int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")), default=0)
    _, beside = _file(spark, f"{folder}/_{uuid.uuid4().hex}")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(beside, _file(spark, f"{folder}/manifest-{last + 1:09d}.json")[1]):
        raise OSError(f"the manifest of {folder} could not be added")


def whole_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables below a folder that were written to their end, in order."""
    system, place = _file(spark, folder)
    if not system.exists(place):
        return []
    found = [f.getPath() for f in system.listStatus(place) if f.isDirectory()]
    return sorted(p.getName() for p in found if system.exists(_file(spark, f"{p.toString()}/_SUCCESS")[1]))


def remove(spark: SparkSession, path: str) -> None:
    system, place = _file(spark, path)
    system.delete(place, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``: for a file scan the files' size; 0 if it is not known."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 if size >= UNKNOWN else size


def fan_out(df: DataFrame, per_partition: int = PARTITION_BYTES, copies: float = 1.0) -> int:
    """Number of shuffle partitions for ``copies`` times the bytes of ``df``.

    Never below the session's setting, so that small inputs use all cores, and
    proportional to the input beyond it, so that partition size stays constant.
    """
    need = int(input_bytes(df) * copies) // per_partition + 1
    return max(shuffle_partitions(df.sparkSession), need)
