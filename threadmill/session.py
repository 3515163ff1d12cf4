"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "threadmill") -> SparkSession:
    """Session for tests and benchmarks (local mode; UI off; UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on (safe to call repeatedly). Settings that
    were lent for other work are taken back."""
    _take_back(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # JSON objects with repeated keys: keep the last value, like a dict load.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    _size_local_shuffles(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_LENT: dict[tuple[str, str], str | None] = {}


def _app(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", "")


def lend_setting(spark: SparkSession, key: str, value: str) -> None:
    """Set ``key`` until the next ``configure``, which restores what was there before."""
    _LENT.setdefault((_app(spark), key), spark.conf.get(key, None) if key in spark.conf.getAll else None)
    spark.conf.set(key, value)


def _take_back(spark: SparkSession) -> None:
    for app, key in [k for k in _LENT if k[0] == _app(spark)]:
        old = _LENT.pop((app, key))
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _size_local_shuffles(spark: SparkSession) -> None:
    """A single-machine session in which nobody has set the number of shuffle
    partitions gets 2 x its cores (explicit repartitions and stream state
    stores use this number and are not coalesced by AQE). Cluster sessions,
    and any value the user set, 200 included, are left alone."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session
        return
    key = "spark.sql.shuffle.partitions"
    if sc.master.startswith("local[") and key not in spark.conf.getAll:
        spark.conf.set(key, str(max(2, 2 * sc.defaultParallelism)))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``threadmill`` importable in the Python workers (Arrow/pandas UDFs,
    mapInArrow, stateful functions) the way ``--py-files`` does: zip the
    package once per SparkContext and ``addPyFile`` it. Harmless when the
    package is already installed on the executors."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: ship with the session's artifacts instead
        return
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="threadmill-pyfiles-")  # driver-side code artifact only
    zpath = os.path.join(out_dir, "threadmill.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    Only a local-mode session without the setting (tests) gets a fresh
    folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running threadmill jobs")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running threadmill jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="threadmill-ckpt-"))
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders that ``scratch_path`` has given out so far, for a long session
    between two runs: results that were not yet read from them are gone. Returns
    how many there were."""
    n = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
