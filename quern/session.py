"""Session helpers: table access, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "quern", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers that don't have it: its
    source goes to the executors as a zip file, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    here = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="quern-"), "quern.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(here.rglob("*.py")):
            out.write(f, f.relative_to(here.parent))
    context.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole of one parquet table; column pruning is left to Catalyst."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir`` where the cluster
    names one; only in local mode is a private folder made instead."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not (master.startswith("local[") or master == "local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="quern-")
    spark.sparkContext.setCheckpointDir(made)
    return made


_FOLDERS: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """This application's own folder within the shared one; it goes when the
    Python process ends, also after a failure."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_dir(spark)}/quern-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark.sparkContext, _FOLDERS[app])
    return _FOLDERS[app]


def _remove(context: SparkContext, folder: str) -> None:
    try:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration() if context._jsc else context._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # the JVM is gone already; where it can be, the folder is a local one
        if folder.startswith("file:"):
            shutil.rmtree(folder.removeprefix("file://"), ignore_errors=True)


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the application's shared folder and read it back.

    Used where a result feeds several branches or an iteration: the lineage is
    cut, so a lost executor costs at most the stage at hand, and the columnar
    file is far smaller than a row checkpoint.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, limit: int) -> list | None:
    """The rows of ``df`` if there are no more than ``limit``, else None.

    The size check in front of every broadcast: the caller takes another way
    when None comes back."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def spread(col, ways: int):
    """A salt in [0, ways) derived from a column's hash (stable on retry)."""
    return F.pmod(F.xxhash64(col), F.lit(ways)).cast("int")


#: A key with fewer rows than this does no harm unsalted; of the others, the
#: most frequent so many are salted (each of the rest holds less than a
#: thousandth of all rows).
HOT_ROWS, HOT_KEYS = 20_000, 1000


def salted_join(rows: DataFrame, small: DataFrame, on: list[str], how: str, salt_by: str, ways: int = 16, counted: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Equi-join for a side whose keys may be extremely skewed.

    The hot keys of ``rows`` are counted (map-side combined; at most HOT_KEYS
    come to the driver). Their rows are spread over ``ways`` salts, and their
    rows of ``small`` (one per key, or a few) are repeated once per salt, so a
    key that holds a third of all rows is read by ``ways`` tasks; every other
    key is joined as it is. Keys with a NULL match nothing and are spread over
    all tasks. ``how`` is inner, left or left_semi. ``counted`` is a cheaper
    relation with the same keys, where ``rows`` has been derived; ``sizes`` has
    the keys and their rows (``_n``) where they are known already.
    """
    if sizes is None:
        sizes = (rows if counted is None else counted).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") >= HOT_ROWS).orderBy(F.desc("_n")).limit(HOT_KEYS).select(*on).collect()
    if not hot:
        return rows.join(small, on, how)
    null = F.lit(False)
    for c in on:
        null = null | F.col(c).isNull()
    whole = [r for r in hot if all(v is not None for v in r)]
    keys = F.broadcast(rows.sparkSession.createDataFrame(whole, rows.select(*on).schema).withColumn("_hot", F.lit(True)))
    # a NULL key meets no row of the other side, whatever its salt
    left = rows.join(keys, on, "left").withColumn("_salt", F.when(F.col("_hot") | null, spread(F.col(salt_by), ways)).otherwise(0)).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(keys, on, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
