"""Session, table and size helpers that every other module uses."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast by hand only if it has no more rows than this.
BROADCAST_ROWS = 50_000
#: A key is hot if it holds more than this share of all rows; so there are fewer than 1/HOT_SHARE hot keys at any scale.
HOT_SHARE = 0.001
#: Below this many rows a key is never worth splitting.
HOT_ROWS = 50_000


def session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per context, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_gradeweave_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(), "gradeweave.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(target)
    sc._gradeweave_shipped = True


def load(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; set a local one only where none is named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "gradeweave-checkpoints"))


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder; the result survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after its size was checked; beyond the bound Spark plans a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """Inner join of rows with one-row-per-key groups, where single keys may hold a third of all rows.

    Keys of more than max(HOT_ROWS, HOT_SHARE * total) rows number fewer than 1 / HOT_SHARE, so that part of ``groups``
    can be broadcast at any scale and its rows stay where they are; all other keys take the shuffled join.
    ``size`` is the column of ``groups`` with the number of rows; keys must not be NULL.
    """
    bound = max(HOT_ROWS, int(total * HOT_SHARE))
    if total <= bound:
        return rows.join(groups, list(keys))
    hot = groups.filter(F.col(size) > bound)
    hot_keys = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    tagged = rows.join(hot_keys, list(keys), "left")
    return (
        tagged.filter("_hot").drop("_hot").join(F.broadcast(hot), list(keys))
        .unionByName(tagged.filter("_hot IS NULL").drop("_hot").join(groups.filter(F.col(size) <= bound), list(keys)))
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
