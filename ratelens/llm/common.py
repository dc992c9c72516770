"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = r"[\x20\x09-\x0D]+"  # fixed value: the blanks of the query contracts


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: the one the session names. Only a
    single-process local session that names none gets a scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table written once and read again."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


LEFT: list[str] = []  # tables this process has written and not deleted


class Scratch:
    """Tables written once to the shared folder and read again; ``clear``
    deletes those that nothing will read any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        LEFT.append(path)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, keep: int = 0) -> None:
        """Delete all but the ``keep`` tables written last."""
        gone = self.paths[: len(self.paths) - keep]
        _delete(self.spark, gone)
        self.paths = self.paths[len(gone):]


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in list(paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        if p in LEFT:
            LEFT.remove(p)


def clear_leftovers(spark: SparkSession) -> None:
    """Delete every table that this process has written to the shared folder and
    that is still there: once the results that read them are stored."""
    _delete(spark, LEFT)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; like checkpoint
    data it stays until ``clear_leftovers`` or until that folder is cleaned."""
    return Scratch(df.sparkSession).written(df, name)


HOT_KEYS = 1024   # keys dealt out at most
HOT_ROWS = 1000   # rows of a key below which it is never dealt out
SALTS = 64


def salted_join(rows: DataFrame, keyed: DataFrame, on: list[str], by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keyed`` (unique in ``on``), whatever share of the
    rows one key holds. Keys of more than one row in ``HOT_KEYS`` number
    ``HOT_KEYS`` at most, so their list is broadcast; their rows are dealt to
    ``SALTS`` tasks by a hash of the columns ``by``, and their keyed row stands
    once per salt."""
    total = rows.count()
    bar = max(HOT_ROWS, total // HOT_KEYS)
    hot = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > bar)
    hot = F.broadcast(hot.select(*on, F.lit(SALTS).alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*by), salts).cast("int")).drop("_salts")
    copies = keyed.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.hint("merge").join(copies, [*on, "_salt"], how).drop("_salt")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def crc_fold(col: Column, k: int) -> Column:
    """crc32 of the value's text, modulo k (the folds of the contracts)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(k)


def normal_blanks(text: Column) -> Column:
    """Null as empty; every run of blanks becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")
