"""Writers: tab-separated and text outputs, several outputs from one
parent, and staging of intermediate results in the shared checkpoint
folder (to hand a result to later jobs and cut lineage)."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import escape_field
from ratelens.session import checkpoint_dir


def as_text(df: DataFrame, sep: str = "\t", escaped: bool = False) -> DataFrame:
    """One string column ``value``: the row's fields joined by ``sep``
    (NULL as empty, or ``escaped``)."""
    def field(c: str):
        return escape_field(f"`{c}`") if escaped else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(F.concat_ws(sep, *[field(c) for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", escaped: bool = False) -> None:
    """Key TAB value files: no header, no quoting, NULL written as empty.

    Fields are written byte for byte: edge blanks stay, and a tab or line
    break inside a value is not escaped (the age report's value holds tabs by
    design), so a reader that splits on tabs sees it as a separator. With
    ``escaped`` every value, NULL and empty text included, can be read back."""
    as_text(df, escaped=escaped).write.mode(mode).text(path)


def write_many(outputs: dict[str, DataFrame], parent: DataFrame | None = None,
               writer=write_tsv) -> None:
    """Several outputs that share ``parent``: the parent is persisted
    (memory, spilling to disk; a lost block is recomputed from lineage) so
    it is computed once, then released."""
    if parent is not None:
        parent.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for path, df in outputs.items():
            writer(df, path)
    finally:
        if parent is not None:
            parent.unpersist()


def stage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder
    and read it back: a hand-off between jobs that cuts lineage and survives
    executor loss (the folder is named by ``spark.checkpoint.dir``). Each
    call writes a new ``staged-<name>-<id>`` folder; ``unstage`` removes it."""
    spark = df.sparkSession
    path = stage_path(spark, name or "df")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_path(spark, name: str) -> str:
    """A new folder for files handed to a later reader, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/staged-{name}-{uuid.uuid4().hex[:12]}"


def unstage(staged: DataFrame) -> None:
    """Delete the folder of a staged DataFrame (not to be read afterwards)."""
    jvm = staged.sparkSession._jvm
    conf = staged.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        if "/staged-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
