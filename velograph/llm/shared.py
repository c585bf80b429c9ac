"""Helpers that every operator of this subpackage uses."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every contract here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


#: Paths that settle() has written, in order.
_SETTLED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only in one local process (tests) may it be unset; a local one is set then."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="velograph-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/velograph/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    _SETTLED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside are deleted at the end, when the caller has written what it needs of them."""
    mark = len(_SETTLED)
    try:
        yield
    finally:
        for path in _SETTLED[mark:]:
            drop_folder(spark, path)
        del _SETTLED[mark:]


def whole_text(column: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores until it isn't taken (names are compared without case)."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


def bit_table(rows: DataFrame, place: Column, bits: int) -> bytes:
    """A table of 2^bits bits, set at the places of rows; its size doesn't follow the input. Little-endian 64-bit words."""
    import numpy as np

    at = F.pmod(place, F.lit(1 << bits)).cast("long")
    words = rows.select(F.shiftright(at, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("b"))
    table = np.zeros(1 << (bits - 6), np.int64)
    for w, b in words.groupBy("w").agg(F.bit_or("b")).toLocalIterator():
        table[w] = b
    return table.tobytes()
