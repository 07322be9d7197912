"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def own_dir() -> str:
    """A folder for sessions without spark.checkpoint.dir, which are local ones; it goes when the process ends."""
    path = tempfile.mkdtemp(prefix="lamina-")
    atexit.register(shutil.rmtree, path, True)
    return "file://" + path


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one that the context was given.

    Only a local session may go without one; it gets an own folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        path = own_dir()
    return path.rstrip("/")


@cache
def run_dir(app: str, shared: str) -> str:
    """This application's part of the shared folder, which goes when the driver ends."""
    spark = SparkSession.getActiveSession()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared}/lamina-{app}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{shared}/lamina-{app}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{run_dir(spark.sparkContext.applicationId, shared_dir(spark))}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of a sieve for each key, and at most (32 MB), above which more other rows pass.
SIEVE_BITS, SIEVE_MOST = 16, 1 << 28
#: Bytes of a bitmap as it is built, and of its pieces, of which a join copies one for each row.
BITMAP, PIECE = 4096, 128


def sifted(rows: DataFrame, key: Column, wanted: DataFrame, most: int = SIEVE_MOST) -> DataFrame:
    """Rows whose key (a hash, long) may be among wanted's only column; an exact join must follow.

    All rows with a wanted key pass, and one in 16 or fewer of the others while wanted has less than most / 16 keys.
    The hashes' bits are broadcast as a table of bitmaps, so rows that no join needs never enter its shuffle.
    """
    place, bitmap, number = (fresh(rows, c) for c in ("_place", "_bitmap", "_number"))
    bits = min(most, 1 << max(15, (SIEVE_BITS * wanted.count()).bit_length()))
    one = F.pmod(F.col(wanted.columns[0]), F.lit(bits)) + 1
    maps = wanted.select(one.alias(place)).groupBy(F.bitmap_bucket_number(place).alias(number)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bitmap))
    each = BITMAP // PIECE
    maps = maps.select(number, bitmap, F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias(place))
    maps = maps.select(((F.col(number) - 1) * each + F.col(place)).alias(number), F.substring(F.col(bitmap), F.col(place) * PIECE + 1, F.lit(PIECE)).alias(bitmap))
    maps = maps.where(F.bitmap_count(bitmap) > 0)
    marked = rows.withColumn(place, F.pmod(key, F.lit(bits)))
    at = F.pmod(F.col(place), F.lit(8 * PIECE)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = marked.join(F.broadcast(maps), F.shiftright(place, (8 * PIECE).bit_length() - 1) == F.col(number))
    return found.where(F.getbit(byte, at % 8) == 1).select(rows.columns)
