"""What the operators share: tables kept in the cluster's folder, words and sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.session import shared_folder

#: Six ASCII blanks; everything else belongs to words.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    The lineage ends there, so that a lost executor costs a read and not a
    computation, and every later use sees the same rows.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs meanwhile sends Python batches of about ``size`` bytes, a row at least. A batch is
    held whole on both sides, by the JVM several times outside its heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Rows of up to some 24 bytes that a broadcast may hold.
FEW = 1_000_000


def if_few(df: DataFrame) -> DataFrame:
    """``df``, stored, with a hint to broadcast it if its rows, which are counted, are few."""
    df = stored(df)
    return F.broadcast(df) if df.count() <= FEW else df


#: A key that at least one row in ``HEAVY`` has is spread over ``SALTS`` tasks: at most ``HEAVY`` keys.
HEAVY, SALTS = 256, 1024


def with_lookup(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for each ``key``, all but ``weight``:
    about how many rows of ``left`` have the key. Keys that at least one in ``HEAVY`` of these rows has, by
    their hashes, get ``SALTS`` rows on the right, among which the rows on the left are spread."""
    right = stored(right)
    total = right.agg(F.sum(weight)).first()[0] or 0
    heavy = right.filter(F.col(weight) * HEAVY >= total).select(F.xxhash64(key).alias("hash")).limit(HEAVY).collect()
    own = F.xxhash64(key).isin(*[r["hash"] for r in heavy]) if heavy else F.lit(False)
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
    salted = left.withColumn("_salt", F.when(own, salt).otherwise(0))
    copies = F.explode(F.when(own, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return salted.join(right.drop(weight).withColumn("_salt", copies), [key, "_salt"]).drop("_salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """The number of words of ``text``, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
