"""Space-delimited capture index files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.functions.records import is_bad_number, number_or_zero, parse_compact_time

# The index fields, in the order a line holds them.
CDX_FIELDS = ("urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length")


def read_cdx(
    spark: SparkSession, path: str, fields=CDX_FIELDS, count_bad_fields: bool = False
) -> DataFrame:
    """Captures in the index files under ``path``, one per line."""
    return parse_cdx(spark.read.text(path), fields, count_bad_fields)


def parse_cdx(lines: DataFrame, fields=CDX_FIELDS, count_bad_fields: bool = False) -> DataFrame:
    """Captures in a ``value`` column of lines, batch or streaming.

    ``fields`` names the fields a line starts with, for indexes with another layout.
    Lines with fewer fields, and the format line an index file may start with, are
    dropped. With ``count_bad_fields`` a column tells how many numbers were malformed
    (they read as 0).
    """
    fields = list(fields)
    if "original" not in fields or "timestamp" not in fields:
        raise ValueError("an index line needs the fields original and timestamp")
    parts = F.split(F.trim("value"), r"\s+")
    rows = (
        lines.filter(~F.col("value").startswith(" CDX "))
        .withColumn("_f", parts)
        .filter(F.size("_f") >= len(fields))
    )
    at = {name: F.col("_f")[i] for i, name in enumerate(fields)}
    numbers = {"statuscode": "int", "length": "bigint", "offset": "bigint"}
    out = [at["original"].alias("url")]
    out.append(parse_compact_time(at["timestamp"]).alias("timestamp"))
    for name in ("urlkey", "mimetype", "statuscode", "digest", "length", "offset", "filename"):
        if name in at:
            kind = numbers.get(name)
            out.append((number_or_zero(at[name], kind) if kind else at[name]).alias(name))
    kept = [F.col(c) for c in lines.columns if c != "value"]
    parsed = rows.select(*out, *kept, "_f")
    digits = at["timestamp"]
    parsed = parsed.withColumn("year", F.substring(digits, 1, 4).try_cast("int"))
    parsed = parsed.withColumn("month", F.substring(digits, 5, 2).try_cast("int"))
    if count_bad_fields:
        bad = F.lit(0)
        for name, kind in numbers.items():
            if name in at:
                bad = bad + is_bad_number(at[name], kind).cast("int")
        parsed = parsed.withColumn("bad_fields", bad)
    return parsed.drop("_f")
