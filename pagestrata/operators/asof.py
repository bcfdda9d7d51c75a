"""The page as it was: the last capture of a URL at or before a given time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.operators.ordered import with_last_seen
from pagestrata.plans.ranges import ROWS_PER_RANGE
from pagestrata.schema import tie_breakers


def as_of(
    df: DataFrame,
    requests: DataFrame,
    columns: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every row of ``requests`` (``url``, ``at``, any others) with struct ``capture``,
    NULL where the URL was not captured by then.

    Captures and requests are put into one order by URL and time and the last capture
    is carried forward. Nothing is paired up, so a URL with very many captures and
    requests costs no more than their sum. Captures of URLs that nobody asks for are left
    out before. Bodies and other wide columns are not carried; they are joined at the end, one
    of each URL, time and tie-breakers.
    """
    columns = columns or df.columns
    ties = [c for c in tie_breakers(df) if c != "url"]
    place = ["url", "timestamp", *ties]
    wide = [c for c in columns if not isinstance(df.schema[c].dataType, T.AtomicType)]
    wide += [c for c in columns if isinstance(df.schema[c].dataType, T.BinaryType)]
    wide = [c for c in wide if c not in place]
    asked = requests.select("url", "at", F.struct(*requests.columns).alias("_request"))
    known = df.join(asked.select("url").distinct(), "url", "left_semi")
    found = known.select(
        "url",
        F.col("timestamp").alias("at"),
        F.lit(0).alias("_kind"),
        *[F.col(c).alias(f"_tie_{c}") for c in ties],
        F.struct(*[c for c in df.columns if c in place or c in columns and c not in wide]).alias("_capture"),
    )
    both = found.unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    carried = with_last_seen(
        both,
        ["url", "at", "_kind", *[f"_tie_{c}" for c in ties]],
        F.struct(F.col("url").alias("u"), F.col("_capture").alias("c")),
        F.col("_kind") == 0,
        "_last",
        rows_per_range,
    )
    last = F.when(F.col("_last.u") == F.col("url"), F.col("_last.c"))
    answered = carried.filter("_kind = 1").select("_request", last.alias("_c"))
    if wide:
        bodies = known.dropDuplicates(place).select(
            *[F.col(c).alias(f"_p_{c}") for c in place], *[F.col(c).alias(f"_w_{c}") for c in wide]
        )
        same = reduce(
            Column.__and__, [F.col(f"_c.{c}").eqNullSafe(F.col(f"_p_{c}")) for c in place]
        )
        answered = answered.join(bodies, F.col("_c").isNotNull() & same, "left")
    capture = F.struct(*[(F.col(f"_w_{c}") if c in wide else F.col(f"_c.{c}")).alias(c) for c in columns])
    return answered.select("_request.*", F.when(F.col("_c").isNotNull(), capture).alias("capture"))
