"""Registrable domains by a table of public suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.functions.urls import host_of

#: Rules up to this many are broadcast; more are joined by shuffle.
MOST_RULES = 1_000_000


def read_suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a file with one a line: what stands before the first blank; lines that begin with ``//`` and
    empty ones are none."""
    lines = spark.read.text(path).select(F.regexp_extract("value", r"^\s*(\S*)", 1).alias("rule"))
    return lines.filter("rule <> '' AND NOT startswith(rule, '//')")


def with_registrable_domain(df: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``suffix``, the public suffix of the host of ``url``, and ``registrable_domain``, that and one label more.

    ``rules`` (``rule``) are names as ``com`` and ``co.uk``, ``*.ck`` for any one label, and ``!www.ck`` for an
    exception, whose suffix is one label shorter. An exception wins, else the longest rule; where none
    fits, the last label is the suffix. Names with other letters fit in both spellings.
    A host that is a suffix itself has no ``registrable_domain``; addresses by number, and URLs that are NULL or
    have no host, have neither. NULL and empty rules are none. Columns of these two names are replaced.

    Hosts are looked up once for each number of labels that rules have, in a table that is
    broadcast (its rows are counted): no shuffle, whatever the hosts are.
    """
    known = _by_name(rules)
    sizes = known.agg(F.count("*").alias("n"), F.collect_set(F.struct("wild", "labels")).alias("kinds")).first()
    host = F.rtrim(host_of(F.col(url)), F.lit("."))
    # Addresses by number end in digits, or stand in brackets.
    name = F.when(host.rlike(r"[^\[\].0-9][^\[\].]*$") & ~host.startswith("["), F.split(host, r"\."))
    found = df.drop("suffix", "registrable_domain").withColumn("_labels", name)
    labels = F.col("_labels")
    best, exception = F.lit(1), F.lit(None).cast("int")
    for wild, n in sorted(tuple(k) for k in sizes["kinds"]):
        column = f"_kind_{'w' if wild else 'n'}{n}"
        own = known.filter((F.col("wild") == wild) & (F.col("labels") == n)).select(
            F.col("name").alias(f"{column}_name"), F.col("kind").alias(column)
        )
        own = F.broadcast(own) if sizes["n"] <= MOST_RULES else own
        key = F.when(F.size(labels) >= n, _last(labels, n - 1 if wild else n))
        found = found.withColumn("_key", key).join(own, F.col("_key") == F.col(f"{column}_name"), "left").drop(f"{column}_name", "_key")
        best = F.greatest(best, F.when(F.col(column) == "rule", n))
        exception = F.greatest(exception, F.when(F.col(column) == "exception", n - 1))
    length = F.coalesce(exception, best)
    suffix = F.when(labels.isNotNull(), _last(labels, length))
    domain = F.when(F.size(labels) > length, _last(labels, length + 1))
    return found.select(*[c for c in df.columns if c not in ("suffix", "registrable_domain")], suffix.alias("suffix"), domain.alias("registrable_domain"))


def registrable_domains(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Captures and hosts of each registrable domain. Captures are counted by host first, so that few
    rows are looked up and no domain is one group of captures."""
    hosts = df.groupBy(host_of(F.col("url")).alias("host")).agg(F.count("*").alias("captures"))
    found = with_registrable_domain(hosts, rules, "host").filter("registrable_domain IS NOT NULL")
    return found.groupBy("registrable_domain").agg(F.sum("captures").alias("captures"), F.count("*").alias("hosts"))


def _last(labels: Column, n: Column | int) -> Column:
    """The last ``n`` labels as a name; of no more labels than there are."""
    n = F.least(F.lit(n) if isinstance(n, int) else n, F.size(labels))
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def _by_name(rules: DataFrame) -> DataFrame:
    """Rules one by one: ``name`` (without ``*.`` or ``!``), its ``kind``, whether ``wild``, and the labels it takes."""

    @F.pandas_udf("string")
    def ascii_form(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in names:
            yield some.map(_ascii)

    rule = F.rtrim(F.lower(F.trim("rule")), F.lit("."))
    parts = rules.select(
        F.regexp_replace(rule, r"^(\*\.|!)", "").alias("name"),
        F.when(rule.startswith("!"), "exception").otherwise("rule").alias("kind"),
        rule.startswith("*.").alias("wild"),
    ).filter("name <> '' AND name <> '*'")
    both = parts.select(F.explode(F.array("name", ascii_form("name"))).alias("name"), "kind", "wild")
    size = F.size(F.split("name", r"\.")) + F.col("wild").cast("int")
    # A name that is both a rule and an exception is an exception.
    return both.groupBy("name", "wild").agg(F.min("kind").alias("kind")).withColumn("labels", size)


def _ascii(name: str) -> str:
    try:
        return name.encode("idna").decode("ascii")
    except UnicodeError:
        return name
