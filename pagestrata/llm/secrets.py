"""Secrets in texts: known patterns, and runs whose sliding-window entropy is high."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.llm.common import stored

#: The patterns (fixed values); the value is the group of the first.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
#: Runs that are no secrets however they look: UUIDs, placeholders, rows of keys.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
    r"|(?i:example|sample|placeholder|dummy|xxxxxxxx|qwertyuiop|asdfghjkl)"
    r"|(?i:abcdefghijkl)|0123456789"
)
#: What may stand right before a run that is a checksum or an embedded picture.
ALLOWED_BEFORE = r"(?i:sha1|sha256|sha384|sha512|md5|etag|integrity|;base64)[-:=,\x20\"']{1,3}$"


@dataclass(frozen=True)
class CharClass:
    """Runs of ``chars`` of ``window`` characters or more; a window is hot from ``bits`` on."""

    kind: int
    chars: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.chars}]{{{self.window},}}"


CLASSES = (
    CharClass(3, "0-9A-Fa-f", 24, 3.2),
    CharClass(4, r"A-Za-z0-9+/=_-", 24, 4.0),
)
#: Entropies are compared as whole numbers of this part of a bit, free of rounding.
PART = 1 << 20
#: How much of the text before a run the allow-list looks at.
BEFORE = 24


def find_secrets(docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES) -> DataFrame:
    """All secrets in the whole texts of ``docs`` (``doc_id``, ``text``).

    Returns one row per row of ``docs``: ``doc_id`` and ``spans``, an array of structs
    (``start``, ``rank``, ``end``; code points, end exclusive) in order, where ``rank`` is the
    place in ``KINDS``. The three known patterns are matched from the left without overlap
    and matches that are too short are dropped. For each character class, a window slides
    over every run of the class; the counts of the character that enters and of the one that
    leaves change its entropy, and overlapping hot windows are one span. Runs that the
    allow-list knows, and spans inside one of a known pattern, give none.

    Only documents that may have a secret are taken apart. Their matches become rows
    with places relative to the match before, which a sum per document turns into spans.

    NULL and empty texts have no spans. Repeated rows and NULL ids are rows of their own.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    may_have = F.col("text").rlike(
        "|".join([f"(?:{ASSIGN})", r"AKIA[A-Z0-9]{12}", HEX, *[c.pattern for c in classes]])
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    clean = texts.filter(~may_have).select("doc_id", none.alias("spans"))

    patterns = [(0, ASSIGN), (1, ACCESS), (2, HEX), *[(c.kind, c.pattern) for c in classes]]
    per_kind = [_matches(kind, pattern) for kind, pattern in patterns]
    # A row of no kind keeps the document if no match is left.
    itself = F.array(
        F.struct(
            F.lit(-1).alias("rank"), F.lit(0).alias("i"), F.lit("").alias("gap"),
            F.lit("").alias("match"), F.lit("").alias("value"),
        )
    )
    rows = (
        texts.filter(may_have)
        .select("doc_id", F.monotonically_increasing_id().alias("row"), F.concat(itself, *per_kind).alias("m"))
        .select("doc_id", "row", F.explode("m").alias("m"))
    )
    upto = Window.partitionBy("row", "m.rank").orderBy("m.i")
    end = F.sum(F.length("m.gap") + F.length("m.match")).over(upto)
    found = rows.withColumn("end", end).select(
        "doc_id", "row", F.col("m.rank").alias("rank"),
        (F.col("end") - F.length("m.match")).alias("start"), "end",
        F.when(F.col("m.rank") > 2, F.col("m.match")).alias("run"),
        F.when(F.col("m.rank") > 2, F.substring(F.col("m.gap"), -BEFORE, BEFORE)).alias("before"),
        F.length("m.value").alias("n_value"),
    )
    long_enough = (
        (F.col("rank") < 0) | (F.col("rank") > 2)
        | (F.col("rank") == 0) & (F.col("n_value") >= 8)
        | (F.col("rank") == 1) & (F.col("end") - F.col("start") >= 16)
        | (F.col("rank") == 2)
    )
    allowed = F.col("run").rlike(ALLOWED) | F.col("before").rlike(ALLOWED_BEFORE)
    found = stored(found.filter(long_enough & ~F.coalesce(allowed, F.lit(False))))

    span = ["doc_id", "row", "rank", "start", "end"]
    known = found.filter("rank <= 2").select(*span)
    spans = known
    for c in classes:
        spans = spans.unionByName(_hot(found.filter(F.col("rank") == c.kind), c).select(*span))
    by_start = Window.partitionBy("row").orderBy("start", "rank")
    covered = F.max(F.when(F.col("rank") <= 2, F.col("end"))).over(by_start)
    inside = (F.col("rank") > 2) & F.coalesce(covered >= F.col("end"), F.lit(False))
    spans = spans.withColumn("_inside", inside).filter(~F.col("_inside"))
    dirty = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(
            F.collect_list(F.when(F.col("rank") >= 0, F.struct("start", "rank", "end")))
        ).alias("spans"),
    )
    return dirty.select("doc_id", "spans").unionByName(clean)


def _matches(kind: int, pattern: str) -> Column:
    """All matches in order: the text since the match before, the match, its first group."""
    text = F.col("text")
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == 0 else matches
    zipped = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value"))
    numbered = F.transform(
        zipped,
        lambda m, i: F.struct(
            F.lit(kind).alias("rank"), i.alias("i"), m["gap"].alias("gap"),
            m["match"].alias("match"), m["value"].alias("value"),
        ),
    )
    # The text behind the last match stands alone in the zip.
    return F.filter(numbered, lambda m: m["match"].isNotNull())


def _hot(runs: DataFrame, c: CharClass) -> DataFrame:
    """The spans of overlapping hot windows in ``runs``.

    ``n * log2 n`` summed over the characters of a window falls as its entropy rises. When
    a character enters, the sum changes by its count before; when one leaves, by its count
    at that time, which is the number of the same character in the window that it opens.
    """
    terms = [0] + [round(n * math.log2(n) * PART) for n in range(1, c.window + 1)]
    table = F.array(*[F.lit(t) for t in terms])
    most = math.floor((math.log2(c.window) - c.bits) * c.window * PART)

    run = ["doc_id", "row", "rank", "start"]
    chars = runs.select(*run, F.posexplode(F.split("run", "", -1)).alias("i", "c")).filter("c <> ''")
    same = Window.partitionBy("row", "start", "c").orderBy("i")
    ahead = F.count("*").over(same.rangeBetween(-(c.window - 1), -1)).cast("int")
    onward = F.count("*").over(same.rangeBetween(0, c.window - 1)).cast("int")
    chars = chars.withColumn("_in", F.get(table, ahead + 1) - F.get(table, ahead)).withColumn(
        "_out", F.get(table, onward) - F.get(table, onward - 1)
    )
    along = Window.partitionBy("row", "start").orderBy("i")
    change = F.col("_in") - F.coalesce(F.lag("_out", c.window).over(along), F.lit(0))
    hot = (
        chars.withColumn("_change", change)
        .withColumn("_sum", F.sum("_change").over(along))
        .filter((F.col("i") >= c.window - 1) & (F.col("_sum") <= most))
    )
    apart = F.coalesce(F.col("i") - F.lag("i").over(along) > c.window, F.lit(True))
    islands = hot.withColumn("_new", apart.cast("int")).withColumn("_island", F.sum("_new").over(along))
    return islands.groupBy("doc_id", "row", "rank", F.col("start").alias("_start"), "_island").agg(
        (F.col("_start") + F.min("i") - (c.window - 1)).alias("start"),
        (F.col("_start") + F.max("i") + 1).alias("end"),
    )


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts per known kind, the hash of their spans, and all spans, as text."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def as_text(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])
            ),
            ",",
        )

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(as_text(F.filter("spans", lambda s: s["rank"] <= 2)), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )
