"""Benchmark questions in documents, also with other numbers, names and units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.llm.common import if_few, stored

#: A leak is a run of so many words; of an item with fewer, all but one.
RUN = 13
#: Words of a window. Every run of 2 * WINDOW - 1 words holds one that starts at a multiple.
WINDOW = 5
SHORTEST = 2 * WINDOW - 1
#: Share of the words of a run with other values that must be literal, so that tables of
#: numbers are no leaks.
LITERAL = 0.6

# Placeholders are characters for private use, which are taken out of texts before.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
_OWN = f"{NUMBER}-{UNIT}"
#: Units that may follow a number.
UNITS = (
    "%|percent|km|cm|mm|m|miles?|feet|ft|inch(?:es)?|kg|mg|g|grams?|lbs?|pounds?|oz|tons?|ml|l|"
    "lit(?:er|re)s?|gallons?|hours?|hrs?|h|minutes?|min|seconds?|sec|s|days?|weeks?|months?|years?|"
    "dollars?|cents?|euros?|usd|eur|kmh|mph|degrees?|kb|mb|gb|tb|watts?|kw|volts?|v"
)
# Possessive, and never begun within itself: a long chain is gone through once and without recursion.
_NUMERAL = r"\d++(?:[.,:/]\d++)*+"
# A capitalised word within a sentence, which the character before the blanks shows.
_NAMES = r"\p{Lu}(?<=[\p{L}\p{N},;:]\s{1,3}\p{Lu})[\p{Ll}\p{M}]+"
_MEASURES = rf"(?<!\d)(?<!\d[.,:/])({_NUMERAL})\s{{0,3}}(?i:({UNITS}))(?![\p{{L}}\p{{N}}])"
_OTHERS = rf"(?<![{NUMBER}\d.,:/])({_NUMERAL})"
_SLOTS = rf"{NUMBER}[\d.,:/]*\d|{NAME}[\p{{L}}\p{{M}}]+|{UNIT}(?:\p{{L}}+|%)"
_VALUES = rf"([{_OWN}])(?:(?<={NUMBER})[\d.,:/]*\d|(?<={NAME})[\p{{L}}\p{{M}}]+|(?<={UNIT})(?:\p{{L}}+|%))"
_LITERALS = r"[\p{L}\p{M}\p{N}]+"
_NUMERIC = rf"^(?:{NUMBER}|\p{{N}}+)$"


def marked(text: Column) -> Column:
    """``text`` with a placeholder before each number, name and unit."""
    text = F.regexp_replace(text, f"[{_OWN}]", " ")
    text = F.regexp_replace(text, _NAMES, f"{NAME}$0")
    text = F.regexp_replace(text, _MEASURES, f" {NUMBER}$1 {UNIT}$2 ")
    return F.regexp_replace(text, _OTHERS, f" {NUMBER}$1 ")


def template(text: Column) -> Column:
    """The template words of ``text``, a blank after each: literal words in lower case, and
    placeholders without their values."""
    words = F.lower(F.regexp_replace(marked(text), _VALUES, " $1 "))
    return F.ltrim(F.concat(F.regexp_replace(words, rf"[^\p{{L}}\p{{M}}\p{{N}}{_OWN}]+", " "), F.lit(" ")))


def words_of(text: Column) -> Column:
    """The same words as ``template``, with the values of the placeholders."""
    return F.regexp_extract_all(F.lower(marked(text)), F.lit(f"{_SLOTS}|{_LITERALS}"), F.lit(0))


def plain(text: Column) -> Column:
    """The words of ``text`` in lower case, a blank after each, without placeholders."""
    words = F.regexp_replace(F.lower(F.upper(text)), r"[^\p{L}\p{M}\p{N}]+", " ")
    return F.ltrim(F.concat(words, F.lit(" ")))


def _plain_items(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``words``: the plain words of the items; also those that are left where signs
    are deleted instead of read as blanks, if they are others."""
    closed = F.regexp_replace("text", r"[^\p{L}\p{M}\p{N}\s]+", "")
    texts = benchmark.select("item_id", F.explode(F.array_distinct(F.array("text", closed))).alias("text"))
    return texts.select("item_id", _split(plain(F.col("text"))).alias("words")).distinct()


def _split(words: Column) -> Column:
    return F.filter(F.split(words, " +"), lambda w: w != "")


def _templated(df: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``words`` (template), ``values`` (the same with values) of ``df``'s texts."""
    return df.select(*keys, _split(template(F.col("text"))).alias("words"), words_of(F.col("text")).alias("values"))


def _windows(df: DataFrame, *keys: str) -> DataFrame:
    """Each window of ``df``'s words: ``keys``, ``at`` (first word), ``window``."""
    last = F.size("words") - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    placed = df.select(*keys, "words", F.explode(starts).alias("at"))
    return placed.select(
        *keys, "at", F.array_join(F.slice("words", F.col("at") + 1, F.lit(WINDOW)), " ").alias("window")
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """Documents of ``docs`` (``doc_id``, ``text``) that hold items of ``benchmark`` (``item_id``,
    ``text``), with the values of the item or with others.

    Returns a row per row of ``docs`` and item found in it: ``doc_id``, ``row`` (``xxhash64``
    of its text), ``item_id``, ``n_words`` (the longest run), ``verbatim`` (whether a stretch
    long enough has the item's own values).

    Numbers, names and units become typed placeholders. An item is found where ``run``
    template words in a row (or all but one, if it has fewer) agree and the slots are consistent:
    within the run, equal values of the item are equal values in the document and unequal
    ones unequal. ``LITERAL`` of the words needed must be literal words. A stretch that is long
    enough and has the item's own values is found all the same, also one of numbers.
    The same holds for plain lower-case words without placeholders, so that copies in other
    case or without signs, which have other placeholders, are found; what either kind finds counts.
    Items of fewer than ``SHORTEST`` words are found where all their words stand in a row, in
    any case and with any signs between, if not all are numbers.

    All documents are cut into consecutive windows of both kinds, those of items start at every word;
    a run always holds one such window whole. Only the windows' hashes meet all documents. In those
    with a hit the windows at every word are counted, and of every ``run`` words of an item only the
    rarest window is looked for, so that common ones ("which of the following is") pair nothing.
    Where it stands, the item's windows are compared one by one along the diagonal.

    NULL and empty texts hold nothing. Items that are NULL, or have fewer than ``SHORTEST`` words
    all of which are numbers, are not looked for: they are no evidence. Rows that repeat an id are
    searched each; repeated rows and items give their result once. No rows on either side give no rows.
    """
    benchmark = benchmark.filter("text IS NOT NULL").select("item_id", "text").distinct()
    plain_items = _plain_items(benchmark)
    # Templates and plain words are kinds that never meet each other.
    items = stored(
        _templated(benchmark, "item_id").withColumn("kind", F.lit(0))
        .unionByName(plain_items.withColumns({"values": F.col("words"), "kind": F.lit(1)}))
        .filter(F.size("words") >= SHORTEST)
        .withColumn("item", F.xxhash64("item_id", "kind", "values"))
    )
    windows = stored(_windows(items, "item", "kind").withColumn("hash", F.xxhash64("window")))
    hashes = windows.select("hash").distinct()

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("row")).filter("text IS NOT NULL")
    consecutive = [
        F.regexp_extract_all(words(F.col("text")), F.lit(f"(?:[^ ]+ ){{{WINDOW}}}"), F.lit(0))
        for words in (template, plain)
    ]
    cut = texts.select("doc_id", "row", F.explode(F.concat(*consecutive)).alias("window")).select(
        "doc_id", "row", F.xxhash64(F.rtrim("window")).alias("hash")
    )
    hit = stored(cut.join(if_few(hashes), "hash", "left_semi").select("doc_id", "row").distinct())

    key = texts["doc_id"].eqNullSafe(F.col("_id")) & (texts["row"] == F.col("_row"))
    wanted = hit.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    wanted = stored(texts.join(if_few(wanted), key, "left_semi").distinct())
    words = wanted.select("doc_id", "row", _split(plain(F.col("text"))).alias("words"))
    found = stored(
        _templated(wanted, "doc_id", "row").withColumn("kind", F.lit(0))
        .unionByName(words.withColumns({"values": F.col("words"), "kind": F.lit(1)}))
        .withColumn("doc", F.xxhash64("doc_id", "row", "kind"))
    )
    needed = F.least(F.lit(run), F.greatest(F.size("words") - 1, F.lit(SHORTEST)))
    needs = items.select("item", needed.alias("needed"))
    here = stored(_windows(found, "doc", "kind").withColumn("hash", F.xxhash64("window")).join(if_few(hashes), "hash", "left_semi"))
    seeds = stored(_rarest(windows, needs, here.groupBy("hash").agg(F.count("*").alias("often"))))
    met = (
        here.join(seeds, ["hash", "window", "kind"])
        .select("doc", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    along_item = met.join(windows.select("item", F.col("at").alias("item_at"), "window"), "item").select(
        "doc", "item", "shift", (F.col("item_at") + F.col("shift")).alias("at"), "window"
    )
    pairs = along_item.join(here.select("doc", "at", "window"), ["doc", "at", "window"])
    along = Window.partitionBy("doc", "item", "shift").orderBy("at")
    runs = (
        pairs.withColumn("island", F.col("at") - F.row_number().over(along))
        .groupBy("doc", "item", "shift", "island")
        .agg(F.min("at").alias("start"), (F.max("at") + WINDOW).alias("stop"))
    )
    n = F.col("stop") - F.col("start")
    needed = F.col("needed")
    runs = (
        runs.filter(n >= SHORTEST)
        .join(needs, "item")
        .filter(n >= needed)
        .join(items.alias("i"), "item")
        .join(found.alias("d"), "doc")
        .select(
            "d.doc_id", "d.row", "i.item_id", "i.kind", n.cast("long").alias("n"), needed,
            F.slice("d.words", F.col("start") + 1, n).alias("words"),
            F.slice("d.values", F.col("start") + 1, n).alias("here"),
            F.slice("i.values", F.col("start") - F.col("shift") + 1, n).alias("there"),
        )
    )
    slots = F.filter(F.arrays_zip("words", "here", "there"), lambda s: s["words"].rlike(f"^[{_OWN}]$"))
    runs = runs.withColumn("slots", slots)
    mapped = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["here"], s["there"]))))
    consistent = (F.size(F.array_distinct("slots.here")) == mapped) & (
        F.size(F.array_distinct("slots.there")) == mapped
    )
    literal = F.col("n") - F.size("slots") >= F.ceil(F.col("needed") * LITERAL)
    runs = runs.withColumn("own", _own_words()).withColumn("whole", (F.col("kind") == 0) & consistent & literal)
    own = F.col("own") >= F.col("needed")
    runs = runs.filter(F.col("whole") | own).select(
        "doc_id", "row", "item_id",
        F.when(F.col("whole"), F.col("n")).otherwise(F.col("own")).alias("n_words"), own.alias("verbatim"),
    )
    return (
        runs.unionByName(_whole_items(texts, plain_items))
        .groupBy("doc_id", "row", "item_id")
        .agg(F.max("n_words").alias("n_words"), F.bool_or("verbatim").alias("verbatim"))
    )


def _rarest(windows: DataFrame, needs: DataFrame, counts: DataFrame) -> DataFrame:
    """Of every ``needed`` words of an item (``needs``) the window that is rarest by ``counts`` (``hash``,
    ``often``): ``item``, ``kind``, ``item_at``, ``hash``, ``window``.

    Templates of nothing but placeholders are left out: a run of them only has too few literal
    words, and if it has the item's own values, it is found by its plain words."""
    counted = windows.join(counts, "hash", "left").join(needs, "item")
    one = F.struct(F.coalesce("often", F.lit(0)).alias("often"), F.col("at").alias("item_at"), "hash", "window")
    of_item = counted.groupBy("item", "kind", "needed").agg(F.array_sort(F.collect_list(F.struct("at", one.alias("w")))).alias("all"))
    length = F.col("needed") - WINDOW + 1
    starts = F.sequence(F.lit(1), F.size("all") - length + 1)
    least = F.transform(starts, lambda at: F.array_min(F.slice(F.col("all.w"), at, length)))
    seeds = of_item.select("item", "kind", F.explode(F.array_distinct(least)).alias("w"))
    seeds = seeds.select("item", "kind", "w.item_at", "w.hash", "w.window")
    return seeds.filter((F.col("kind") == 1) | F.col("window").rlike(f"[^{_OWN} ]"))


def _own_words() -> Column:
    """The longest stretch of a run (``words``, ``here``, ``there``) with the item's own values."""
    same = F.transform(F.arrays_zip("here", "there"), lambda s: F.when(s["here"] == s["there"], "w").otherwise("-"))
    stretches = F.split(F.array_join(same, ""), "-+")
    return F.coalesce(F.array_max(F.transform(stretches, F.length)), F.lit(0)).cast("long")


def _whole_items(texts: DataFrame, items: DataFrame) -> DataFrame:
    """The ``items`` (plain) too short for windows that ``texts`` (``doc_id``, ``row``, ``text``) hold
    whole, by a hash of all their words: only for lengths that such items have."""
    short = stored(
        items.filter((F.size("words") < SHORTEST) & F.exists("words", lambda w: ~w.rlike(_NUMERIC)))
        .select("item_id", F.xxhash64("words").alias("hash"), F.size("words").cast("long").alias("n_words"))
        .distinct()
    )
    lengths = sorted(r["n_words"] for r in short.select("n_words").distinct().collect())

    def hashes(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("words") - n + 1)
        grams = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, n)))
        return F.when(F.size("words") >= n, grams).otherwise(F.array().cast("array<bigint>"))

    split = texts.select("doc_id", "row", _split(plain(F.col("text"))).alias("words"))
    # Apart for each length: a text's hashes of all lengths at once would be many.
    found = [split.select("doc_id", "row", F.explode(hashes(n)).alias("hash")) for n in lengths]
    few = if_few(short)
    nothing = split.filter("false").select("doc_id", "row", F.lit(0).cast("long").alias("hash"))
    grams = reduce(DataFrame.unionByName, found, nothing)
    return grams.join(few, "hash").select("doc_id", "row", "item_id", "n_words", F.lit(True).alias("verbatim"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` without the rows in which an item is found."""
    leaks = find_leaks(docs, benchmark, run).select("doc_id", "row").distinct()
    leaks = if_few(leaks.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")))
    same = docs["doc_id"].eqNullSafe(leaks["_id"]) & (F.xxhash64(docs["text"]) == leaks["_row"])
    return docs.join(leaks, same, "left_anti")

