"""URL filters: rules by host and path, and the reputation of hosts for what no rule decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import stored, with_lookup

#: Of the pages of a host that is let through, so large a share may be good at the upper bound.
SHARE = 0.5
#: Standard deviations of the posterior between its mean and the bound.
DEVIATIONS = 1.0
#: Variation between the children of a level that is assumed where the data cannot tell, and
#: the limits of what is estimated (1 / (strength of the prior + 1)).
VARIATION, LEAST_VARIATION, MOST_VARIATION = 0.1, 0.001, 0.5
#: Sums of a level are of whole multiples of this, so that they do not depend on the order.
UNIT = 2.0**-20

# Suffixes of two labels under which domains are registered.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp",
    "co.kr", "co.nz", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "com.sg", "com.tw",
)

Rules = Sequence[tuple[str, str]]


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case;
    empty if there is none."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What stands between the host and ``?``, ``#`` or the end; empty without a host."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest of ``rules`` (verdict, host and path) that fits, and its verdict; else NULL. A rule
    fits its host and all below it, where the path starts with its path. Of equally
    long ones the first in order of code points is taken."""
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        name, slash, rest = text.partition("/")
        below = (host == name) | host.endswith(f".{name}")
        fits = below & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none if rule is None else rule), (none if verdict is None else verdict)


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """The registered domain of ``host`` and its suffix, without user and port. Addresses and
    names of one label are their own domain and suffix."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(name, r"\.")
    last_two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    n = F.when(last_two.isin(*suffixes), 2).otherwise(1) if suffixes else F.lit(1)
    alone = (F.size(labels) <= n) | name.rlike(r"^[0-9.]+$|^\[")

    def last(k: Column) -> Column:
        return F.array_join(F.slice(labels, F.size(labels) - k + 1, k), ".")

    return F.when(alone, name).otherwise(last(n + 1)), F.when(alone, name).otherwise(last(n))


def host_reputation(
    outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES, deviations: float = DEVIATIONS
) -> DataFrame:
    """What is known of each host from labelled pages: ``outcomes`` has ``host`` and ``good``, a
    boolean, NULL for pages without a label.

    Returns a row per host: ``host``, ``domain``, ``suffix``, ``pages``, ``labelled``, ``good``,
    ``mean`` (posterior share of good pages), ``low`` and ``high`` (so many ``deviations`` from
    it). The share of a suffix, of a domain and of a host is beta-binomial: the prior of each has
    the posterior mean of its parent, and a strength that is estimated by moments from
    all of its level. A host without labels so has the share of its domain, one of a domain
    without labels that of its suffix, and where nothing is labelled, one half.

    NULL hosts are left out, repeated rows count each, extra columns are not read. No rows give
    no rows. Counting is partial before each shuffle; keys that very many rows have are salted.
    """
    counted = outcomes.filter("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count("good").alias("labelled"),
        F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"),
    )
    domain, suffix = domain_of(F.col("host"), suffixes)
    hosts = stored(counted.select("host", domain.alias("domain"), suffix.alias("suffix"), "pages", "labelled", "good"))

    def sums(level: DataFrame, *keys: str) -> DataFrame:
        return level.groupBy(*keys).agg(
            F.count("*").alias("children"), F.sum("labelled").alias("labelled"), F.sum("good").alias("good")
        )

    domains = stored(sums(hosts, "domain", "suffix"))
    tops = stored(sums(domains, "suffix"))
    total = tops.agg(F.sum("labelled"), F.sum("good")).first()
    labelled, good = (float(x or 0) for x in total)
    root = (good + 0.5) / (labelled + 1.0)

    tops = stored(_posterior(tops.withColumn("parent", F.lit(root))))
    parents = tops.select("suffix", F.col("mean").alias("parent"), "children")
    domains = stored(_posterior(with_lookup(domains, parents, "suffix", "children")))
    parents = domains.select("domain", F.col("mean").alias("parent"), "children")
    known = _posterior(with_lookup(hosts, parents, "domain", "children"))
    reach = F.sqrt(F.col("mean") * (1.0 - F.col("mean")) / (F.col("strength") + 1.0)) * deviations
    return known.select(
        "host", "domain", "suffix", "pages", "labelled", "good", "mean",
        (F.col("mean") - reach).alias("low"), (F.col("mean") + reach).alias("high"),
    )


def _posterior(level: DataFrame) -> DataFrame:
    """``level`` (``labelled``, ``good``, ``parent``) with ``mean`` and ``strength`` of the posterior.

    With a prior of mean m and variation r = 1 / (strength + 1), the expectation of n (k / n - m)^2 is
    m (1 - m) (1 + (n - 1) r): what the sums over a level leave for r is its estimate.
    """
    level = stored(level)
    n, k, m = F.col("labelled").cast("double"), F.col("good").cast("double"), F.col("parent")
    spread = m * (1.0 - m)

    def whole(x: Column) -> Column:
        return F.sum(F.floor(x / UNIT + 0.5).cast("decimal(38,0)"))

    some = level.filter("labelled > 0")
    seen, chance, more = some.agg(
        whole((k - n * m) * (k - n * m) / n), whole(spread), whole(spread * (n - 1.0))
    ).first()
    variation = VARIATION if not more else (float(seen) - float(chance)) / float(more)
    variation = min(max(variation, LEAST_VARIATION), MOST_VARIATION)
    strength = 1.0 / variation - 1.0
    return level.withColumn("mean", (m * strength + k) / (n + strength)).withColumn("strength", n + strength)


def judge_urls(
    pages: DataFrame,
    rules: Rules,
    outcomes: DataFrame | None = None,
    share: float = SHARE,
    deviations: float = DEVIATIONS,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``high`` of
    each row of ``pages`` (``page_id``, ``url``).

    Where one of ``rules`` fits, its verdict holds (``rule_of``). All other pages are blocked if even the
    upper bound of their host's share of good pages is below ``share``: a host is blocked on
    evidence against it or its domain, not for being unknown. The labelled pages are ``outcomes``
    (``url``, ``good``), or else the pages with a rule: those it allows are good.

    NULL URLs and URLs without ``://`` have an empty host and path, which is a host like any other.
    Repeated rows come out as often, extra columns are not read. No rows give no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = split.withColumns({"rule": rule, "_says": verdict})
    if outcomes is None:
        seen = split.select("host", (F.col("_says") == "allow").alias("good"))
    else:
        none = F.lit(None).cast("boolean")
        seen = split.select("host", none.alias("good")).unionByName(
            outcomes.select(host_of(F.col("url")).alias("host"), F.col("good").cast("boolean").alias("good"))
        )
    known = host_reputation(seen, suffixes, deviations).select("host", "high", "pages")
    found = with_lookup(split, known, "host", "pages")
    method = F.when(F.col("high") < share, "block").otherwise("allow")
    return found.select("page_id", "url", "host", "path", "rule", F.coalesce("_says", method).alias("verdict"), "high")
