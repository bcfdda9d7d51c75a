"""An index as a table function of SQL, whose named parameters reach the scan.

``SELECT * FROM captures(url => 'example.com/*', since => TIMESTAMP '2020-01-01')`` is one plan with the
parameters in it as literals: Catalyst folds the tests that are not asked for, pushes the others
and prunes columns and crawls, as if they were written by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.functions.urls import surt
from pagestrata.operators.topk import MERGERS
from pagestrata.schema import index_order

#: Columns that a parameter of the same name compares with, where the index has them.
_COMPARED = ("crawl_id", "statuscode", "mimetype")


def register_function(df: DataFrame, name: str) -> DataFrame:
    """Make an index known to SQL as the function ``name``, for this session.

    Parameters, all optional, to be given as ``parameter => value``:

    * ``url``: the forms that ``filters.url_pattern`` takes; ``url_like``: SQL LIKE on the whole URL;
      ``host``; ``domain``. One of them must be given, or ``allow_full_scan => true``.
    * ``crawl_id``, ``statuscode``, ``mimetype``: equal to this value. ``since``, ``until``: inclusive bounds.
    * ``max_results``: so many captures of every crawl (of all, if there are no crawls), the first in index order
      of those that meet the other parameters. A WHERE clause comes after it, as in any SQL.

    A parameter that is NULL is not asked for. Unknown names and values of another type are errors of
    Spark's own; a missing URL condition, a negative ``max_results`` and a ``*`` amid a pattern are errors once a row is read.
    Without ``urlkey``, keys are made from URLs for the conditions.
    """
    if "url" not in df.columns:
        raise ValueError("an index has a column url")
    order = [c for c in index_order(df) if c != "crawl_id"]
    source = df if "urlkey" in df.columns else df.withColumn("urlkey", surt(F.col("url")))
    view = f"_index_{name}"
    source.createOrReplaceTempView(view)

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    parameters = dict.fromkeys(["url", "url_like", "host", "domain"], "STRING")
    parameters |= {c: kinds[c] for c in _COMPARED if c in kinds}
    if "timestamp" in kinds:
        parameters |= dict.fromkeys(["since", "until"], kinds["timestamp"])
    parameters["max_results"] = "BIGINT"
    given = ", ".join([f"{p} {kind} DEFAULT NULL" for p, kind in parameters.items()])
    given += ", allow_full_scan BOOLEAN DEFAULT false"
    returned = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
    columns = ", ".join(f"`{c}`" for c in df.columns)

    tests = _checks(name) + [
        _unless_null(f"{name}.url", _url_test(f"{name}.url")),
        _unless_null(f"{name}.url_like", f"t.url LIKE {name}.url_like"),
        _unless_null(f"{name}.host", _host_test(f"{name}.host")),
        _unless_null(f"{name}.domain", _domain_test(f"{name}.domain")),
    ]
    tests += [_unless_null(f"{name}.{c}", f"t.{c} = {name}.{c}") for c in _COMPARED if c in parameters]
    if "since" in parameters:
        tests += [
            _unless_null(f"{name}.since", f"t.timestamp >= {name}.since"),
            _unless_null(f"{name}.until", f"t.timestamp <= {name}.until"),
        ]
    # Both ranks vanish from the plan where no number is given. The first leaves every merger at most
    # so many rows of a crawl, so that one task does not rank a whole crawl.
    by = ", ".join(f"`{c}`" for c in order)
    crawl = "crawl_id" if "crawl_id" in kinds else ""
    groups = ", ".join(filter(None, [crawl, "_merger"]))
    whole = f"PARTITION BY {crawl} " if crawl else ""
    # A negative number folds to a plan without rows, which could not fail.
    few = f"{name}.max_results IS NULL OR {name}.max_results < 0 OR"
    df.sparkSession.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS TABLE ({returned}) RETURN
        SELECT {columns} FROM (
          SELECT *, row_number() OVER ({whole}ORDER BY {by}) AS _rank FROM (
            SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY {by}) AS _early FROM (
              SELECT *, pmod(xxhash64({by}), {MERGERS}) AS _merger FROM {view} AS t
              WHERE {" AND ".join(tests)}))
          WHERE {few} _early <= {name}.max_results)
        WHERE {few} _rank <= {name}.max_results""")
    return df


def _unless_null(parameter: str, test: str) -> str:
    return f"({parameter} IS NULL OR {test})"


def _fails(when: str, message: str) -> str:
    return f"CASE WHEN {when} THEN raise_error('{message}') ELSE true END"


def _checks(name: str) -> list[str]:
    asked = " AND ".join(f"{name}.{p} IS NULL" for p in ("url", "url_like", "host", "domain"))
    return [
        _fails(
            f"{asked} AND NOT coalesce({name}.allow_full_scan, false)",
            f"{name}() needs url, url_like, host or domain, or allow_full_scan => true",
        ),
        _fails(f"{name}.max_results < 0", "max_results must not be negative"),
        _fails(
            f"position('*', regexp_replace({name}.url, '^[*][.]|[*]$', '')) > 0",
            "* may only start or end a URL pattern; use url_like or a regex",
        ),
    ]


def _keys(host: str) -> list[str]:
    """The reversed forms of a host, as it is and without ``www``."""
    return [
        f"array_join(reverse(split(lower({h}), '[.]')), ',')"
        for h in (host, f"regexp_replace(lower({host}), '^www[0-9]*[.]', '')")
    ]


def _starts(prefixes: list[str]) -> str:
    return "(" + " OR ".join(f"startswith(t.urlkey, {p})" for p in prefixes) + ")"


def _domain_test(host: str) -> str:
    return _starts([f"concat({key}, '{end}')" for key in _keys(host) for end in ",):"])


def _host_test(host: str) -> str:
    own = "lower(regexp_extract(t.url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)', 1))"
    bounds = _starts([f"concat({key}, '{end}')" for key in _keys(host) for end in "):"])
    return f"({own} = lower({host}) AND {bounds})"


def _url_test(pattern: str) -> str:
    start = f"regexp_replace({pattern}, '[*]$', '')"
    open_end = f"endswith({pattern}, '*')"
    scheme = f"contains({pattern}, '://')"
    subdomains = f"startswith({pattern}, '*.')"
    bare = f"regexp_replace({start}, '^[*][.]', '')"
    host = f"regexp_extract({bare}, '^([^/:]*)', 1)"
    port = f"regexp_extract({bare}, '^[^/:]*:([0-9]*)', 1)"
    path = f"lower(regexp_extract({bare}, '^[^/]*(/.*)?$', 1))"
    own_path = "substring(t.urlkey, instr(t.urlkey, ')') + 1)"
    of_path = (
        f"CASE WHEN {path} IN ('', '/') AND ({open_end} OR {path} = '') THEN true"
        f" WHEN {open_end} THEN startswith({own_path}, {path}) ELSE {own_path} = {path} END"
    )

    def literal(text: str) -> str:
        return f"replace(replace(replace({text}, '!', '!!'), '%', '!%'), '_', '!_')"

    plain, named, bounds = [], [], []
    for key in _keys(host):
        whole = f"concat({key}, ')', {path})"
        bounds += [whole, f"concat({key}, ':')"]
        # A host alone is its front page too.
        front = f"CASE WHEN {path} = '' THEN concat({whole}, '/') ELSE {whole} END"
        begins = f"left(t.urlkey, length({whole})) = {whole}"
        plain.append(f"CASE WHEN {open_end} THEN {begins} ELSE t.urlkey IN ({whole}, {front}) END")
        own_port = f"CASE WHEN {port} = '' THEN '%' ELSE {port} END"
        like = f"concat({literal(key)}, ':', {own_port}, ')', {literal(path)}"
        for end in (f"CASE WHEN {open_end} THEN '%' ELSE '' END", f"CASE WHEN {path} = '' THEN '/' ELSE '' END"):
            named.append(f"t.urlkey LIKE {like}, {end}) ESCAPE '!'")
    of_port = f"({port} = '' OR regexp_extract(t.url, '^[^/]*//[^/?#]*:([0-9]+)', 1) = {port})"
    # LIKE with a wildcard inside is not pushed to the scan, the beginnings of keys are. The plain tests
    # are written in another way, else the optimizer would draw both together again.
    keyed = f"({_starts(bounds)} AND ((({' OR '.join(plain)}) AND {of_port}) OR {' OR '.join(named)}))"
    return (
        f"CASE WHEN {subdomains} THEN {_domain_test(host)} AND {of_path}"
        f" WHEN {scheme} AND {open_end} THEN startswith(t.url, {start})"
        f" WHEN {scheme} THEN t.url = {pattern} ELSE {keyed} END"
    )
