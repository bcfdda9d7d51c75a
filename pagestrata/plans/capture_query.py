"""A whole index query in one call, applied in the order that keeps its meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pagestrata.operators import dedup, filters, topk


def find_captures(
    df: DataFrame,
    url: str | None = None,
    *,
    url_like: str | None = None,
    host: str | None = None,
    domain: str | None = None,
    statuscode: int | list[int] | None = None,
    mimetype: str | list[str] | None = None,
    crawl_id: str | list[str] | None = None,
    since=None,
    until=None,
    years: tuple[int | None, int | None] | None = None,
    where=None,
    collapse: str | list[str] | None = None,
    distinct_on: list[str] | None = None,
    max_results: int | None = None,
    newest: int | None = None,
    limit: int | None = None,
    offset: int = 0,
    allow_full_scan: bool = False,
) -> DataFrame:
    """Captures by URL (``url`` exact or with ``*``, ``url_like`` SQL LIKE) and other conditions.

    Filters come first, then adjacent collapse, one capture per key, the per-crawl cap,
    and last the limit. ``years`` is an inclusive pair, ``where`` any further condition.
    ``newest`` takes the latest captures, ``limit`` and ``offset`` a page in index
    order. Nothing is capped unless asked for.
    """
    tests, keyed = [], "urlkey" in df.columns
    if url is not None:
        tests.append(filters.url_pattern(url, keyed))
    if url_like is not None:
        tests.append(filters.url_like(url_like, keyed))
    if host is not None:
        tests.append(filters.on_host(host, keyed))
    if domain is not None:
        tests.append(filters.in_domain(domain))
    filters.require_url_filter(bool(tests), allow_full_scan)
    if newest is not None and (limit is not None or offset):
        raise ValueError("newest goes without limit and offset")
    for column, value in (
        ("statuscode", statuscode), ("mimetype", mimetype), ("crawl_id", crawl_id),
    ):
        if value is not None:
            values = value if isinstance(value, (list, tuple, set)) else [value]
            tests.append(filters.one_of(column, values))
    tests.append(filters.time_range(df, since, until))
    if years is not None:
        tests.append(filters.year_range(df, *years))
    if where is not None:
        tests.append(where)

    found = df.filter(filters.all_of(tests))
    if collapse:
        found = dedup.collapse_adjacent(found, collapse)
    if distinct_on:
        found = dedup.distinct_on(found, distinct_on)
    if max_results is not None:
        capped = "crawl_id" in df.columns
        found = topk.cap_per_crawl(found, max_results) if capped else topk.first_captures(
            found, max_results
        )
    if newest is not None:
        return topk.latest(found, newest)
    if limit is not None:
        return topk.page(found, limit, offset)
    if offset:
        raise ValueError("offset needs a limit")
    return found
