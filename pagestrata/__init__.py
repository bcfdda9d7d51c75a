"""Analysis of web-capture indexes on Spark."""

import sys

from pyspark import cloudpickle

from pagestrata.operators.asof import as_of
from pagestrata.operators.bodies import attach_bodies
from pagestrata.operators.crawls import (
    in_crawls,
    latest_crawl,
    overlap_join,
    overlapping_crawls,
    select_crawls,
)
from pagestrata.operators.dedup import collapse_adjacent, distinct_on
from pagestrata.operators.registrable import read_suffix_rules, registrable_domains, with_registrable_domain
from pagestrata.operators.rollups import merge_rollups, roll_up, url_overlaps, write_rollups
from pagestrata.operators.stats import (
    body_size_stats,
    capture_gaps,
    change_history,
    count_by,
    domains,
    snapshots_per_year,
    status_class,
    union_sources,
    with_calendar,
)
from pagestrata.operators.topk import (
    balanced_sample,
    cap_per_crawl,
    first_captures,
    latest,
    latest_per_url,
    page,
    take_ordered,
    top_k,
)
from pagestrata.plans.capture_query import find_captures
from pagestrata.plans.polite import polite_slots
from pagestrata.plans.requests import plan_crawl_requests, plan_fetches, plan_requests
from pagestrata.plans.sql_function import register_function
from pagestrata.sources.blocks import (
    find_in_blocks,
    read_blocks,
    read_cluster_index,
    scan_blocks,
    write_block_index,
    write_blocks,
)
from pagestrata.sources.catalog import read_crawl_catalog
from pagestrata.sources.cdx import parse_cdx, read_cdx
from pagestrata.sources.cdxj import parse_cdxj, read_cdxj
from pagestrata.sources.clustered import find_clustered, write_clustered
from pagestrata.sources.decode import decode_bodies
from pagestrata.sources.export import export_bodies, write_captures
from pagestrata.sources.grams import find_by_grams, write_grams
from pagestrata.sources.layout import read_index_table, register_index, to_index_table
from pagestrata.sources.record_index import captures_of, index_records
from pagestrata.sources.warc import fetch_records

# Task functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
