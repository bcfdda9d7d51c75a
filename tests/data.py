"""Small generated indexes with hot and missing keys."""

from __future__ import annotations

import datetime as dt
import random

SCHEMA = (
    "capture_id long, url string, urlkey string, timestamp timestamp_ntz, crawl_id string, "
    "statuscode int, mimetype string, digest string, length long"
)


def captures_with_hot_keys(n: int = 600, seed: int = 7) -> list[tuple]:
    """A third of all rows is one URL, many in the same second; some keys are NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        url = "http://hot.example.com/" if hot else f"http://h{rng.randrange(12)}.example.org/{rng.randrange(9)}"
        key = "com,example,hot)/" if hot else f"org,example,h{url[8:].split('.')[0]})/{url[-1]}"
        second = rng.choice([0, 0, 0, rng.randrange(10_000)])
        taken = dt.datetime(2020, 1, 1) + dt.timedelta(seconds=second)
        rows.append(
            (
                i,
                None if rng.random() < 0.05 else url,
                None if rng.random() < 0.05 else key,
                None if rng.random() < 0.05 else taken,
                f"CC-MAIN-{2020 if hot else 2021 + rng.randrange(3)}-10",
                rng.choice([200, 200, 301, 404]),
                rng.choice(["text/html", "application/pdf"]),
                None if rng.random() < 0.1 else f"D{rng.randrange(4)}",
                rng.randrange(5000),
            )
        )
    return rows


def sort_key(*values):
    """Ascending with NULLs first, as Spark orders."""
    return tuple((v is not None, v) if v is not None else (False, 0) for v in values)
