"""Where shared files go, and that ranges keep full data out of one task."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagestrata import collapse_adjacent
from pagestrata.session import shared_folder
from pagestrata.sources import export, warc
from workload import files


class _Session:
    """The two members shared_folder reads."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_the_named_folder_is_used():
    found = {shared_folder(_Session("hdfs://shared/work/", "spark://x")) for _ in range(2)}
    assert len(found) == 2 and all(f.startswith("hdfs://shared/work/") for f in found)


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(None, "spark://x"))
    assert shared_folder(_Session(None, "local[2]")).startswith("/tmp/run-")


def test_only_the_summary_of_ranges_meets_in_one_task(spark):
    df = spark.range(5000).select(
        F.col("id").alias("capture_id"), F.lit("com,e)/").alias("urlkey"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"), (F.col("id") % 7).alias("digest"),
    )
    collapsed = collapse_adjacent(df, "digest", rows_per_range=100)
    plan = collapsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1
    below = plan.split("Exchange SinglePartition")[1].splitlines()[1]
    assert "Aggregate(key=[_range" in below
    assert collapsed.count() == 5000


@pytest.mark.parametrize(
    "task",
    [warc._reader("/x", 1, 1), export._object_writer("/x", ".html"), files._record_writer("/x")],
)
def test_task_functions_load_without_this_package(task):
    load = "import sys, pickle; assert callable(pickle.load(sys.stdin.buffer))"
    done = subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(task), cwd="/")
    assert done.returncode == 0
