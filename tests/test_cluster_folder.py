"""The storing queries off local mode, with a shared folder named as a path only, as spark-defaults.conf may have it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as E
from strata import session

ROOT = str(Path(__file__).resolve().parents[1])
SF_SMALL = "/root/testdata/sf0.001"

# Each of these stopped there with RuntimeError ("names no file system") before it had stored anything.
STORING = (
    "dedup_overwrite",
    "dq_gold_accuracy",
    "dq_gold_total",
    "dq_profit_layers",
    "dq_report",
    "gold_incremental",
    "json_multiline_roundtrip",
    "json_roundtrip",
    "late_dimensions",
    "medallion_multiline",
    "medallion_observed",
    "medallion_report",
    "medallion_run",
    "published_medallion",
    "quarantine_csv",
    "quarantine_json",
    "silver_orders_broadcast",
    "silver_orders_salted",
    "stream_ingest",
    "stream_medallion",
    "stream_quarantine",
)


class _Stored(Exception):
    """Ends a query that has got its folder."""


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    conf = type(spark.conf)
    get = conf.get
    monkeypatch.setattr(conf, "get", lambda self, key, *default: str(tmp_path) if key == "spark.checkpoint.dir" else get(self, key, *default))
    monkeypatch.setattr(session, "_is_local", lambda _: False)
    monkeypatch.setattr(session, "_STORED", {})
    return spark, str(tmp_path)


@pytest.mark.parametrize("name", STORING)
def test_query_stores_in_a_plain_shared_folder(cluster, monkeypatch, name):
    spark, base = cluster

    def remember(_, kind, path):
        if kind == "folder" and not path.startswith(f"{base}/shared-"):  # that one is the trial write
            assert path.startswith(f"{base}/")
            raise _Stored

    monkeypatch.setattr(session, "_remember", remember)
    with pytest.raises(_Stored):
        E.queries()[name](spark, SF_SMALL)


RUN = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", sys.argv[1] + "/shared").config("spark.sql.warehouse.dir", sys.argv[1] + "/warehouse")
         .getOrCreate())
import __spark_entry__ as E
print(E.queries()["quarantine_csv"](spark, sys.argv[2]).count(), spark.read.parquet(sys.argv[2] + "/part.parquet").count())
"""


def test_a_cluster_stores_in_a_plain_shared_folder(tmp_path):
    (tmp_path / "conf").mkdir()
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path), SF_SMALL], cwd=tmp_path, text=True, capture_output=True,
                          env=os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": ROOT})
    assert done.returncode == 0, done.stderr[-2000:]
    rows, parts = done.stdout.split()
    assert rows == parts
