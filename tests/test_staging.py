from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from legwise.operators.extract import page_versions
from legwise.staging import PAGE_BATCH, PAGE_GROUP, _BATCH_SETTING, release, shared_folder, spread, stage, stage_pages
from tests.conftest import rows_of


def _session(master, folder=None, setting=None):
    state = SimpleNamespace(folder=folder)
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state.folder,
        setCheckpointDir=lambda path: setattr(state, "folder", f"{path}/app"),
    )
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: setting or default)
    )


def test_shared_folder_follows_the_setting():
    assert shared_folder(_session("yarn", folder="hdfs:///shared/app")) == "hdfs:///shared/app"
    assert shared_folder(_session("yarn", setting="hdfs:///shared")) == "hdfs:///shared/app"


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session("yarn"))


def test_stage_reads_back_what_it_wrote(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    written = stage(df, "test")
    assert rows_of(written) == rows_of(df)
    folder = shared_folder(spark).split(":")[-1]  # file:/x and file:///x name the same folder
    assert written.inputFiles() and all(folder in path for path in written.inputFiles())
    assert stage(df.limit(0), "empty").columns == ["a", "b"]


def _pages(spark, n):
    """Pages of 300,000 letters that hardly compress, in one partition."""
    letters = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(7500)), lambda k: F.sha1(F.concat("url", k.cast("string")))), "")
    return spark.range(0, n, 1, 1).select(F.col("id").cast("string").alias("url")).withColumn("html", letters)


def test_row_groups_of_pages_are_bounded(spark):
    """A reader unpacks up to 4096 rows of a row group at once, so rows of pages must not share a large one."""
    pages = stage(_pages(spark, 60), "whole")
    both = pages.unionByName(pages.select("url", F.substring("html", 1, 1000).alias("html"))).coalesce(1)
    chosen, _ = page_versions(both)
    files = [f.split(":")[-1] for f in chosen.inputFiles() if "page-versions-" in f]
    groups = [g for f in ds.dataset(files).get_fragments() for g in f.row_groups]
    assert sum(g.num_rows for g in groups) == 60
    assert max(g.num_rows for g in groups) <= 20 and max(g.total_byte_size for g in groups) <= 3 * PAGE_GROUP
    assert chosen.where(F.length("html") == 300_000).count() == 60


def test_pages_go_to_python_in_small_batches(spark):
    sizes = F.arrow_udf(lambda html: pa.array([sum(map(len, html.to_pylist()))] * len(html)), "long").asNondeterministic()
    pages = stage(_pages(spark, 60), "whole")
    before = dict(spark.conf.getAll)
    with ThreadPoolExecutor(2) as pool:  # at the same time; what the session says holds again after both
        written = [*pool.map(lambda k: stage_pages(pages.select("url", sizes("html").alias("sent")), f"sent-{k}"), range(2))]
    for sent in written:
        assert sent.count() == 60 and sent.agg(F.max("sent")).first()[0] <= PAGE_BATCH + 300_000
    with pytest.raises(Exception, match="stopped"):
        stage_pages(pages.select(F.raise_error(F.lit("stopped")).cast("string").alias("url")), "failed")
    assert dict(spark.conf.getAll) == before


def test_a_smaller_batch_of_the_session_stays(spark):
    spark.conf.set(_BATCH_SETTING, "1m")
    try:
        sizes = F.arrow_udf(lambda html: pa.array([len(html)] * len(html)), "long").asNondeterministic()
        sent = stage_pages(stage(_pages(spark, 20), "whole").select(sizes("html").alias("rows")), "sent")
        assert sent.agg(F.max("rows")).first()[0] <= 4
        assert spark.conf.get(_BATCH_SETTING) in ("1m", "1048576b")
    finally:
        spark.conf.unset(_BATCH_SETTING)


def test_spread(spark):
    parts = spread(spark.range(0, 10, 1, 1), 5).select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() == 5


def test_local_clusters_need_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session("local-cluster[2,1,1024]"))


def test_release_deletes_what_was_staged(spark, tmp_path):
    folder = str(tmp_path / "own")
    calls = []

    class Path:
        def __init__(self, name):
            self.name = name

        def getFileSystem(self, _):
            return SimpleNamespace(delete=lambda path, deep: calls.append((path.name, deep)))

    hadoop = SimpleNamespace(apache=SimpleNamespace(hadoop=SimpleNamespace(fs=SimpleNamespace(Path=Path))))
    session = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: folder),
        _jvm=SimpleNamespace(org=hadoop), _jsc=SimpleNamespace(hadoopConfiguration=lambda: None),
    )
    release(session)
    assert calls == [(folder, True)]
