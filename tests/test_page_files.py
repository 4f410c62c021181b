"""Pages as files, and page chunks: how often and from where pages are read."""

import os

from passagemill.plans import basics, chunking
from passagemill.sources.elements import page_elements
from passagemill.sources.files import in_few_tasks, scan_files


def test_every_page_is_a_file_of_one_folder(spark, tmp_path, monkeypatch):
    html = ["<h1>One</h1><p>first\nline</p>", "<p>same id</p>", "<p>no id</p>", None, "", "<p>a\x0312\x03b</p>"]
    pages = list(zip([1, 1, None, 2, 3, 4], "uuuuuu", html))
    given = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    given.write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(basics, "work_path", lambda _spark, name: f"{tmp_path}/{name}")
    got = basics.scanned_pages(spark, str(tmp_path))
    want = page_elements(given).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and want.count() == 5
    names = os.listdir(f"{tmp_path}/pages")
    assert sum(n.endswith(".txt") for n in names) == len(pages)
    assert not any(os.path.isdir(f"{tmp_path}/pages/{n}") for n in names)


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"{i}.txt").write_text(str(i))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        files = scan_files(spark, str(tmp_path), ".txt")
        splits, few = files.rdd.getNumPartitions(), in_few_tasks(files)
        assert splits > 100 and few.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
        assert few.count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_page_chunks_parse_a_page_once(spark, data):
    plan = chunking.page_chunks(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan and "posexplode" not in plan
