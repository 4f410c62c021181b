"""Files, catalog tables, upserts, change feed, index sync and streamed refresh."""

import os
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from passagemill.operators.index import (
    Index,
    Provider,
    build_index,
    create_or_sync_index,
    provider,
    split_by_dimension,
    sync_index,
)
from passagemill.operators.mutation import change_feed, upsert, upsert_rows
from passagemill.session import discard_intermediates, fits_broadcast, materialize, work_path
from passagemill.sources.elements import collapse_groups, exclude_refs, page_elements
from passagemill.sources.files import file_metadata, scan_files
from passagemill.sources.isolation import check_isolated, quarantined, succeeded
from passagemill.sources.tables import (
    append_table,
    create_table,
    is_table_empty,
    run_stage,
    set_table_property,
    table_exists,
    table_property,
    swap_table,
)
from passagemill.streaming.refresh import refresh

ROW = "k long, v string"


def name():
    return f"t_{uuid4().hex}"


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for path, content in (("a.pdf", b"12"), ("sub/B.PDF", b"345"), ("c.txt", b"x")):
        (tmp_path / path).write_bytes(content)
    meta = file_metadata(scan_files(spark, str(tmp_path), ".pdf"), ".pdf")
    assert sorted((r.file_name, r.file_size) for r in meta.collect()) == [("B.PDF", 3), ("a.pdf", 2)]
    assert [f.name for f in meta.schema] == [
        "file_name",
        "file_path",
        "file_size",
        "modification_time",
    ]
    assert scan_files(spark, str(tmp_path)).count() == 3
    plan = meta._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_create_append_properties(spark):
    table = name()
    assert not table_exists(spark, table) and is_table_empty(spark, table)
    create_table(spark, table, ROW)
    create_table(spark, table, ROW)
    assert table_exists(spark, table) and is_table_empty(spark, table)
    append_table(spark.createDataFrame([("x", 1)], "v string, k long"), table)
    assert rows(spark.read.table(table)) == [(1, "x")] and not is_table_empty(spark, table)
    set_table_property(spark, table, "owner's", "it's")
    assert table_property(spark, table, "owner's") == "it's"
    assert table_property(spark, table, "missing") is None


def test_a_stored_stage_is_not_built_again(spark):
    table, built = name(), []

    def build():
        built.append(1)
        return spark.createDataFrame([(1, "a")], ROW)

    run_stage(spark, table, build)
    assert rows(run_stage(spark, table, build)) == [(1, "a")] and built == [1]


def test_upsert(spark):
    table = name()
    append_table(spark.createDataFrame([(1, "a"), (2, "b")], ROW), table)
    source = spark.createDataFrame([(2, "B"), (3, "c")], ROW)
    assert upsert(spark, table, source, ["k"]) == 2
    assert rows(spark.read.table(table)) == [(1, "a"), (2, "B"), (3, "c")]
    assert upsert(spark, table, source, ["k"]) == 2  # again: nothing changes
    assert rows(spark.read.table(table)) == [(1, "a"), (2, "B"), (3, "c")]


def test_duplicate_keys_raise_or_append(spark):
    table = name()
    append_table(spark.createDataFrame([(1, "a")], ROW), table)
    twice = spark.createDataFrame([(1, "x"), (1, "y")], ROW)
    with pytest.raises(Exception, match="duplicate key"):
        upsert_rows(spark.read.table(table), twice, ["k"]).collect()
    with pytest.raises(Exception, match="duplicate key"):
        upsert(spark, table, twice, ["k"])
    assert rows(spark.read.table(table)) == [(1, "a")]
    assert upsert(spark, table, twice, ["k"], on_error="append") == 2
    assert rows(spark.read.table(table)) == [(1, "a"), (1, "x"), (1, "y")]
    with pytest.raises(ValueError):
        upsert(spark, table, twice, ["k"], on_error="ignore")


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], ROW)
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "x"), (5, "e")], ROW)
    assert rows(change_feed(old, new, ["k"]).fillna("-")) == [
        ("delete", 1, "a"),
        ("insert", 5, "e"),
        ("update_postimage", 2, "B"),
        ("update_postimage", 4, "x"),
        ("update_preimage", 2, "b"),
        ("update_preimage", 4, "-"),
    ]


def state(spark, index):
    entries = index.entries(spark).select("id", "fp", "ok", "dl", "terms", "embedding", "content_type")
    return sorted(map(str, entries.collect())), sorted(map(str, index.terms(spark).collect()))


def test_sync_equals_a_rebuild(spark):
    schema = "id long, content string, content_type string"
    old = [(1, "one two", "a"), (2, "two", "a"), (3, "three three", "b"), (4, "", "b"), (6, "six", "a")]
    new = [(1, "one two", "a"), (2, "two four", "a"), (4, "now text", "b"), (5, "five", None), (6, "six", "b")]
    synced, fresh = Index(name(), 16), Index(name(), 16)
    build_index(spark.createDataFrame(old, schema), synced)
    target = spark.createDataFrame(new, schema)
    assert sync_index(target, synced) == {"inserted": 1, "deleted": 1, "updated": 3}
    assert sync_index(target, synced) == {"inserted": 0, "deleted": 0, "updated": 0}
    build_index(target, fresh)
    assert state(spark, synced) == state(spark, fresh)


def test_index_guards(spark):
    index = Index(name(), 8)
    data = spark.createDataFrame([(1, "a")], "id long, content string")
    assert not build_index(data, index, force_rebuild=False) and not index.exists(spark)
    table = name()
    append_table(data, table)
    assert not create_or_sync_index(spark, table, index, ["other"])
    assert create_or_sync_index(spark, table, index, [table]) and index.exists(spark)
    assert build_index(data, index, force_rebuild=False)
    assert provider("large", {"large": Provider(3072, "vector")}).dim == 3072
    with pytest.raises(ValueError):
        provider("nobody")


def test_vectors_of_another_dimension_are_set_apart(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id long, v array<float>")
    good, bad = split_by_dimension(frame, "v", 2)
    assert [r.id for r in good.collect()] == [1] and sorted(r.id for r in bad.collect()) == [2, 3]


def test_refresh_takes_each_file_once_and_repeats_safely(spark, tmp_path):
    source, table = str(tmp_path / "in"), name()
    schema = spark.createDataFrame([], "k long, v string, at int").schema
    create_table(spark, table, "k long, v string, at int")

    def drop(*values):
        spark.createDataFrame(values, schema).write.mode("append").parquet(source)

    def run(checkpoint="cp"):
        refresh(
            spark, source, schema, table, ["k"], str(tmp_path / checkpoint), order="at",
            files_per_batch=1 if checkpoint == "cp" else None,
        )

    drop((1, "a", 1), (2, "b", 1))
    run()
    drop((2, "B", 2), (3, "c", 2))
    run()
    want = [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
    assert rows(spark.read.table(table)) == want
    run()
    assert rows(spark.read.table(table)) == want
    run("lost")  # all files again, in one batch: the last row of a key wins
    assert rows(spark.read.table(table)) == want


def test_page_elements(spark):
    html = (
        "<html><head><title>T &amp; t</title><style>p{}</style><script>var x='</p>';</script></head>"
        "<body><nav><ul><li>one<li>two</ul></nav><!-- <p>no</p> --><h2>Head</h2>"
        "<p>first <b>bold<br>part<p>second<div class=\"ad\">buy</div><ol><li>x</li></ol></body></html>"
    )
    items = page_elements(spark.createDataFrame([(1, html)], "page_id long, html string"))
    got = [(r.label, r.level, r.text, r.excluded) for r in items.orderBy("pos").collect()]
    assert got == [
        ("TITLE", 0, "T & t", False),
        ("LIST_ITEM", None, "one", True),
        ("LIST_ITEM", None, "two", True),
        ("SECTION_HEADER", 2, "Head", False),
        ("TEXT", None, "first bold part", False),
        ("TEXT", None, "second", False),
        ("TEXT", None, "buy", True),
        ("LIST_ITEM", None, "x", False),
    ]
    merged = collapse_groups(items).where("label = 'LIST'").orderBy("pos").collect()
    assert [r.text for r in merged] == ["one\ntwo", "x"]
    refs = items.where("excluded").select("doc_id", "self_ref")
    assert exclude_refs(items, refs).count() == 5


def test_nested_regions_and_lists(spark):
    html = (
        "li<nav><div>menu</div><p>still nav</p><nav>x</nav><p>nav too</p></nav></nav><p>content</p>"
        '<div>a<div class="ad">buy<div>more</div>now</div>b</div>'
        "<ul><li>one<ol><li>in</li></ol></li><li>two</li></ul></ul><li>loose</li>"
        "<footer><p>&#39;f&#x27; &amp;#39; &#0; &#55296;</p></footer><p>end &#8364;&mdash;</p>"
    )
    frame = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")
    items = page_elements(frame).orderBy("pos").collect()
    kept = [(r.text, r.group_ref) for r in items if not r.excluded]
    assert kept == [
        ("li", None),
        ("content", None),
        ("a", None),
        ("b", None),
        ("one", "#/groups/1"),
        ("in", "#/groups/2"),
        ("two", "#/groups/1"),
        ("loose", None),
        ("end €—", None),
    ]
    assert [r.text for r in items if r.excluded] == [
        "menu", "still nav", "x", "nav too", "buy", "more", "now", "'f' &#39; &#0; &#55296;"
    ]


def test_replaced_versions_are_removed(spark):
    table = name()
    for n in range(6):
        swap_table(spark.createDataFrame([(n, "v")], ROW), table)
    home = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    folders = [f for f in os.listdir(home) if f.startswith(f"{table}--") or f.startswith(f"{table}__")]
    assert rows(spark.read.table(table)) == [(5, "v")] and len(folders) == 3
    chosen = work_path(spark, "chosen")
    other = name()
    create_table(spark, other, ROW, path=chosen)
    append_table(spark.createDataFrame([(0, "first")], ROW), other)
    for n in range(4):
        swap_table(spark.createDataFrame([(n, "v")], ROW), other)
    assert os.path.isdir(chosen.removeprefix("file:"))


def test_bad_rows_are_quarantined(spark):
    frame = spark.createDataFrame([(1, "ok"), (2, ""), (3, None)], ROW)
    checked = check_isolated(frame, {"empty": F.length("v") > 0})
    assert rows(succeeded(checked).select("k")) == [(1,)]
    assert rows(quarantined(checked).select("k", "error")) == [(2, "empty"), (3, "empty")]


def test_broadcast_limits(spark):
    frame = spark.range(100).withColumn("t", F.lit("x" * 100))
    assert fits_broadcast(frame, "t")
    assert not fits_broadcast(frame, "t", max_rows=99)
    assert not fits_broadcast(frame, "t", max_bytes=10_000)


def test_intermediates_can_be_discarded(spark):
    discard_intermediates(spark)
    kept = materialize(spark.range(3).toDF("k"), "kept")
    path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and kept.count() == 3
    assert discard_intermediates(spark) == 1 and not os.path.exists(path)
