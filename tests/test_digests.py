"""Digest trees against the full comparison."""

import pytest
from pyspark.sql import functions as F

from passagemill.operators import digests as D
from passagemill.operators import index as I
from passagemill.operators.index import Index, build_index, sync_index
from passagemill.operators.mutation import change_feed


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(D, "FANOUT", 4)
    monkeypatch.setattr(D, "LEAF_ROWS", 10)


def versions(spark):
    old = spark.range(1000).select("id", F.concat(F.lit("v"), F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("w"))
    changed = F.when(F.col("id") == 3, "x").when(F.col("id") == 4, None).otherwise(F.col("v"))
    new = old.where("id <> 500").withColumn("v", changed).unionByName(spark.createDataFrame([(5000, "new", "")], old.schema))
    return old, new


def test_only_differing_leaves_are_joined(spark, small):
    old, new = versions(spark)
    assert D.leaves_for(1000) == 256
    a, b = (D.digest_tree(v, ["id"], leaves=256) for v in (old, new))
    assert a.groupBy("height").count().count() == 5
    nodes = D.differing_leaves(a, b)
    touched = spark.createDataFrame([(3,), (4,), (500,), (5000,)], "id bigint").select(D.leaf_of(["id"], 256).alias("n"))
    assert {r.node for r in nodes.collect()} == {r.n for r in touched.collect()}
    assert D.in_leaves(old, ["id"], nodes, 256).count() < 60
    assert rows(D.change_feed_by_tree(old, new, ["id"])) == rows(change_feed(old, new, ["id"]))
    assert rows(D.change_feed_by_tree(old, new, ["id"], old_tree=a, new_tree=b)) == rows(change_feed(old, new, ["id"]))


def test_equal_versions_join_no_rows(spark, small):
    old, _ = versions(spark)
    same = old.orderBy(F.desc("id")).repartition(5)  # other order, other partitions
    a, b = D.digest_tree(old, ["id"], leaves=64), D.digest_tree(same, ["id"], leaves=64)
    assert D.differing_leaves(a, b).isEmpty()
    assert D.change_feed_by_tree(old, same, ["id"]).isEmpty()


def test_edges(spark, small):
    old, new = versions(spark)
    none = old.limit(0)
    for x, y in ((none, old), (old, none), (none, none)):
        assert rows(D.change_feed_by_tree(x, y, ["id"])) == rows(change_feed(x, y, ["id"]))
    twice = old.unionByName(old.where("id < 9"))  # repeated rows count
    assert not D.differing_leaves(D.digest_tree(old, ["id"], leaves=4), D.digest_tree(twice, ["id"], leaves=4)).isEmpty()
    narrow = old.withColumn("id", F.col("id").cast("int"))
    assert D.differing_leaves(D.digest_tree(old, ["id"], leaves=4), D.digest_tree(narrow, ["id"], leaves=4)).isEmpty()
    with pytest.raises(ValueError, match="numbers of leaves"):
        D.differing_leaves(D.digest_tree(old, ["id"], leaves=4), D.digest_tree(old, ["id"], leaves=16))


def test_sync_of_an_unchanged_source_joins_nothing(spark, small, monkeypatch):
    old, new = versions(spark)
    texts = [v.select("id", F.coalesce("v", F.lit("")).alias("content")) for v in (old, new)]
    index = Index("digest_sync", 16)
    build_index(texts[0], index)
    assert sync_index(texts[1], index) == {"inserted": 1, "deleted": 1, "updated": 2}
    assert spark.catalog.tableExists("digest_sync_tree")

    def refuse(*_args):
        raise AssertionError("rows were joined")

    monkeypatch.setattr(I, "in_leaves", refuse)
    assert sync_index(texts[1], index) == {"inserted": 0, "deleted": 0, "updated": 0}
    monkeypatch.undo()
    rebuilt = Index("digest_rebuilt", 16)
    build_index(texts[1], rebuilt)
    assert rows(index.entries(spark)) == rows(rebuilt.entries(spark).select(*index.entries(spark).columns))
    spark.sql("DROP TABLE digest_sync_tree")  # as after a run that died: made anew from the entries
    assert sync_index(texts[0], index) == {"inserted": 1, "deleted": 1, "updated": 2}
