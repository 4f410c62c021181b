"""Column expressions and vectorised functions on hand-made rows."""

import sys

import numpy as np
import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F

from passagemill.functions import text as T
from passagemill.functions.batched import batched_apply, embedding_provider
from passagemill.functions.vectors import count_runs, hash_embedding

register_pickle_by_value(sys.modules[__name__])


def values(spark, rows, schema, column):
    frame = spark.createDataFrame(rows, schema).withColumn("_i", F.monotonically_increasing_id())
    return [r[0] for r in frame.orderBy("_i").select(column).collect()]


def test_numeric_ratio_counts_all_digits(spark):
    rows = [("1²٣ab$%,",), ("①x",), ("",), (None,), ("||",), ("1" + "a" * 9,), ("11" + "a" * 9,)]
    ratios = values(spark, rows, "t string", T.numeric_ratio("t"))
    assert ratios == [6 / 8, 1 / 2, 0.0, 0.0, 0.0, 0.1, 2 / 11]
    kinds = values(spark, rows, "t string", T.detected_type("t"))
    assert kinds == ["table", "table", "narrative", "narrative", "table", "narrative", "table"]


def test_marks_of_tables(spark):
    rows = [("a\tb",), ("a  b",), ("a b",)]
    kinds = values(spark, rows, "t string", T.detected_type("t"))
    assert kinds == ["table", "table", "narrative"]


def test_references_and_names(spark):
    rows = [("#/texts/12",), ("#/texts/x",), ("a/B.PDF",)]
    assert values(spark, rows, "t string", T.trailing_number("t")) == [12, None, None]
    assert values(spark, rows, "t string", T.has_extension("t", ".pdf")) == [False, False, True]
    urls = [("http://a/b//",), ("http://a",)]
    assert values(spark, urls, "t string", T.trim_trailing_slash("t")) == ["http://a/b", "http://a"]


def test_headings_above_text(spark):
    rows = [(["A", "B"], "t"), ([], "t"), (None, "t")]
    schema = "h array<string>, t string"
    assert values(spark, rows, schema, T.contextualize("h", "t")) == ["A\nB\nt", "t", "t"]
    assert values(spark, rows, schema, T.join_headings("h")) == ["A, B", "", ""]


def test_template_is_not_filled_twice(spark):
    rows = [("has {question} inside", "why {context}?")]
    filled = T.fill_template("C={context} Q={question} again {context}", "c", "q")
    assert values(spark, rows, "c string, q string", filled) == [
        "C=has {question} inside Q=why {context}? again has {question} inside"
    ]
    for bad in ("no placeholders", "{context}", "{question}"):
        with pytest.raises(ValueError):
            T.check_template(bad)


def test_fixed_decimals(spark):
    rows = [(0.0625,), (None,), (1.0,), (12.3456,)]
    assert values(spark, rows, "x double", T.fixed_decimals("x", 3)) == [
        "0.063",
        "0.000",
        "1.000",
        "12.346",
    ]


def test_second_map_wins(spark):
    rows = [({"a": "1", "b": "2"}, {"b": "3"}), ({"a": "1"}, None), (None, {"c": "4"})]
    merged = values(spark, rows, "x map<string,string>, y map<string,string>", T.merge_maps("x", "y"))
    assert merged == [{"a": "1", "b": "3"}, {"a": "1"}, {"c": "4"}]


def test_runs(spark):
    rows = [(["b", "a", "b"],), ([],)]
    got = values(spark, rows, "v array<string>", count_runs(F.col("v")))
    assert [[tuple(p) for p in g] if g else g for g in got] == [[("a", 1), ("b", 2)], None]


def test_hash_embedding_is_a_unit_vector(spark):
    rows = [("one two two",), ("",), (None,), ("...",)]
    got = values(spark, rows, "t string", hash_embedding("t", 32))
    assert all(len(v) == 32 for v in got)
    assert [round(float(np.linalg.norm(v)), 5) for v in got] == [1.0, 0.0, 0.0, 0.0]


def refusing():
    def answer(part):
        if "bad" in part:
            raise RuntimeError("refused")
        return [[float(len(p))] for p in part]

    return answer


def short():
    return lambda part: [[1.0]] * (len(part) - 1)


def test_only_the_failing_slice_gets_the_fallback(spark):
    texts = ["a", "bb", "bad", "cc", "ddd", "e"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    embed = embedding_provider(refusing, 1, 2)
    got = [r.e for r in frame.select("i", embed("t").alias("e")).orderBy("i").collect()]
    assert [r.ok for r in got] == [True, True, False, False, True, True]
    assert [list(r.value) for r in got] == [[1.0], [2.0], [0.0], [0.0], [3.0], [1.0]]
    assert got[2].error == "refused" and got[0].error is None


def test_wrong_number_of_answers_is_a_failure(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "t string")
    rows = frame.select(embedding_provider(short, 1, 10)("t").alias("e")).collect()
    assert not any(r.e.ok for r in rows)
    with pytest.raises(ValueError):
        batched_apply(short, 0, list, "array<float>")


def test_a_null_question_leaves_the_prompt(spark):
    from pyspark.sql import functions as F

    from passagemill.functions.text import fill_template

    rows = spark.createDataFrame([("c", None), (None, "q"), (None, None)], "c string, q string")
    filled = rows.select(fill_template("<{context}|{question}>", F.col("c"), F.col("q")).alias("p"))
    assert [r.p for r in filled.collect()] == ["<c|>", "<|q>", "<|>"]
