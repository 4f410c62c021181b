"""Windows, splitting, merging, numbering and the chunk table."""

import random

import pytest
from pyspark.sql import functions as F

from passagemill.operators import hybrid, scan, windows
from passagemill.operators.chunk_table import chunk_table
from passagemill.operators.hybrid import merge_peers, split_long_chunks
from passagemill.operators.markdown import markdown_tables
from passagemill.operators.scan import number_rows
from passagemill.operators.windows import char_windows, routed_chunks
from passagemill.sources.elements import page_elements

CHUNKS = (
    "doc_id long, pos int, headings array<string>, text string, "
    "items array<struct<self_ref string, label string, page_no int>>"
)


def window_texts(text, size, overlap):
    out, start = [], 0
    while text and start < len(text):
        out.append(text[start:start + size])
        if start + size >= len(text):
            break
        start += size - overlap
    return out


@pytest.mark.parametrize("long_text", [100_000, 10])
@pytest.mark.parametrize("size,overlap", [(1024, 100), (10, 9), (7, 0), (5, 3)])
def test_windows_of_every_length(spark, monkeypatch, long_text, size, overlap):
    monkeypatch.setattr(windows, "_LONG_TEXT", long_text)
    lengths = [0, 1, 924, 1023, 1024, 1025, 1948, 1949, *range(2, 40)]
    texts = {i: ("añb😀c\n" * 400)[:n] for i, n in enumerate(lengths)}
    texts[len(lengths)] = None
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in char_windows(docs, size, overlap).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got == {i: w for i, t in texts.items() if (w := window_texts(t, size, overlap))}


def test_window_parameters(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for size, overlap in ((10, 10), (10, 11), (0, 0), (5, -1)):
        with pytest.raises(ValueError):
            char_windows(docs, size, overlap)


def test_tables_stay_whole_and_metadata_is_copied(spark):
    rows = [(1, "a|b" * 1000, {"k": "v"}), (2, "word " * 500, {"k": "w"})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, meta map<string,string>")
    got = routed_chunks(docs).orderBy("doc_id", "chunk_no").collect()
    assert got[0].text == rows[0][1] and got[0].content_type == "table"
    assert [r.doc_id for r in got] == [1, 2, 2, 2]
    assert all(r.meta == rows[r.doc_id - 1][2] for r in got)


def random_chunks(seed, documents, length, change=0.05):
    rnd = random.Random(seed)
    for doc in range(documents):
        headings = None
        for pos in range(length):
            if rnd.random() < change:
                headings = rnd.choice([["a"], ["b"], None])
            words = rnd.choice([0, 1, 3, 5, 9, 30])
            text = " ".join(f"w{i}" for i in range(words)) or "..."
            yield doc, pos, headings, text, [(f"#/texts/{pos}", "TEXT", 1)]


def greedy(rows, cap):
    out, open_group = {}, None
    for doc, pos, headings, text, _ in rows:
        n = len(text.split()) if text != "..." else 0
        room = cap - (1 if headings else 0)
        if open_group and open_group[:2] == [doc, headings] and open_group[2] + n <= room:
            open_group[2] += n
            open_group[3].append(text)
        else:
            open_group = [doc, headings, n, [text]]
            out[doc, pos] = open_group
    return {key: (g[1], "\n".join(g[3])) for key, g in out.items()}


@pytest.mark.parametrize("fold_rows", [4096, 10])
def test_merging_is_greedy(spark, monkeypatch, fold_rows):
    monkeypatch.setattr(hybrid, "FOLD_ROWS", fold_rows)
    rows = list(random_chunks(7, 4, 120, 0.02))
    merged = merge_peers(spark.createDataFrame(rows, CHUNKS), 20).collect()
    assert {(r.doc_id, r.pos): (r.headings, r.text) for r in merged} == greedy(rows, 20)
    assert sum(len(r["items"]) for r in merged) == len(rows)


def test_without_pressure_runs_of_equal_headings_merge(spark):
    rows = list(random_chunks(9, 3, 40, 0.2))
    merged = merge_peers(spark.createDataFrame(rows, CHUNKS)).collect()
    assert {(r.doc_id, r.pos): (r.headings, r.text) for r in merged} == greedy(rows, 10**6)


def test_split_pieces_fit_and_give_the_text_again(spark):
    frame = spark.createDataFrame(list(random_chunks(2, 3, 60)), CHUNKS)
    pieces = split_long_chunks(frame, 7)
    worst = pieces.select(F.max(F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")))).first()[0]
    assert worst == 7
    whole = pieces.groupBy("doc_id", "pos").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]
            ),
            "",
        ).alias("whole")
    )
    back = frame.join(whole, ["doc_id", "pos"])
    assert back.where("text <> whole").isEmpty() and back.count() == frame.count()


def test_headings_that_fill_the_limit_are_dropped(spark):
    rows = [(1, 0, ["one two three"], "a b c d", [("#/texts/0", "TEXT", 1)])]
    got = split_long_chunks(spark.createDataFrame(rows, CHUNKS), 3).orderBy("piece").collect()
    assert [(r.headings, r.text) for r in got] == [(None, "a b c"), (None, " d")]
    with pytest.raises(ValueError):
        split_long_chunks(spark.createDataFrame(rows, CHUNKS), 0)


def test_dense_ids_of_text_keys(spark, monkeypatch):
    monkeypatch.setattr(scan, "SUMMARY_ROWS", 20)
    rows = [(f"é{d % 37}", p) for d in range(60) for p in range(d % 9)]
    frame = spark.createDataFrame(rows, "doc_id string, pos int").distinct()
    got = number_rows(frame, "doc_id", "pos", global_id="id", block_rows=2).collect()
    want = sorted(set(rows), key=lambda r: (r[0].encode(), r[1]))
    assert [(r.doc_id, r.pos) for r in sorted(got, key=lambda r: r.id)] == want
    assert sorted(r.id for r in got) == list(range(len(want)))


def test_many_lists_keep_their_numbers(spark):
    html = "".join(f"<ul><li>a{i}</li></ul>" for i in range(505)) + "<nav><ul><li>m0</li></ul><ul><li>m1</li></ul></nav>"
    rows = page_elements(spark.createDataFrame([(1, html)], "page_id bigint, html string")).collect()
    assert len(rows) == 507 and len({r.group_ref for r in rows}) == 507


@pytest.mark.parametrize("summary_rows", [1_000_000, 20])
def test_dense_ids(spark, monkeypatch, summary_rows):
    monkeypatch.setattr(scan, "SUMMARY_ROWS", summary_rows)
    rnd = random.Random(4)
    rows = [(d, p) for d in rnd.sample(range(10_000), 60) for p in range(rnd.randint(1, 30))]
    rows += [(5, 20_000 + p) for p in range(2000)]  # one group far larger than the rest
    frame = spark.createDataFrame(rows, "doc_id long, pos int").distinct()
    got = number_rows(frame, "doc_id", "pos", global_id="id", block_rows=8)
    got = [tuple(r) for r in got.select("doc_id", "pos", "id", "chunk_no").collect()]
    want, counts = [], {}
    for i, (doc, pos) in enumerate(sorted(set(rows))):
        want.append((doc, pos, i, counts.setdefault(doc, 0)))
        counts[doc] += 1
    assert sorted(got) == want


def test_chunk_table_rows(spark):
    items = [("#/texts/3", "TEXT", 2), ("#/tables/4", "TABLE", 1), ("#/texts/x", "TEXT", None)]
    rows = [(7, 0, ["A", "B"], "body text", items), (7, 1, None, "rest", [("#/texts/9", "LIST", 5)])]
    first, second = chunk_table(spark.createDataFrame(rows, CHUNKS)).orderBy("id").collect()
    assert first.content == "A\nB\nbody text" and first.chunk_header == "A, B"
    assert first.num_tokens == 4 and first.page_numbers == [1, 2]
    assert first.table_ids == [4] and first.text_ids == [3, None]
    assert (second.id, second.chunk_no, second.chunk_header) == (1, 1, "")
    assert (second.table_ids, second.text_ids, second.content) == ([], [], "rest")


def test_chunk_table_schema(spark):
    schema = chunk_table(spark.createDataFrame([], CHUNKS)).schema
    assert [f"{f.name} {f.dataType.simpleString()}" for f in schema] == [
        "id bigint",
        "num_tokens bigint",
        "table_ids array<bigint>",
        "text_ids array<bigint>",
        "page_numbers array<bigint>",
        "chunk_header string",
        "content string",
        "doc_id bigint",
        "chunk_no bigint",
    ]


def test_markdown(spark):
    rows = spark.createDataFrame([("g", 2, "y", None), ("g", 1, "x", 5)], "g string, o int, a string, b int")
    shown = markdown_tables(rows, "g", "o", {"A": "a", "B": "b"}).first()
    assert shown.markdown == "| A | B |\n| --- | --- |\n| x | 5 |\n| y |  |"
