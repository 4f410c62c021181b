"""File contents, dead letters, Markdown cells."""

from uuid import uuid4

from pyspark.sql import functions as F

from passagemill.operators.markdown import markdown_tables
from passagemill.sources import dead_letters as D
from passagemill.sources.files import file_texts, scan_files
from passagemill.sources.isolation import check_isolated


def test_contents_are_decoded_and_bounded(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    files = {"a.html": "é <p>x</p>\n".encode(), "sub/B.HTML": b"\xef\xbb\xbfmark", "bad.html": b"\xff\xfe\x00", "long.html": b"x" * 500, "none.html": b"", "c.pdf": b"%PDF"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    out = file_texts(scan_files(spark, str(tmp_path), ".html"), max_bytes=100)
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error, r.length) for r in out.collect()}
    assert got == {
        "a.html": ("é <p>x</p>\n", None, 12), "B.HTML": ("mark", None, 7), "bad.html": (None, "not UTF-8", 3),
        "long.html": (None, "longer than 100 bytes", 500),
    }
    # Spark's file sources leave out empty files ("none.html")
    plan = out.where("error LIKE 'longer%'")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length,100)" in plan  # tested by the source
    scans = [line for line in plan.splitlines() if "FileScan binaryFile" in line]
    assert scans and all("content:binary" not in line for line in scans)  # longer files are listed without their content


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, html string")


def test_failed_rows_are_tried_again_a_bounded_number_of_times(spark):
    tables = D.open_parse(spark, f"letters_{uuid4().hex}", {"k": "string", "n": "int"}, {"size": "int"}, 4)
    seen = []

    def parse(rows):
        seen.append(sorted(r.html for r in rows.collect()))
        sized = rows.withColumn("size", F.length("html"))
        return check_isolated(sized, {"too short": F.col("size") > 2})

    data = [("a", 1, "good one"), ("a", 2, "x"), (None, 1, "y"), ("b", 1, "also good")]
    run = lambda rows: D.run_parse(frame(spark, rows), tables, parse, max_attempts=2)
    assert run(data) == {"parsed": 2, "failed": 2, "skipped": 0}
    assert run(data) == {"parsed": 0, "failed": 2, "skipped": 2}
    assert run(data) == {"parsed": 0, "failed": 0, "skipped": 4}  # given up
    assert seen == [["also good", "good one", "x", "y"], ["x", "y"], []]
    failed = {(r.k, r.n): (r.attempts, r.error) for r in tables.failed.read(spark).collect()}
    assert failed == {("a", 2): (2, "too short"), (None, 1): (2, "too short")}

    data[1], data[3] = ("a", 2, "longer now"), ("b", 1, "z")  # changed inputs count as new
    assert run(data) == {"parsed": 1, "failed": 1, "skipped": 2}
    assert seen[-1] == ["longer now", "z"]
    parsed = {(r.k, r.n): r.size for r in tables.parsed.read(spark).collect()}
    assert parsed == {("a", 1): 8, ("a", 2): 10}  # the stale result of b is gone
    failed = {(r.k, r.n): r.attempts for r in tables.failed.read(spark).collect()}
    assert failed == {(None, 1): 2, ("b", 1): 1}
    assert run([]) == {"parsed": 0, "failed": 0, "skipped": 0}


def test_a_run_that_died_between_its_tables(spark, monkeypatch):
    tables = D.open_parse(spark, f"letters_{uuid4().hex}", {"k": "string", "n": "int"}, {"size": "int"}, 4)
    parse = lambda least: lambda rows: check_isolated(rows.withColumn("size", F.length("html")), {"short": F.length("html") > least})
    data = frame(spark, [("a", 1, "xxx"), ("b", 1, "y")])
    D.run_parse(data, tables, parse(2))
    real, calls = D.replace_keys, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(D, "replace_keys", failing)
    try:
        D.run_parse(data, tables, parse(0))
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert D.run_parse(data, tables, parse(0))["failed"] == 0
    assert {r.k for r in tables.parsed.read(spark).collect()} == {"a", "b"}


def test_cells_stay_cells(spark):
    rows = spark.createDataFrame([(1, 1, "a|b", "x\ny\r\nz"), (1, 2, None, "\\|")], "g int, o int, a string, b string")
    shown = markdown_tables(rows, "g", "o", {"A": "a", "B": "b"}).first().markdown
    assert shown == "| A | B |\n| --- | --- |\n| a\\|b | x<br>y<br>z |\n|  | \\\\\\| |"


def test_region_states_do_not_depend_on_the_grouping(spark, data, monkeypatch):
    from passagemill.sources import elements as E

    pages = spark.read.parquet(f"{data}/pages.parquet")
    nested = "<nav><ul><li>a</nav><div class=\"ad\"><div><p>b</div><p>c</div><ol><li>d<ul><li>e</ul><li>f</ol></footer><p>g" * 40
    pages = pages.select("page_id", "html").unionByName(spark.createDataFrame([(-1, nested), (-2, ""), (-3, None)], "page_id bigint, html string"))

    def found(size):
        monkeypatch.setattr(E, "REGION_GROUP", size)
        return sorted(map(tuple, E.page_elements(pages).collect()), key=repr)

    assert found(3) == found(256) == found(100_000)
