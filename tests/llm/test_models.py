"""Toxicity and quality: held-out accuracy, located sentences, defined edges."""

import numpy as np

from passagemill.llm import quality, queries, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity string, quality_score string, _id int, _toxic int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", 7, 1) for i, t, s in rows], DOCS)


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    toxic = queries.QUERIES["op3_toxicity"](spark, data).collect()
    assert len(toxic) == len(texts)
    held = [(r.predicted, labels[r.doc_id].toxic) for r in toxic if r.held_out and r.doc_id in labels]
    assert sum(p == t for p, t in held) >= 0.9 * len(held) and sum(p > t for p, t in held) <= 0.02 * len(held)
    for r in toxic:
        assert bool(r.offending) == bool(r.predicted)
        for s in r.offending:
            assert 0 <= s.start < s.stop <= len(texts[r.doc_id]) and "\n" not in texts[r.doc_id][s.start:s.stop]
    good = queries.QUERIES["op7_quality"](spark, data).collect()
    held = [(r.keep, labels[r.doc_id].quality) for r in good if r.doc_id in labels]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)


def test_toxicity_finds_the_sentence(spark):
    rows = [(i, f"Calm words here {i}. A vile rant{i % 3}! More É text.", "s") for i in range(40)]
    rows += [(100 + i, f"Calm words here {i}. A kind song{i % 3}! More É text.", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.train(docs(spark, rows), labels)
    long = "Kind words. " * 20_000
    odd = [(1, "É é. Yes a VILE rant1, so.", None), (2, None, None), (3, "", "s"), (4, "...", "s"), (5, long + "a vile rant2", "s"), (5, "song", "s"), (None, "song", "s")]
    got = toxicity.score(docs(spark, odd), model).collect()
    assert len(got) == 7
    by = {(r.doc_id, r.text): r for r in got}
    first = by[1, odd[0][1]]
    assert first.toxicity > 0.5 and [odd[0][1][s.start:s.stop].strip() for s in first.offending] == ["Yes a VILE rant1, so"]
    assert by[5, odd[4][1]].toxicity > 0.5 and by[5, "song"].toxicity < 0.5
    assert [by[k].toxicity for k in ((2, None), (3, ""), (4, "..."))] == [0, 0, 0]


def test_without_labels(spark):
    d = docs(spark, [(1, "a b", "s"), (2, None, None)])
    none = spark.createDataFrame([(1, None, None), (9, 1, 1), (None, 0, 0)], "doc_id bigint, toxic int, quality int")
    assert [r.toxicity < 1e-6 for r in toxicity.score(d, toxicity.train(d, none)).collect()] == [True, True]
    assert [r.quality_score for r in quality.score(d, quality.train(d, none)).collect()] == [1.0, 1.0]
    empty = docs(spark, [])
    assert toxicity.score(empty, toxicity.train(empty, none)).collect() == []
    assert quality.score(empty, quality.train(empty, none)).collect() == []


def test_quality_edges(spark):
    rows = [(i, f"Some plain words of text number {i} follow here.", "a") for i in range(30)] + [(50 + i, "buy buy buy! " * (i + 5), "b") for i in range(30)]
    labels = spark.createDataFrame([(i, int(i < 50)) for i, _, _ in rows], "doc_id bigint, quality int")
    model = quality.train(docs(spark, rows), labels)
    odd = [(1, rows[0][1], "a"), (2, "buy buy buy! " * 9000, "b"), (3, None, None), (4, "", "zz"), (4, "", "zz")]
    got = {(r.doc_id, r.source): r.quality_score for r in quality.score(docs(spark, odd), model).collect()}
    assert got[1, "a"] > 0.5 > got[2, "b"] and 0 <= got[3, None] <= 1 and 0 <= got[4, "zz"] <= 1
    pool = docs(spark, rows + [(200 + i, t, s) for i, (_, t, s) in enumerate(rows)])
    assert sum(map(sum, quality.train(pool, labels)["exchanged"])) > 0


def test_all_unlabelled_documents_take_part(spark):
    rows = [(i, f"Some plain words of text number {i} follow here.", "a") for i in range(30)] + [(50 + i, "buy buy buy! " * (i + 5), "b") for i in range(30)]
    labels = spark.createDataFrame([(i, int(i < 50)) for i, _, _ in rows], "doc_id bigint, quality int")
    # a source without labels, known only from what the text view says of its documents
    pool = rows + [(200 + i, t, "c" if i < 30 else s) for i, (_, t, s) in enumerate(rows)]
    model = quality.train(docs(spark, pool), labels)
    assert sum(model["exchanged"][0]) > 2 * 6
    page = model["views"][1]
    source = [page.base[3] + int(quality.page_features(np.zeros(0, np.uint8), np.zeros(2, np.int64), [s], ["en"])[0, 3]) for s in "abc"]
    assert page.weights[source[2]] > 0.01 and page.weights[source[0]] > 0 > page.weights[source[1]]
    again = quality.train(docs(spark, pool[::-1]).repartition(5), labels)
    assert all((x.weights == y.weights).all() for x, y in zip(model["views"], again["views"], strict=True))


def test_labels_of_other_documents_take_no_places(spark):
    rows = [(i, f"Calm words here {i}. A {'vile rant' if i % 2 else 'kind song'}{i % 3}!", "s") for i in range(40)]
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic", "CAST(1 - id % 2 AS int) AS quality")
    model = toxicity.train(docs(spark, rows), labels, max_labelled=40)
    assert len(model["words"]) and quality.train(docs(spark, rows), labels, max_labelled=40) is not None


def test_repeated_rows_of_a_labelled_document_are_fitted_once(spark, monkeypatch):
    """The bound on labelled documents is one on the rows that come to the driver."""
    rows = [(i % 4, f"clean words here {i % 4}." if i % 4 < 2 else f"vile words here {i % 4}!") for i in range(400)]
    documents = spark.createDataFrame([(i, t, "s", "en") for i, t in rows], "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i >= 2), int(i < 2)) for i in range(4)], "doc_id bigint, toxic int, quality int")
    seen = []
    real = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a: seen.append(len(a[3])) or real(*a))
    toxicity.train(documents, labels, 4)
    assert seen == [4]
    seen = []
    monkeypatch.setattr(quality, "co_train", lambda text, *a: seen.append(len(text)))
    many = spark.createDataFrame([(i, int(i % 2)) for i in range(10)], "doc_id bigint, quality int")
    more = spark.createDataFrame([(i % 10, f"text {i % 10}", "s", "en") for i in range(200)], documents.schema)
    quality.train(more, many, 10)
    assert seen == [10]


def test_score_is_the_noisy_or_of_a_loop(spark):
    import math
    import re

    def hash_of(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(toxicity.sentences(data, np.array([0, len(data)]))["word"][0])

    weight = {"vile": 2.5, "bad": 1.0, "kind": -1.5, "wörter": 0.7}
    pairs = sorted((hash_of(w), v) for w, v in weight.items())
    model = {"words": np.array([h for h, _ in pairs], np.uint64), "weights": np.array([v for _, v in pairs]), "offset": -3.0}
    texts = ["vile bad. kind vile! nothing", "Kind\nBAD bad WÖRTER? x", "", None, "...", "vile " * 50 + ". " + "bad! " * 40, "one"]

    def expected(text):
        clean = 1.0
        for sentence in re.split(r"[.!?\n\r]", (text or "").lower()):
            words = set(re.findall(r"\w+", sentence))
            if words:
                clean *= 1 - 1 / (1 + math.exp(3.0 - sum(weight.get(w, 0) for w in words)))
        return 1 - clean

    got = toxicity.score(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), model)
    for r in got.select("doc_id", "text", "toxicity").collect():
        assert abs(r.toxicity - expected(r.text)) < 1e-9


def test_only_words_of_several_documents_come_to_the_fit(spark, monkeypatch):
    rows = [(i, f"calm words own{i} other{i}. A {'vile rant' if i % 2 else 'kind song'}! lone{i}", "s") for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, toxic int")
    seen, real = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a: seen.append(a) or real(*a))
    whole = toxicity.train(docs(spark, rows), labels)
    words, sentence, doc, of = seen[0][:4]
    assert len(words) == len(sentence) == 30 * 5 and words.dtype.itemsize == 4
    assert doc.tolist() == [i for i in range(30) for _ in range(3)] and of.tolist() == [i % 2 for i in range(30)]
    # small pieces give the very same model
    monkeypatch.setattr(toxicity, "PIECE", 7)
    pieces = toxicity.train(docs(spark, rows[::-1]).repartition(3), labels)
    assert all((whole[k] == pieces[k]).all() for k in ("words", "weights")) and whole["offset"] == pieces["offset"]
