"""Texts of regular structure, deep pages, odd names and ids that stand twice."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.llm import html_extract, mixing, neighbours, ngram_join, quality
from auditlens.llm.text import running, span_hash
from tests.llm import brute


def thue_morse(n, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


LONG = [thue_morse(2048), thue_morse(2048, True), thue_morse(4096), thue_morse(4096, True)]


def test_long_texts_of_regular_structure_have_hashes_of_their_own():
    texts = LONG + ["a" * 300, "a" * 301, "ab" * 150, "x" * 256 + "y" * 256, "y" * 256 + "x" * 256]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    start = end - [len(t) for t in texts]
    assert len(set(span_hash(running(data), start, end).tolist())) == len(texts)
    again = np.frombuffer(("zz" + texts[2]).encode(), np.uint8)  # equal wherever it stands
    assert span_hash(running(again), np.array([2]), np.array([2 + 4096]))[0] == span_hash(running(data), start, end)[2]


def test_documents_of_regular_words_are_not_linked(spark):
    rows = [(i, " ".join(f"{LONG[(i + j) % 2]}{'c' * (j // 2)}" for j in range(8))) for i in range(2)] + [(2, LONG[0]), (3, LONG[1])]
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert found == sorted(brute.components(rows), key=repr)


def test_lines_of_regular_structure_are_no_repeats(spark):
    docs = spark.createDataFrame([(1, f"{LONG[0]}\n{LONG[1]}\n{LONG[0]}", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_scores(docs, quality.trusted_documents(docs, labels)).first()["n_dup_lines"] == 1


PAGES = "page_id long, url string, html string"


def text_of(spark, html):
    (row,) = html_extract.extracted(spark.createDataFrame([(1, "http://a.b/c", html)], PAGES)).collect()
    return row["text"]


@pytest.mark.parametrize("depth", [10, 410, 3000])
def test_deep_pages_keep_articles_and_lose_menus(spark, depth):
    deep = "<div>" * depth + "<nav>menu</nav><article><p>" + "<b>" * 200 + "one</p><p>two</p></article>" + "</div>" * depth
    assert text_of(spark, f"<html><body>{deep}</body></html>") == "one\ntwo"


@pytest.mark.parametrize("name,kept", [("share-price", True), ("search-results", True), ("form-of-words", True), ("cookie-banner", False), ("site-footer", False),
                                       ("relatedPosts", False), ("ad", False), ("x ad", False), ("admin", True)])
def test_names_count_as_a_whole(spark, name, kept):
    page = f'<body><p>before</p><div class="{name}"><p>words</p></div><p>after</p></body>'
    assert text_of(spark, page) == ("before\nwords\nafter" if kept else "before\nafter")


def test_sources_with_odd_names_have_targets(spark):
    names = ["s\x0b", 'quote"', "back\\slash", "tab\t", "é ", "", None, "\x7f"]
    rows = [(i, "w " * (5 + i), names[i % len(names)]) for i in range(40)]
    got = mixing.mix_by_source(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    assert len(got) == 40 and {r["doc_id"]: r["source_size"] for r in got} == {i: size[s] for i, _, s in rows}
    assert all(r["target"] is not None for r in got)


def test_an_id_with_two_vectors_counts_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(300)]
    rows += [(100, [9.0] * 8, 1), (7, [-9.0] * 8, 1)]
    best = {}
    for i, x, _ in rows:
        x = np.array(x, np.float32)
        best[i] = min(best.get(i, tuple(x)), tuple(x))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = neighbours.nearest(df.repartition(4), F.col("vec_id") % 100 == 0)
    for r in got.collect():
        gap = np.array(best[r["query_id"]], np.float64) - np.array(best[r["vec_id"]], np.float64)
        assert r["score"] == pytest.approx(float(np.sqrt((gap**2).sum())), abs=1e-12)
    assert got.groupBy("query_id", "rank").count().filter("count > 1").isEmpty()
