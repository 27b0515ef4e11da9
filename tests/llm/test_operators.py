"""Every operator on rows with nulls, empty and long texts, ties, repeated rows, clashing extra
columns and empty tables, and against brute force."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auditlens.llm import bpe, components, html_extract, language_id, mixing, neighbours, ngram_join, quality, suffix_dedup, toxicity, warc
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid long, part int, key string, `_copy` int"
FILE = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeiounrstl") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Rows with every oddity, and near copies, copies and shared passages."""
    base, passage, small = prose(1, 300), prose(2, 60), "one two three four five six seven eight nine"
    w = base.split()
    texts = [base, base, " ".join(w[:100] + ["edit"] + w[101:]), " ".join(w[:290]), base.upper(), None, "", " \n\t ", "word", "word", "Word",
             "a b c d", "a b c d", small, small + " ten", small.replace("nine", "ten"), prose(3, 50) + " " + passage, passage + " " + prose(4, 40),
             prose(5, 20) + "\n" + passage + "é", "é" * 150 + passage, "x" * 30_000, "ab " * 5_000, prose(6, 6_000), "日本 語 x", "a\x00b \x1f c", "same line here\n" * 3 + prose(7, 60)]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, ""][i % 4], None, 7, 1, "k", 0) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[16], (None, prose(8, 30), None, None, 1, 1, 1, "k", 1), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return spark.createDataFrame([], DOCS)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_join_equals_brute_force(docs, nothing, pairs):
    got = rows_of(ngram_join.ngram_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(pairs), key=repr)
    assert ngram_join.ngram_components(nothing).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_join_of_many_small_and_large_sets(spark, docs, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(250):
        w = prose(i % 25, rng.choice([3, 6, 9, 10, 13, 14, 15, 19, 24, 40, 90])).split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(["x", "y"])
        rows.append((i, " ".join(w[: rng.randint(max(1, len(w) - 2), len(w))])))
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute.components(rows), key=repr)


def test_subsets_and_bitmaps_lose_no_link():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 62, int(rng.integers(0, 3)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        link = 100 * both >= 80 * (len(a) + len(b) - both)
        assert not link or ngram_join.bits_allow(ngram_join.parity_bits(a), ngram_join.parity_bits(b), len(a), len(b), 80)
        if len(a) <= 14 and len(b) <= 14 and link:
            assert set(ngram_join._subset_keys(a, 80)[0]) & set(ngram_join._subset_keys(b, 80)[0])


def test_one_of_each_group_stays(docs, nothing, pairs):
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns and ngram_join.one_of_each_group(nothing).count() == 0
    roots = brute.linked([brute.shingles(t) for _, t in pairs])
    blank = sum(not brute.shingles(t) for _, t in pairs)
    assert kept.count() == len({r for r, (_, t) in zip(roots, pairs) if brute.shingles(t)}) + blank
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert 0 in ids and 1 not in ids and 2 not in ids


def test_components_of_a_path_a_star_and_loops(spark, docs):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (140, 101), (None, 3)]
    got = dict(rows_of(components.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 141)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passages_equal_brute_force(docs, nothing, pairs):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(suffix_dedup.repeated_passages(docs), *columns) == sorted(brute.without_repeats(pairs), key=repr)
    assert suffix_dedup.repeated_passages(nothing).count() == 0


@pytest.mark.parametrize("bucket", [2, 4096])  # 2: nearly every gram is compared across buckets
def test_passages_with_edits_at_every_distance(spark, docs, bucket):
    rng = random.Random(3)
    base = prose(9, 250)
    rows = []
    for i in range(60):
        a = rng.randrange(len(base) - 260)
        piece = list(base[a : a + rng.randint(190, 700)])
        for _ in range(rng.randint(0, 2)):
            piece[rng.randrange(len(piece))] = "#"
        rows.append((i, prose(100 + i, rng.randint(0, 30)) + "".join(piece) + prose(200 + i, rng.randint(0, 30))))
    got = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket)
    assert rows_of(got, *got.columns) == sorted(brute.without_repeats(rows), key=repr)


def test_cut_texts_stay_whole_characters(docs, nothing):
    got = suffix_dedup.without_passages(docs)
    assert got.columns == docs.columns and got.count() == docs.count() and suffix_dedup.without_passages(nothing).count() == 0
    assert got.filter("n_chars != length(text)").count() == 0
    assert got.filter("doc_id = 0").first()["text"] == ""


def test_quality_counts_equal_brute_force(spark, docs, nothing, pairs):
    trusted = docs.filter("doc_id IN (0, 16, 22)")
    got = quality.quality_scores(docs, trusted)
    want = [(d, *brute.base_counts(t)) for d, t in pairs]
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == sorted(want, key=repr)
    failed = {(d, w < 50 or 100 * r > 50 * w) for d, w, _, _, _, r in want}
    assert {(r[0], r[1]) for r in got.select("doc_id", "base_failed").collect()} == failed
    assert quality.quality_scores(nothing, nothing).count() == 0
    kept = quality.quality_filter(docs, trusted)
    assert kept.columns == docs.columns and kept.count() == got.filter("kept").count() > 0
    assert quality.quality_scores(docs, nothing).filter("kept = base_failed OR mean_log_ratio != 0").count() == 0


def test_log_ratio_equals_brute_force(spark, docs):
    rows = [(i, prose(i, 60) if i % 3 else "%%% $$$ " * 40 + str(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = df.filter("doc_id % 3 > 0")
    got = {r["doc_id"]: r for r in quality.quality_scores(df, trusted).collect()}
    grams = lambda t: [t[i : i + 3] for i in range(len(t) - 2)]
    count = lambda texts: {g: n for g, n in zip(*np.unique([g for t in texts for g in grams(t)], return_counts=True))}
    target, raw = count([t for i, t in rows if i % 3]), count([t for _, t in rows])
    total = sum(target.values()) + 0.5 * quality.BUCKETS, sum(raw.values()) + 0.5 * quality.BUCKETS
    for i, t in rows:  # collisions of hashed buckets move a mean a little
        mean = np.mean([np.log((target.get(g, 0) + 0.5) / total[0]) - np.log((raw[g] + 0.5) / total[1]) for g in grams(t)])
        assert got[i]["mean_log_ratio"] == pytest.approx(mean, abs=0.05)
    assert all(got[i]["kept"] == (i % 3 != 0) for i, _ in rows)


def test_tokens_equal_the_library(docs, nothing, pairs):
    own = Tokenizer.from_file(FILE)
    want = []
    for d, t in pairs:
        ids = own.encode(t or "", add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))))
    got = bpe.encoded(docs, FILE)
    assert rows_of(got, *got.columns) == sorted(want, key=repr) and bpe.encoded(nothing, FILE).count() == 0


def test_encoder_on_random_strings():
    with open(FILE, encoding="utf-8") as f:
        encoder, own, rng = bpe.Encoder(f.read()), Tokenizer.from_file(FILE), random.Random(5)
    for letters in ("aeinthrs", "abcdefghi'stre ll  d9é ßΣİ<|>&%.中😀\x85\x1c", "<|endoftext|> a"):
        for _ in range(300):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) + rng.choice(["", "<|endoftext|>", "<|startoftext|>Z"])
            got = [i for p in encoder.split(text) for i in ([p] if isinstance(p, int) else encoder.word(p))]
            assert got == own.encode(text, add_special_tokens=False).ids, text


def test_mix_of_odd_rows(docs, nothing):
    got = mixing.mix_by_source(docs).collect()
    assert len(got) == docs.count() and mixing.mix_by_source(nothing).count() == 0
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    again = mixing.mix_by_source(docs.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and mixing.mixed_documents(nothing).count() == 0
    assert sum(len(brute.words(r["text"])) for r in copies.collect()) == sum(r["taken"] for r in got)


def test_mix_comes_near_its_targets(spark, docs):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 10 // 4]) for i in range(2000)]
    got = mixing.mix_by_source(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in "abc":
        own = [r for r, (_, _, t) in zip(sorted(got, key=lambda r: r["doc_id"]), rows) if t == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 7


def test_shares_go_on_to_others():
    assert mixing.source_targets({"a": 10, "b": 100, None: 890}) == {"a": 30.0, "b": 300.0, None: 670.0}
    assert sum(mixing.source_targets({"a": 0, "b": 0}).values()) == 0


def test_flow_over_overlapping_sources():
    """The flow fills quotas through shared patterns at the lowest cost of repetition."""
    flow = mixing.route({("a",): 10, ("a", "b"): 10, ("b",): 0}, {"a": 10, "b": 10})
    assert flow[("a",)] == {"a": 10} and flow[("a", "b")] == {"a": 0, "b": 10}
    flow = mixing.route({("a",): 10, ("a", "b"): 10, ("b", "c"): 4}, {"a": 14, "b": 12, "c": 6})
    total = {s: sum(f.get(s, 0) for f in flow.values()) for s in "abc"}
    assert total == {"a": 14, "b": 12, "c": 6} and all(sum(f.values()) <= 3 * n for f, n in zip(flow.values(), (10, 10, 4)))
    assert sum(mixing.route({("a",): 5}, {"a": 100})[("a",)].values()) == 15


def test_toxic_words_are_learned(spark, docs, nothing):
    rows, marks = [], []
    for i in range(400):
        w = prose(i, 60).split()
        if i % 4 == 0:
            w[5] = w[20] = w[40] = "xyzzy" + "abc"[i % 3]
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(frame, labels_of(spark, marks)).collect()}
    held = [r for r in got.values() if r["held_out"]]
    assert len(held) > 40 and np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.95
    odd = toxicity.toxicity_scores(docs, labels_of(spark, [(0, 1, 1), (0, 1, 0), (1, 1, 0), (2, 1, 0), (6, 1, None), (None, 1, 1)])).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in toxicity.toxicity_scores(docs, labels_of(spark)).collect() if r["score"] > 1e-9} == set()
    assert toxicity.toxicity_scores(nothing, labels_of(spark)).count() == 0


def test_models_are_distributions():
    """Class probabilities of all bytes after a context add up to 1."""
    rng = np.random.default_rng(1)
    data = np.frombuffer(bytes(rng.choice(list(b"abc"), 300)), np.uint8)
    start = np.arange(0, 300, 5)
    grams, place, _ = toxicity.word_events(data, start, start + 5)
    assert len(grams) == toxicity.ORDER and (grams[0][place == 0] == 32).all()
    order, gram, plain, toxic = [], [], [], []
    for k in range(1, toxicity.ORDER + 1):
        fits = (place >= k - 1) & (place > 0)
        g, n = np.unique(grams[k - 1][fits], return_counts=True)
        order += [k] * len(g)
        gram += g.tolist()
        plain += n.tolist()
        toxic += n.tolist()
    model = toxicity.kneser_ney(np.array(order), np.array(gram), np.array(plain), np.array(toxic))
    assert all(np.allclose(r, 0) for r in model["ratio"].values())  # equal classes: no evidence


def test_no_expression_is_cut(spark, docs):
    """The models over tables, and the statistics from joins, equal those of all counts in memory."""
    texts = [(i, i % 4 + 1, prose(i, 200) + (" Zyxwv é" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(30)] + [(30, 0, "", 0), (31, 0, None, 0), (0, 1, prose(0, 200) + " Zyxwv é", 1)]
    frame = spark.createDataFrame(texts, "doc_id long, fold int, text string, toxic int")
    counts = toxicity.gram_counts(frame).localCheckpoint()
    whole = counts.toArrow()
    model = toxicity.kneser_ney(*(whole.column(c).to_numpy() for c in ("gram_order", "gram", "plain", "toxic")))
    ratios, backs = toxicity.models(counts)
    for table, names, values in ((ratios, "grams", "ratio"), (backs, "contexts", "back")):
        got = {(r[0], r[1]): r[2] for r in table.collect()}
        want = {(k, int(g)): v for k in model[names] for g, v in zip(model[names][k], model[values][k])}
        assert got.keys() == want.keys() and all(abs(got[g] - v) < 1e-9 for g, v in want.items())
    rows = sorted((r["doc_id"], r["x"]) for r in toxicity.measured(frame.select("doc_id", "fold", "text"), toxicity.word_evidence(frame, ratios, backs)).collect())
    want = toxicity.statistics(model, pa.array([t[2] for t in texts], pa.string()))
    assert max(want) > 0 and np.allclose([x for _, x in rows], [x for _, x in sorted(zip((t[0] for t in texts), want))], atol=1e-9)
    assert not hasattr(toxicity, "MODEL_GRAMS")


def test_languages_of_switched_text(spark, docs, nothing):
    rng, rows = random.Random(2), []
    stems = {"en": ["the", "thing", "wash", "then", "ight"], "fr": ["eau", "que", "ment", "ière", "oux"]}
    for i in range(120):
        lang = "en" if i % 2 else "fr"
        w = ["".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(50)]
        if i % 5 == 0:
            w[:15] = ["".join(rng.choice(stems["fr" if lang == "en" else "en"]) for _ in range(2)) for _ in range(15)]
        rows.append((i, " ".join(w), lang))
    got = language_id.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "fr") and 0 < r["score"] <= 1 for r in got if r["held_out"])
    odd = {r["doc_id"]: r for r in language_id.languages(docs).collect()}
    assert odd[5]["lang_pred"] == odd[6]["lang_pred"] == odd[7]["lang_pred"] == "und" and odd[5]["score"] == 0
    assert odd[23]["lang_pred"] in ("en", "fr") and language_id.languages(nothing).count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    e, step, lengths = rng.random((3, 4, 2)) + 0.1, rng.random((2, 2)) + 0.1, [4, 2, 1]
    count = [sum(n > t for n in lengths) for t in range(4)]
    flat = np.concatenate([[e[i, t] for i in range(3) if lengths[i] > t] for t in range(4)])
    p = language_id._forward_backward(flat, step, np.array(count))
    paths = np.array(np.meshgrid(*[[0, 1]] * 4)).reshape(4, -1).T
    weight = np.array([np.prod([e[0, t, s] for t, s in enumerate(x)]) * np.prod([step[a, b] for a, b in zip(x, x[1:])]) for x in paths])
    at = np.concatenate([[0], np.cumsum(count)])
    for t in range(4):
        assert p[at[t], 1] == pytest.approx(weight[paths[:, t] == 1].sum() / weight.sum())


PAGES = "page_id long, url string, html string, digest string, text string, payload string, original long"


def page_rows():
    long = "<html>" + "x" * 200 + "</html>"
    rows = [(3, "http://a.b/1", long), (1, "http://a.b/\r\n2", long), (2, None, long), (2, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
            (7, "u", ""), (None, "u", long), (8, "v", "WARC/1.1\r\n\r\n" * 30), (9, "v", "é\r\n\r\nWARC/1.1" * 30), (10, "v", "é\r\n\r\nWARC/1.1" * 30), (11, "w", "y" * 3_000_000)]
    return [(*r, "clash", "clash", "clash", 1) for r in rows]


def test_archives_round_trip(spark, docs):
    pages = spark.createDataFrame(page_rows(), PAGES).repartition(3)
    want = []
    for r in page_rows():
        payload = (r[2] or "").encode()
        least = min((x[0] for x in page_rows() if (x[2] or "") == (r[2] or "") and x[0] is not None), default=None)
        again = len(payload) >= 100 and r[0] != least
        want.append((r[0], len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", least if again else None))
    got = warc.archived_pages(pages)
    assert rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_extraction_of_odd_pages(spark, docs):
    article = "<nav><a>Menu</a></nav><article class=x><header><h1>T &amp; t</h1></header><p>One<br>two <b>bold<p>Three&nbsp;&lt;</p><div class='ad'>Buy</div><form>f</form></article><footer>Foot</footer>"
    plain = "<html><head><title>No</title></head><body><div id=menu>Menu</div><p>Real {0}</p><p>We are the best site</p><section class='comments'><p>Reader</p></section><script>x('</p>')</script>"
    rows = [(1, "http://h/1", article), (2, None, None), (3, "", ""), (4, "http://h/2", "just text"), (5, "u", "<p>cut <b"), (6, "u", "<!-- never ends <p>x")]
    rows += [(20 + i, f"https://host.org/{i}", plain.format(f"text {i}")) for i in range(10)]
    got = {r["page_id"]: r for r in html_extract.extracted(spark.createDataFrame([(*r, "c", "c", "c", 1) for r in rows], PAGES)).collect()}
    assert len(got) == len(rows)
    assert got[1]["text"] == "T & t\nOne two bold\nThree <" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == got[3]["text"] == got[6]["text"] == "" and got[4]["text"] == "just text" and got[5]["text"] == "cut"
    assert all(got[20 + i]["text"] == f"Real text {i}" for i in range(10))  # the template's words are gone
    assert html_extract.extracted(spark.createDataFrame([], PAGES)).count() == 0


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "c", "c", "c", 1) for r in rows], PAGES)


def test_template_words_inside_articles_go(spark, docs):
    page = "<body><article><h1>Head {0}</h1><p>Own text {0}</p><div><p>All rights with the host</p></div>{1}</article>"
    # a line that only two articles share is the authors'
    rows = [(i, f"https://host.org/{i}", page.format(i, "<p>Said twice</p>" if i < 2 else "")) for i in range(10)]
    got = {r["page_id"]: r["text"] for r in html_extract.extracted(pages_of(spark, rows)).collect()}
    assert got == {i: f"Head {i}\nOwn text {i}" + ("\nSaid twice" if i < 2 else "") for i in range(10)}


def test_copies_of_a_page_are_one_page(spark, docs):
    copy, other = "<body id={0}><section><p>Only in copies</p></section><p>And this</p></body>", "<body><p>Other {0}</p></body>"
    mark = "<article><div><p>Marked copy</p></div></article>"
    rows = [(i, f"https://same.org/{i}", copy.format(0)) for i in range(12)]  # all pages of the host
    rows += [(100 + i, f"https://both.org/{i}", copy.format(0)) for i in range(12)] + [(200 + i, f"https://both.org/{i}", other.format(i)) for i in range(12)]
    rows += [(300 + i, f"https://mark.org/{i}", mark) for i in range(12)]
    rows += [(400 + i, f"https://script.org/{i}", f"<script>page({i})</script>" + copy.format(0)) for i in range(12)]  # other bytes, same text
    got = {r["page_id"]: r["text"] for r in html_extract.extracted(pages_of(spark, rows)).collect()}
    text = "Only in copies\nAnd this"
    want = {100 * h + i: t for h, t in enumerate((text, text, None, "Marked copy", text)) if t for i in range(12)}
    assert got == want | {200 + i: f"Other {i}" for i in range(12)}


def test_neighbours_of_odd_rows(spark, docs):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[1::7] = x[0]  # hundreds of copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5100, [0.0] * 32), (5200, [float("nan")] * 32), (5300, [1.0, None] * 16), (5400, [1.0]), (0, x[0].tolist()), (None, x[1].tolist())]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int")
    asked = F.pmod("vec_id", F.lit(100)) == 0
    got = neighbours.nearest(frame, asked).collect()
    assert len(got) == 300 and {r["query_id"] for r in got} == set(range(0, 3000, 100))
    hit = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(3000), d))[:10]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11)) and all(r["score"] == d[r["vec_id"]] for r in own)
        hit += len({r["vec_id"] for r in own} & set(want.tolist()))
    assert hit / 300 >= 0.9
    few = neighbours.nearest(frame.filter("vec_id < 4 OR vec_id > 4999"), asked).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in few) == [(0, 1), (0, 2), (0, 3)]
    assert neighbours.nearest(frame.limit(0), asked).count() == 0


def test_pigeonhole_finds_every_code():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    model = {"bits": 64}
    for radius in (20, 24, 64):
        found = []
        for t, piece in enumerate(neighbours.substrings(64)):
            buckets, which = np.unique(neighbours._bucket(codes, *piece), return_inverse=True)
            found += neighbours.probe(model, t, {"codes": codes, "buckets": buckets, "which": which}, codes[0], radius).tolist()
        assert sorted(found) == np.flatnonzero(np.bitwise_count(codes ^ codes[0]) <= radius).tolist()
