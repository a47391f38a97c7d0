"""Pages, archives, token ids, vectors, quality, and the pipeline."""

import gzip
import hashlib
import os
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import classes_of, documents, near_classes, odd_rows, words
from tidemark.llm import bpe, collisions, html_text, quality, warc
from tidemark.llm.common import written
from tidemark.llm.queries import QUERIES
from tidemark.session import scratch_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PAGES = "page_id bigint, url string, html string, path string, text string, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def main(html):
    page = html_text.Page(html)
    return page.text({page.main()})


def test_main_text_leaves_out_the_rest():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page">
      <div class="cookie-notice">We use cookies</div><header><h2>Site</h2></header><nav><a href=/>Home</a></nav>
      <div id="sidebar"><p>Most read</p></div>
      <article class="post"><h1>Title &amp;  more</h1><p>First <b>bold
        text</b> here.<p>Second &lt;p&gt; &#233;&nbsp;end<br>line<script>var a = "</p>";</script></p>
        <ul><li>one<li>two</ul><aside>Aside</aside><div class="adBox">Buy!</div>
        <form><label>Name</label><input></form><table><tr><td>a<td>b</table>
        <section class="comments"><p>I liked it very much and I write a lot of text here</p></section></article>
      <!-- <p>hidden</p> --><footer>&copy; Site</footer></body></html>"""
    assert main(html) == "Title & more\nFirst bold text here.\nSecond <p> é end line\none\ntwo\na\nb"


@pytest.mark.parametrize("html", ["", " ", "<", "<p", "<p>", "</p></div>", "<script>never closed <p>x", "<a href='" + "x" * 9000, "<!--", "<div class=ad>x</div>"])
def test_broken_pages_have_no_text(html):
    assert main(html) in ("", "<", "<p", "<a href='" + "x" * 9000)


@pytest.mark.parametrize("size", [5_000, 1_000_000])
def test_attributes_of_any_length(size):
    data = "x>" * (size // 2)
    assert main(f"<p>one <img src='data:{data}' alt=x> two</p>") == "one two"
    assert main(f'<p>text</p><div class="sidebar" data-x="{data}"><p>menu</p></div>') == "text"
    assert main(f"<p>text</p><nav data-x='{data}'>menu</nav><form data-x='{data}'>form</form><p>end</p>") == "text\nend"
    assert main(f'<p>text</p><script data-x="{data}">var a = "<p>code</p>";</script><p>end</p>') == "text\nend"
    assert main(f"<div><p>text</p><div data-x='<div class=sidebar id=\"ad\"> {data}'><p>kept</p></div></div>") == "text\nkept"


def test_quotes_that_open_nothing():
    assert main("<p title=don't>one</p><p alt=\"5\" tall\">two</p><p data-id='ad'>three</p>") == "one\ntwo\nthree"


def test_tags_that_never_end_cost_no_more():
    for part in ("<a ", "<a x='y' ", "<a x=\"", "<a x=\" y=' ", "<!", "<a x='>", "</a =  "):
        started = time.process_time()
        for end in ("", "<a x=\"' "):
            assert list(html_text.tokens("<p>text</p>" + part * 100_000 + end))[0].group() == "<p>"
        assert time.process_time() - started < 20
    rng = random.Random(4)
    for _ in range(3000):
        html = "".join(rng.choice(["<a", "<b ", "</a", "<!", " ", "=", "= ", '"', "'", "x", ">", "<!--", "-->"]) for _ in range(rng.randrange(30)))
        assert [m.span() for m in html_text.tokens(html)] == [m.span() for m in html_text.TOKEN.finditer(html)]


def test_deep_and_long_pages():
    assert main("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    text = "word " * 300_000
    assert main(f"<nav>menu</nav><p>{text}</p>") == text.strip()


def test_hosts_agree_on_a_path(spark):
    row = lambda i, body: (i, f"http://h{i % 2}.example/{i}", f"<html><body>{body}</body></html>")
    full = lambda i: row(i, f"<div class='c{i}'><div class='story'><p>{'text ' * 30}{i}</p></div><div class='box'><p>other</p></div></div>")
    rows = [full(i) for i in range(20)]
    rows.append(row(21, f"<div class='c9'><div class='story'><p>short</p></div><div class='box'><p>{'noise ' * 50}</p></div></div>"))
    rows += [(30, None, None), (31, "no url", "<p>alone</p>"), (32, None, ""), (33, "http://h1.example/", "<nav>only</nav>"), full(0)]
    found = html_text.main_text(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r for r in found}
    assert by[21].text == ("noise " * 50).strip() and by[21].path == "html/body/div.c#/div.box"  # a page alone keeps its own
    assert by[4].text == "text " * 30 + "4" and by[31].text == "alone"
    assert [by[i].text for i in (30, 32, 33)] == ["", "", ""]
    assert html_text.main_text(pages(spark, [])).count() == 0


def test_pages_without_a_host_do_not_vote(spark):
    lead = f"<body><div class=a><p>{LONG}</p></div><div class=z><p>tiny</p></div></body>"
    own = f"<body><div class=a><p>tiny</p></div><div class=z><p>{LONG}</p></div></body>"
    rows = [(1, None, lead), (2, None, lead), (3, None, own), (4, "no url", own), (5, "/path", lead)]
    rows += [(6, "http://h/", lead), (7, "http://h/", lead), (8, "http://h/", own)]
    assert {r.text for r in html_text.main_text(pages(spark, rows)).collect()} == {LONG.strip()}


@pytest.mark.parametrize("part, want", [
    ('<header class="entry-header"><h1>Headline</h1></header>', "Headline"), ('<header class="header"><h1>Headline</h1></header>', "Headline"),
    ('<h2 id="how-to-subscribe">How to subscribe</h2>', "How to subscribe"), ('<h2 id="related">Related</h2>', "Related"),
    ('<section id="related-work"><h2>Related work</h2><p>it</p></section>', "Related work\nit"), ('<p class="share-price">5</p>', "5"),
    ('<p class="notice">mind</p>', "mind"), ('<p>a <span id="search">b</span> <label>c</label></p>', "a b c"),
    ('<p>a <span class="ad">b</span> c</p>', "a c"), ('<div class="share-buttons">x</div>', ""), ('<div id="comments"><p>x</p></div>', ""),
    ('<div class="post-comments"><p>x</p></div>', ""), ('<div class="cookie-banner">x</div>', ""), ('<div class="advertising-history">x</div>', "x"),
    ('<aside>x</aside><form><label>x</label></form>', ""), ('<div class="postHeader">x</div>', "x"), ('<div class="newsletter-signup">x</div>', ""),
])
def test_parts_of_an_article_are_left_out_by_whole_names(part, want):
    assert main(f"<body><nav>menu</nav><article><p>{LONG}</p>{part}<p>end</p></article></body>") == "\n".join(filter(None, [LONG.strip(), want, "end"]))


def test_outside_an_article_too():
    html = f'<div class="site-header">a</div><div id="main-nav">b</div><div class=post><div class="entry-header"><h1 id="notice-of-it">c</h1></div><p>{LONG}</p></div>'
    assert main(html) == "c\n" + LONG.strip()


@pytest.mark.parametrize("html", [
    "<div>" * 20_000 + "x" + "</div>" * 20_000, "<b>" * 20_000 + "</i></u>" * 10_000 + "x", "<p><b>" * 20_000 + "x",
    "<ul>" + "<li><b>x" * 10_000, "<div><p>x</p>" * 15_000, "<span>" * 10_000 + "<li>x" * 10_000, "<table>" + "<tr><td><i>x" * 10_000,
    "<div class=a>" * 10_000 + "<p>x</p></div>" * 10_000,
])
def test_time_in_proportion_to_the_page(html):
    started = time.process_time()
    page = html_text.Page(html)
    path, text = page.reading(page.path(page.main()))
    assert "x" in text and time.process_time() - started < 2


LONG = "word " * 60


@pytest.mark.parametrize("html, want", [
    (f"<body><div class=post><h1>title</h1><p>lead</p><div class=entry-content><p>{LONG}</p></div><div class=more><p>last part</p></div></div></body>",
     ["title", "lead", LONG.strip(), "last part"]),
    (f"<div class=post><p>before</p><blockquote>{LONG}</blockquote><p>after</p></div>", ["before", LONG.strip(), "after"]),
    (f"<div class=post><p>before</p><table><tr><td>{LONG}</td></tr></table><p>after</p></div>", ["before", LONG.strip(), "after"]),
    (f"<div class=post><div class=intro>{'x' * 60}</div><div class=entry><p>{LONG}</p></div><div class=more>{'y' * 90}</div></div>",
     ["x" * 60, LONG.strip(), "y" * 90]),
    (f"<h1>title</h1><div><p>{LONG}</p></div><div class=sidebar>menu</div>", ["title", LONG.strip()]),
])
def test_pages_without_an_article_are_kept_whole(html, want):
    assert main(html) == "\n".join(want)


def test_pages_that_differ_from_their_host(spark):
    story = lambda i, more="": (i, "http://h.example/", f"<body><div class=story><p>{LONG}{i}</p></div>{more}</body>")
    review = lambda i: (i, "http://h.example/", f"<body><div class=story><p>teaser</p></div><div class=review><p>{LONG}{i}</p></div></body>")
    rows = [story(i) for i in range(8)] + [review(i) for i in (10, 11)] + [story(20, f"<h2>more</h2><p>{LONG}</p>")]
    by = {r.page_id: r for r in html_text.main_text(pages(spark, rows)).collect()}
    assert len(by) == len(rows) and by[3].text == LONG + "3" and by[3].path == "html/body/div.story"
    assert by[10].text == LONG + "10" and by[11].path == "html/body/div.review"  # a second layout, not its line at the host's path
    assert by[20].text == f"{LONG}20\nmore\n{LONG.strip()}"


def test_archives_round_trip(spark):
    same, rng = "<p>" + "long " * 300 + "</p>", random.Random(1)
    rows = [(1, "http://a/ü\r\n x", same), (2, None, same), (7, "http://b", same), (3, "u", "short"), (4, "u", "short"), (5, None, None), (6, "", "")]
    rows += [(8, "u", "x" * 999), (9, "u", "x" * 999), (10, "u", "y" * 1000), (11, "u", "y" * 1000), (None, "u", same), (12, "u", "é\x00🙂" * 3000)]
    rows += [(20 + i, f"u{i}", "".join(rng.choice("ab<>é \n") for _ in range(rng.randrange(4000)))) for i in range(40)] + [(20, "u0", "again")]
    path = scratch_dir(spark, "warc-test")
    made = warc.write_warc(pages(spark, rows).repartition(3), path)
    assert made.agg({"records": "sum"}).first()[0] == len(rows)
    found = warc.read_warc(spark, path).collect()
    assert all(r.error is None for r in found) and len(found) == len(rows)
    number = lambda u: None if u is None or u.endswith("none>") else int(u[10:-1])
    got = sorted(((number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to), None if r.payload is None else bytes(r.payload)) for r in found), key=repr)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        top = max(j for j, _, h in rows if (h or "") == (html or "") and j is not None)
        again = len(body) >= 1000 and i != top
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None, None if again else body))
    assert got == sorted(want, key=repr)
    assert warc.write_warc(pages(spark, []), scratch_dir(spark, "warc-none")).count() == 0


def test_reader_takes_members_in_small_pieces_and_tells_damage(tmp_path):
    records = [warc.record(str(i), f"http://x/{i}", os.urandom(50 * i), None) for i in range(6)]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(records))
    for size in (1, 7, 1 << 16):
        with pa.OSFile(str(path)) as file:
            found = list(warc.members(file, size))
        assert [f[0] for f in found] == [sum(map(len, records[:i])) for i in range(6)]
        assert all(warc.parsed(c, e)["error"] is None for _, c, e in found)
    path.write_bytes(b"".join(records)[:-5])
    with pa.OSFile(str(path)) as file:
        assert [e is None for _, _, e in warc.members(file)] == [True] * 5 + [False]
    plain = gzip.decompress(warc.record("1", "u", b"payload", None))
    assert warc.parsed(plain, None)["error"] is None
    assert "digest" in warc.parsed(plain.replace(b"payload", b"paYload"), None)["error"]
    assert "as long" in warc.parsed(plain + b"x", None)["error"] and "frame" in warc.parsed(plain[:-12], None)["error"]
    assert warc.parsed(b"", None)["error"] and warc.parsed(b"\xff\x00", None)["error"]


def expected_ids(text):
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("group_words", [4_000_000, 50])
def test_encoding_equals_the_library(spark, group_words):
    rng = random.Random(8)
    letters = "aB'sS tTlLrReEvVmM019²½ªº\n\t\x1c\x85\xa0ÀéßÿŸİıŁœ<|endoftext|>ΣςσΑ中文ǅ́é\x00!?-_​ 🙂"
    rows = odd_rows() + [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(400, "a<|endoftext|>B <|startoftext|>"), (401, "<|ENDOFTEXT|>")]
    coded = bpe.decode(bpe.encode(documents(spark, rows, clashing=True), TOKENIZER, group_words=group_words), TOKENIZER).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for d, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want[d, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in coded) == want
    assert bpe.encode(documents(spark, []), TOKENIZER).count() == 0


@pytest.mark.parametrize("group_words", [4_000_000, 50])
def test_encoding_gives_the_text_that_decoding_gives(spark, group_words):
    docs = documents(spark, [*odd_rows(), (400, "a<|endoftext|>B"), (401, "²½İ🙂")], clashing=True)
    both = bpe.encode(docs, TOKENIZER, group_words=group_words, decoded="size").collect()
    apart = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).collect()
    assert Counter((r.doc_id, tuple(r.ids), r["size"]) for r in both) == Counter((r.doc_id, tuple(r.ids), r.decoded) for r in apart)
    assert bpe.encode(documents(spark, []), TOKENIZER, decoded="decoded").count() == 0


def test_token_stages_keep_one_python_worker_a_task(spark, tmp_path):
    documents(spark, odd_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for made in (dict(corpus_pipeline.STAGES)["bpe"](spark, docs, str(tmp_path)), QUERIES["op9_word_table_bpe"](spark, str(tmp_path))):
        stages = made._jdf.queryExecution().executedPlan().toString().split(" Exchange ")
        assert len(stages) == 3 and [len(re.findall(r"\w+InArrow ", s)) for s in stages] == [1, 1, 1]


def test_words_are_coded_in_any_size():
    numbers = [0, 1, 127, 128, 16_383, 16_384, 2**21 - 1, 2**21, 2**28, 5]
    assert bpe.unpacked(bpe.packed(np.array(numbers))).tolist() == numbers and bpe.unpacked(bpe.packed(np.zeros(0, np.int64))).tolist() == []


VECTORS = "vec_id bigint, embedding array<float>, label int, n bigint, cid bigint"


def test_near_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1, None):
        for _ in range(60):
            base = rng.standard_normal(32)
            for _ in range(int(rng.integers(1, 6))):
                rows.append([len(rows), (base + rng.standard_normal(32) * rng.uniform(0.05, 0.5)).astype(np.float32) * np.float32(rng.uniform(0.1, 9)), label])
    hot = rng.standard_normal(32)
    rows += [[len(rows) + i, (hot + rng.standard_normal(32) * 0.1).astype(np.float32), 1] for i in range(80)]
    rows.append([len(rows), rows[0][1], 0])
    rows.append([rows[5][0], rows[5][1], rows[5][2]])  # a row that repeats
    plain = [(i, [float(x) for x in v], k) for i, v, k in rows]
    n = len(plain)
    odd = [(n, None, 0), (n + 1, [0.0] * 32, 0), (n + 2, [float("nan")] + [1.0] * 31, 0), (n + 3, [None] + [1.0] * 31, 0),
           (n + 4, [float("inf")] * 32, 0), (n + 5, [], 0), (n + 6, [1.0] * 5, 0), (n + 7, [1.0] * 5, 0), (None, plain[0][1], 0)]
    found = collisions.near_vectors(spark.createDataFrame([(*r, 1, 1) for r in plain + odd], VECTORS)).collect()
    assert len(found) == n + len(odd)
    x = np.array([np.array(v, np.float32).astype(np.float64) for _, v, _ in plain])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.93
    label = np.array([-1 if k is None else k for _, _, k in plain])
    near &= (label[:, None] == label[None, :]) & (label >= 0)[:, None]
    links = [(plain[i][0], plain[j][0]) for i in range(n) for j in range(i + 1, n) if near[i, j]] + [(n + 6, n + 7)]
    classes = classes_of([r[0] for r in plain + odd if r[0] is not None], links)
    degree = Counter((plain[i][0], int(near[i].sum() - near[i, i])) for i in range(n))
    degree.update((i, 1 if i in (n + 6, n + 7) else 0) for i, _, _ in odd)
    assert Counter((r.vec_id, r.n_links) for r in found) == degree
    for r in found:
        assert r.component_id == classes.get(r.vec_id) and r.kept == (r.vec_id == r.component_id)
    assert collisions.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_lines_grow_slowly_and_reach_the_recall():
    small, large = collisions.calibrated(1_000), collisions.calibrated(1_000_000_000)
    assert small.lines < large.lines < 1e6**0.25 * small.lines and small.cells < large.cells < 20  # a million times the rows
    rng, plan = np.random.default_rng(1), collisions.calibrated(5_000)
    hits, width = [], collisions.STEP * plan.distance
    for _ in range(300):  # pairs at the threshold itself
        u = rng.standard_normal(16)
        u /= np.linalg.norm(u)
        w = rng.standard_normal(16)
        w -= w @ u * u
        v = 0.93 * u + np.sqrt(1 - 0.93**2) * w / np.linalg.norm(w)
        axes, shift = rng.standard_normal((16, plan.lines, plan.cells + 1)), rng.random((plan.lines, plan.cells)) * width
        a, b = np.tensordot(u, axes, 1), np.tensordot(v, axes, 1)
        same = (np.floor((a[:, 1:] + shift) / width) == np.floor((b[:, 1:] + shift) / width)).all(1)
        hits.append((same & (abs(a[:, 0] - b[:, 0]) <= collisions.HALF * plan.distance)).sum() >= plan.needed)
    assert np.mean(hits) > 0.98


def labelled(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(words(rng, rng.randrange(5, 80)))
        kind = rng.randrange(3)
        if not good:
            text = [text.upper() + "!!", " ".join(w + "###" for w in text.split()), " ".join([text.split()[0]] * 60)][kind]
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_of_held_out_rows_and_brute_force(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows + [(1000, None), (1001, ""), (1002, " "), (1003, "A" * 300_000), (3, rows[3][1])], clashing=True)
    model = quality.fit(docs, labels, ~quality.held_out(quality.F.col("doc_id")))
    found = quality.scored(docs, model).collect()
    assert len(found) == len(rows) + 5 and all(0 <= r.score <= 1 for r in found)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    out = {r.doc_id for r in docs.filter(quality.held_out(quality.F.col("doc_id"))).collect()}
    held = [r for r in found if r.doc_id in out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([(r.score >= quality.ACCEPTED) == truth[r.doc_id] for r in held]) > 0.95
    mean = float(model.labels.mean())
    assert [r.score for r in found if r.doc_id in (1000, 1001)] == [mean, mean]
    vectors = quality.weighted(quality.counts(pa.array([t for _, t in rows[:30]])), model.idf).astype(np.float64) @ model.axes
    for (i, _), v in zip(rows[:30], vectors):
        near = model.voters.astype(np.float64) @ (v / np.linalg.norm(v))
        best = np.argsort(-near)[: quality.NEIGHBOURS]
        want = (near[best] * model.labels[best]).sum() / near[best].sum()
        assert abs(want - next(r.score for r in found if r.doc_id == i)) < 0.02
    again = quality.fit(docs.repartition(3), labels, ~quality.held_out(quality.F.col("doc_id")))
    assert np.allclose(again.voters, model.voters, atol=1e-3)


def test_quality_without_labels_or_documents(spark):
    docs, none = documents(spark, [(1, "a b c")]), spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(docs, none, quality.F.lit(True))
    assert [r.score for r in quality.scored(docs, model).collect()] == [1.0]
    assert quality.scored(documents(spark, []), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    assert len(quality.fit(docs, odd, quality.F.lit(True)).labels) == 0


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, labels = labelled(spark, 150, 11)
    rng = random.Random(12)
    rows += [(500 + i, rows[i * 3][1]) for i in range(20)]  # copies
    for i in range(20):
        own = rows[i * 5][1].split()
        if len(own) > 60:
            own[3] = "edited"
        rows.append((600 + i, " ".join(own)))
    rows += [(800, None), (801, ""), (500, rows[0][1]), (None, "without a number")]
    rows = [(d, t, rng.choice(["a", "a", "b", None])) for d, t, *_ in rows]
    folder = str(tmp_path)
    documents(spark, rows, clashing=True).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    model = quality.fit(docs, labels, ~quality.held_out(quality.F.col("doc_id")))
    score = {t: s for t, s in zip([t for _, t, _ in rows], model.scores(pa.array([t for _, t, _ in rows])))}

    stage = dict(corpus_pipeline.STAGES)
    one = written(stage["quality"](spark, docs, folder), "t")
    want = [r for r in rows if score[r[1]] >= quality.ACCEPTED]
    triple = lambda df: Counter((r.doc_id, r.text, r.source) for r in df.collect())
    assert triple(one) == Counter(want) and one.columns == columns

    two = written(stage["exact_duplicates"](spark, one, folder), "t")
    best = {}
    for d, t, s in want:
        if (t or "") not in best or (d is not None and (best[t or ""] is None or d > best[t or ""])):
            best[t or ""] = d
    kept = Counter({(d, t or "") for d, t, _ in want if best[t or ""] == d})
    assert Counter((r.doc_id, r.text or "") for r in two.collect()) == kept and two.columns == columns

    three = written(stage["near_duplicates"](spark, two, folder), "t")
    left = [(r.doc_id, r.text) for r in two.collect()]
    classes = near_classes(left)
    assert Counter(r.doc_id for r in three.collect()) == Counter(d for d, _ in left if d is None or classes[d] == d)
    assert three.columns == columns

    four = written(stage["source_mix"](spark, three, folder), "t")
    assert four.columns == columns and four.count() > 0
    five = stage["bpe"](spark, four, folder).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in five) == Counter((r.doc_id, tuple(expected_ids(r.text))) for r in four.collect())


def test_pipeline_of_nothing(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_length_of_odd_digits_is_damage():
    for length in ("²", "٣", "", "-1", "+3", "1_0"):
        found = warc.parsed(f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {length}\r\n\r\nabc\r\n\r\n".encode(), None)
        assert found["error"] == "the record's frame is broken"


def test_a_labelled_key_gives_one_row(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other words here")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    assert sorted(model.labels.tolist()) == [0.0, 1.0]
