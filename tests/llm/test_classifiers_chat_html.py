"""Held-out accuracy of the classifiers, round trips of chats, text of hand-written pages."""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallymatch.llm import chat, html_text, quality_classifier, toxicity

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "module, query, label, least",
    [(toxicity, toxicity.toxicity, "toxic", 0.95), (quality_classifier, quality_classifier.quality_classifier, "quality", 0.97)],
)
def test_held_out_accuracy(spark, module, query, label, least):
    scored = query(spark, SF)
    assert scored.count() == 10_000
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 500
    assert sum(r.predicted == r[label] for r in rows) / len(rows) >= least
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.mark.parametrize("module", [toxicity, quality_classifier])
def test_classifier_cases(spark, module, nasty, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = module.train(docs, labels)
    rows = module.score(nasty, model).collect()
    assert len(rows) == nasty.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.score)
    assert by_id[2] == by_id[3] and len(by_id[8]) == 1  # null is empty; repeated rows agree
    assert module.score(empty, model).count() == 0
    none = module.train(docs, labels.limit(0))
    assert {r.score for r in module.score(nasty, none).collect()} == {0.0}
    # Nothing is learned from held-out rows: turning their labels round changes no score.
    turned = labels.withColumn(
        "toxic", labels.toxic if module is quality_classifier else _turned(labels, module, "toxic")
    ).withColumn("quality", labels.quality if module is toxicity else _turned(labels, module, "quality"))
    assert module.score(nasty, module.train(docs, turned)).collect() == rows


def _turned(labels, module, name):
    from pyspark.sql import functions as F

    from tallymatch.llm.calibration import held_out

    aside = held_out(F.col("doc_id"), module.MODULUS, module.REMAINDER)
    return F.when(aside, 1 - labels[name]).otherwise(labels[name])


def test_toxicity_stage(spark, nasty):
    kept = toxicity.stage(spark, nasty, SMALL)
    assert kept.columns == nasty.columns
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in nasty.collect()}
    assert 1 in {r.doc_id for r in kept.collect()}


def test_held_out_toxic_rows(spark):
    """Few rows are toxic, so accuracy says little of them.  Found on sf0.1: 77 of 97, and 77 of 81 are right."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.toxicity(spark, SF).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    toxic, predicted = sum(r.toxic for r in rows), sum(r.predicted for r in rows)
    assert toxic > 50
    assert hits / toxic >= 0.75 and hits / predicted >= 0.9


def test_toxicity_stage_removes_toxic(spark):
    """Of labelled rows the model has not seen, the stage takes 77 of 97 toxic ones and leaves 724 of 728 clean ones."""
    from pyspark.sql import functions as F

    from tallymatch.llm.calibration import held_out

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    aside = held_out(F.col("doc_id"), toxicity.MODULUS, toxicity.REMAINDER)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(aside)
    kept = {r.doc_id for r in toxicity.stage(spark, docs, SF).select("doc_id").collect()}
    toxic, clean = ([r.doc_id for r in labels.where(f"toxic = {k}").collect()] for k in (1, 0))
    assert sum(k in kept for k in toxic) <= 0.25 * len(toxic)
    assert sum(k in kept for k in clean) >= 0.98 * len(clean)


def test_chat(spark):
    sf = "/root/testdata/sf0.01"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in chat.chat(spark, sf).collect()}
    assert set(got) == set(turns)
    for key, rows in turns.items():
        rows.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        learned = "".join(text for _, role, text in rows if role == "assistant")
        assert got[key].n_turns == len(rows)
        assert got[key].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[key].loss_chars == len(learned)
        assert got[key].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_folds_events(spark):
    log = [
        (1, 1, "a", "start", "user", "hi"),
        (1, 2, "b", "start", "assistant", "x"),
        (1, 3, "b", "delta", "assistant", " y"),
        (1, 4, "b", "regenerate", "assistant", None),
        (1, 7, "b", "delta", "assistant", "[t]\\"),
        (1, 5, "b", "delta", "assistant", "new "),
        (1, 6, "a", "edit", "user", "hello <s>"),
        (1, 9, "c", "start", None, "odd"),
        (2, 1, "d", "delta", "tool[]", "a"),
        (2, 2, "d", "delta", "tool[]", "b"),
        (None, None, "e", "start", "user", None),
    ]
    rendered = chat.render(chat.fold(spark.createDataFrame(log, chat.LOG)))
    rows = rendered.collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id or 0, r.seq or 0)):
        got[r.conv_id].append(chat.read_piece(r.piece))
        if r.loss_start is not None:
            assert chat.unescape(r.piece[r.loss_start : r.loss_end]) == r.text
    assert got == {
        1: [("user", "hello <s>"), ("assistant", "new [t]\\"), ("", "odd")],
        2: [("tool[]", "ab")],
        None: [("user", "")],
    }
    assert {r.conv_id: r.n_turns for r in chat.digests(rendered).collect()} == {1: 3, 2: 1, None: 1}
    assert chat.digests(chat.render(chat.fold(spark.createDataFrame([], chat.LOG)))).count() == 0


@given(st.lists(st.sampled_from([*"\\lbe<>[]/sINT\n ", "</s>", "[INST]", "<<SYS>>"]), max_size=30).map("".join))
def test_escapes_round_trip(text):
    written = text
    for plain, code in chat.ESCAPES.items():
        written = written.replace(plain, code)
    assert "<" not in written and "[" not in written
    assert chat.unescape(written) == text


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site"><h2>Site</h2></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies <p>yes</p></div>
<main><article><header><h1>The &amp; title</h1></header><p>First  <b>bold</b>
para&nbsp;graph<br>goes on<p>Second &lt;para&gt; &#x41;<script>var t="</p>";</script> ends
<ul><li>one<li>two</ul><aside>aside</aside><div class=ad>buy</div><form><p>name<input></form>
<table><tr><td>c1<td>c2</table></article>
<section id="comments"><p>first!</p></section></main>
<div class="sidebar">side</div><footer>&copy; all</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE, set()).split("\n") == [
        "The & title",
        "First bold para graph goes on",
        "Second <para> A ends",
        "one",
        "two",
        "c1",
        "c2",
    ]


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a</p>b<p>c", "a\nb\nc"),
        ("<div>1 < 2 &unknown; x</div>", "1 < 2 &unknown; x"),
        ("<script>never ends <p>x", ""),
        ("<p>open <!-- never ends <p>x", "open"),
        ("<article><p>in<div>deep</article><p>out", "in\ndeep"),
        ("</p></div>stray", "stray"),
        ("<p>" + "<div>" * 3000 + "deep", "deep"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page, set()) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body class='has-sidebar'><p>a</p>", "a"),
        ("<body class=sidebar><main class=menu><p>a</p></main>", "a"),
        ("<p>out</p><article class='post tag-social category-legal'><p>a</p></article>", "a"),
        ("<article><div class='entry-header'><h1>t</h1></div><p>a</p></article>", "t\na"),
        ("<article><div class=header><h1>t</h1></div><p>a</p></article><div class=header>s</div>", "t\na"),
        ("<div class='content-sidebar-wrap'><p>a</p></div><ul class='search-results'><li>b</ul>", "a\nb"),
        ("<div class='overlay'><p>x</p><article><p>a</p></article></div>", "a"),
        ("<article><p>a</p></article><div class=related-posts><article>card</article></div>", "a"),
        ("<article><p>a</p><h2 id=legal>b</h2><div class='social-links'>c</div></article>", "a\nb"),
        ("<div class=site-header>x</div><div class='cookie-notice'>x</div><p>a</p><div id=ad-slot-3>x</div>", "a"),
        ("<form action=/><h1>t</h1><p>a</p></form>", "t\na"),
        ("<form><div><p>a</p></div></form>", "a"),
        ("<ul class=menu><li>n</ul><form><div><p>a</p></div></form><div class=footer>f</div>", "a"),
        ("<p>a</p><form><p>name</form>", "a"),
        ("<article><p>a</p><svg width='1'/><p>b</p></article>", "a\nb"),
        ("<p>a<svg><path d=1/></svg>b<script src='x'/></script>c<script src=/x/>d()</script>e", "abce"),
        ("<p>as <math display=block><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> is", "as x=2 is"),
        ("<title-bar>a</title-bar><p>b", "a\nb"),
    ],
)
def test_names_judge_no_whole_pages(page, text):
    assert html_text.main_text(page, set()) == text


def test_templates_drop_constant_and_linked_slots(spark):
    """Without an article, what all pages of a host say and lists of links are furniture."""
    page = (
        '<html><body><div class="top">Welcome to the site</div><div class="x"><a href=1>l {0}</a> <a href=2>m</a></div>'
        '<div class="body"><p>Story {0} begins.</p><p>And ends {0}.</p></div></body></html>'
    )
    rows = [(k, f"http://h.example/{k}", page.format(k)) for k in range(5)] + [(9, None, None), (9, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", df_text())
    got = sorted((r.page_id, r.text) for r in html_text.extract(df).collect())
    assert got == [(k, f"Story {k} begins.\nAnd ends {k}.") for k in range(5)] + [(9, ""), (9, "")]
    assert html_text.extract(df.limit(0)).count() == 0


def test_copies_keep_their_text(spark):
    """Equal pages are no evidence of a template, alone on a host or beside other pages."""
    copy = "<html><body><h1>{0}</h1><p>One {0}.</p><table><tr><td>Cell {0}</table></body></html>"
    other = '<html><body><h1 id="other">Other {0}</h1><p>Two {0}.</p></body></html>'
    rows = [(k, "http://copies.example/", copy.format("same")) for k in range(4)]
    rows += [(7, "http://row.example/", copy.format("row"))] * 3
    rows += [(k, "http://mixed.example/", copy.format("mixed")) for k in range(10, 14)]
    rows += [(k, "http://mixed.example/", other.format(k)) for k in range(20, 24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in html_text.extract(df).collect())
    said = lambda x: f"{x}\nOne {x}.\nCell {x}"
    assert got == sorted(
        [(k, said("same")) for k in range(4)]
        + [(7, said("row"))] * 3
        + [(k, said("mixed")) for k in range(10, 14)]
        + [(k, f"Other {k}\nTwo {k}.") for k in range(20, 24)]
    )


def test_templates_judge_articles(spark):
    """What all articles of a host repeat is furniture, in a neutral element or in a last paragraph."""
    page = (
        '<html><body><div class="a">Outside {0}</div><article><div class="b">By the staff</div><h1>Title {0}</h1>'
        '<p>Story {0}.</p><p>More {0}.</p><div class="c"><p>Read us daily</p></div><p>Licence: free.</p></article></body></html>'
    )
    boxed = '<html><body><article><div>Join us</div></article><div class="s"><p>Story {0}.</p></div></body></html>'
    rows = [(k, "http://h.example/", page.format(k)) for k in range(4)]
    rows += [(10 + k, "http://boxed.example/", boxed.format(k)) for k in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in html_text.extract(df).collect())
    want = [(k, f"Title {k}\nStory {k}.\nMore {k}.") for k in range(4)]
    assert got == want + [(10 + k, f"Story {k}.") for k in range(4)]


def df_text():
    from pyspark.sql import functions as F

    return F.lit("a clashing column")


def test_template_classes(spark, folder):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html_text.templates(html_text.with_host(pages), folder).collect()
    host = max({r.host for r in rows}, key=lambda h: max(r.pages for r in rows if r.host == h))
    own = {r.role: r for r in rows if r.host == host}
    outer = own["/html/body"]["class"]
    assert own["/html/body/article"]["class"] == outer and own["/html/body/article/p"]["class"] != outer
    assert own["/html/body/article/p"].parent_class == outer and own["/html/body/article/p"].valid


def test_pages(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in html_text.html_text(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
        want = "\n".join(x for x in parts if x)
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, want, len(want))
