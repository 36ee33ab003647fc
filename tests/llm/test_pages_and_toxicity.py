"""Main text, URL rules and toxic segments."""

import random
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from gridloom.llm import html_text, toxicity, url_rules  # noqa: E402


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>open<p>second", "open\nsecond"),
    ("<script>var a='<p>x</p>'", ""), ("<!-- <p>no</p> --><p>yes", "yes"),
    ("<body><div class=sidebar>s, s</div><div id=content><p>Hello, world &amp; you<p>second<ul><li>a<li>b</ul></div><footer>f</footer>", "Hello, world & you\nsecond\na\nb"),
    ("<nav><a href=/>home</a></nav><article><h1>T &#233;</h1><p>one<br>line,\n two</p><div class='ad box'>buy, now</div>"
     "<section id=comments><p>nice, very, nice, post</p></section><p>three</p></article><aside>more</aside>", "T é\none line, two\nthree"),
    ("<article><section><p>a</p></section><section><p>b, c</p></section></article>", "a\nb, c"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("</p></div>x", "x"), ("<p>" + "<b>" * 3000 + "deep", "deep"),
    ("<form><p>in</p></form><p hidden>h</p><p style='display: none'>n</p><p>out", "out"), ("<p>a&nbsp;b&#x200b;", "a b\u200b"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


LONG = "A paragraph, with commas, and with so many words that it is prose by any measure that one could think of."


@pytest.mark.parametrize("html, text", [
    (f"<div class='site no-sidebar'><p>{LONG}</div>", LONG), (f"<div class='post-content has-comments'><p>{LONG}</div>", LONG),
    (f"<div class='site sidebar'><p>{LONG}</div>", LONG), ("<div id=sidebar><article><p>x</article></div>", "x"),
    ("<article><p>one<p class='ad-free'>two<div class='page-header'><h2>three</h2></div></article>", "one\ntwo\nthree"),
    (f"<div id=content><p>{LONG}</div><div id=comments><p>{LONG}</div>", LONG),
    (f"<div class='related-posts'><a href=x>more</a></div><div><p>{LONG}</div>", LONG),
    (f"<h1>Head</h1><div id=content><p>{LONG}</div><p>short</p><ul><li>a<li>b</ul>in <b>the</b> parent<div><a href=x>link</a></div>",
     f"Head\n{LONG}\nshort\na\nb\nin the parent"),
])
def test_names_and_neighbours_lose_no_main_text(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize("html, text", [
    (f"<body><form id=aspnetForm><input name=state><div id=content><p>{LONG}<select><option>x</select></div></form>", LONG),
    (f"<article><p>{LONG}<form><p>{LONG}<textarea>t</textarea></form></article>", LONG),
    ("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds", "If x=1 holds"),
    ("<p>Press <button>OK</button> to go on<p><button>Share</button>", "Press OK to go on"),
    ("<p>one <svg><text>no</text></svg>line<script>x</script>s", "one lines"),
    (f"<div><div><p>{LONG}<p>{LONG}</div></div><div><div><p>{LONG}</div><ul><li><a href=x>link</a></ul></div>", "\n".join([LONG] * 3)),
    (f"<h1>Head</h1><div><div><p>{LONG}</div><div><a href=x>link</a></div></div>", f"Head\n{LONG}"),
    (f"<article><p class=byline>By X<p>{LONG}</article>", f"By X\n{LONG}"),
    ("<p>text<!-- <p>no", "text"), ("<p>a<!-->b<!--->c<!-- d --!>e", "abce"),
])
def test_common_shapes_lose_no_main_text(html, text):
    assert html_text.main_text(html) == text


def test_random_trees_are_scored_by_the_definitions():
    rng = random.Random(11)

    def tree(depth):
        tag = rng.choice(["div", "div", "section", "ul"] if depth else ["p", "p", "h2", "div"])
        if tag == "ul":
            return tag, [("li", words()) for _ in range(rng.randint(1, 3))]
        if tag in ("p", "h2"):
            return tag, words()
        return tag, [rng.choice([words()[0], tree(depth - 1), tree(depth - 1)]) if depth else words()[0] for _ in range(rng.randint(1, 4))]

    def words():
        text = " ".join(rng.choice(["word", "more,", "x"]) for _ in range(rng.choice([1, 3, 30])))
        return [text] + ([(rng.choice("ab"), [rng.choice([text, "y"])]), " end"] if rng.random() < 0.4 else [])

    lost = 0
    for _ in range(400):
        root = ("html", [tree(rng.randint(1, 4)) for _ in range(rng.randint(1, 3))])
        html = "".join(map(brute.markup, root[1]))
        assert html_text.main_text(html) == brute.scored_text(root), html
        lost += brute.scored_text(root) != brute.scored_text(("html", [("p", [html])]))
    assert lost > 300


@pytest.mark.parametrize("many", ["<div>", "<div class=sidebar>", "<nav>", "<nav><li>", "<p><b>", "<ul><li>", "<b><button>", "<!--", "</b><p>x"])
def test_time_grows_with_the_length_of_a_page_only(many):
    begin = time.process_time()
    html_text.main_text(many * 100_000 + LONG)
    assert time.process_time() - begin < 30


def test_pages_keep_their_rows(spark):
    rows = [(1, None, None, "x", 3), (1, "u", "<p>a &lt; b</p>", "x", 3), (None, "u", "", "x", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, "u", "a < b", 5), (None, "u", "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).collect() == []


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


def test_rules_are_judged_exactly(spark):
    rng = random.Random(1)
    rules = [url_rules.Rule(rng.choice(["allow", "block"]), h, p) for h in ("a", "b.a", "c", "x.c", "d.b.a") for p in ("/", "/p", "/p/q", "")]
    urls = [None, "", "no scheme", "://", "http://", "http://A", "HTTP://B.A?x#y", "x://a#/p", "http://a/p?/q", "http://é.a/p", "a://b://c/p\n/q"]
    urls += ["http://" + ".".join(rng.choice("abcdx") for _ in range(rng.randint(1, 4))) + rng.choice(["", "/", "/p", "/p/q/r", "/q", "?p"]) for _ in range(800)]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_rules.judge(pages, rules).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        best = max((r for r in rules if fits(r, host, path)), key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)
        assert (got[i].host, got[i].path) == (host, path), u
        assert got[i].rule == (best.host + best.path if best else None), u
        assert got[i].verdict == (best.verdict if best else "allow")
    assert url_rules.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_rules.judge(pages, []).collect()} == {"allow"}


def test_cascade_has_no_wrong_answer_over_its_universe():
    listed, others = [b"yes%d" % i for i in range(50)], [b"no%d" % i for i in range(20_000)]
    level = url_rules.first_level(listed, 2000)
    cascade = url_rules.build(listed, level, [k for k, taken in zip(others, level.has(others)) if taken])
    assert len(cascade.levels) > 1
    assert cascade.has(listed).all() and not cascade.has(others).any() and not len(cascade.has([]))


def test_many_rules_repeated_rules_and_equal_lengths(spark):
    """Hundreds of rules of two verdicts whose hosts differ by little; the cascades have several levels."""
    rules = [url_rules.Rule("block" if i % 3 else "allow", f"h{i}.net", "/" + "p" * (i % 4)) for i in range(400)]
    rules += [url_rules.Rule("allow", "h1.net", "/p"), url_rules.Rule("allow", "net", "/ppppppp"), url_rules.Rule("block", "h7.net", "/ppp")]
    urls = [f"http://{'www.' * (i % 2)}h{i}.net/{'p' * (i % 9)}" for i in range(3000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    last = {(r.host, r.path): r for r in rules}.values()
    for row in url_rules.judge(pages, rules, otherwise="unknown").collect():
        best = max((r for r in last if fits(r, row.host, row.path)), key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)
        assert (row.rule, row.verdict) == ((best.host + best.path, best.verdict) if best else (None, "unknown")), row


def maximal(scores):
    """Ruzzo and Tompa's definition: split off the best segment (the shortest of equals, then the first), again on both sides."""
    best = max(((sum(scores[i:j]), i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, _, i, j = best
    return maximal(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in maximal(scores[j:])]


def test_segments_are_the_maximal_ones():
    rng = random.Random(2)
    for _ in range(400):
        scores = [float(rng.choice([-3, -2, -1, 1, 2, 3])) + rng.random() / 64 for _ in range(rng.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(scores))] == maximal(scores)


def test_toxic_rows_are_found_held_out(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        text, toxic = [rng.choice(words) for _ in range(rng.randint(5, 80))], int(rng.random() < 0.2)
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["vile", "nasty", "awful"]))
        rows.append((i, " ".join(text), 1))
        labels += [(i, toxic, 0)] if i % 2 == 0 else []
    rows += [(5000, None, 1), (5001, "", 1), (None, "vile nasty", 1)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.learn(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    text = {i: t for i, t, _ in rows}
    wrong = sum(r.predicted != int(any(w in (text[r.doc_id] or "") for w in ("vile", "nasty", "awful"))) for r in got)
    assert wrong <= len(got) // 50
    kept = toxicity.score(docs, model, keep=True)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in got)


def test_rare_telling_words_are_found_held_out(spark):
    """Thirty telling words, each in few toxic rows: none is certain alone."""
    rng = random.Random(5)
    words, telling = ["w%d" % i for i in range(300)], ["bad%d" % i for i in range(30)]
    rows, labels = [], []
    for i in range(1600):
        text, toxic = [rng.choice(words) for _ in range(rng.randint(20, 60))], int(rng.random() < 0.15)
        for _ in range(2 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(telling))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    toxic = dict(labels)
    held = [r for r in toxicity.score(docs, model).collect() if r.held_out]
    hits = sum(r.predicted and toxic[r.doc_id] for r in held)
    assert hits >= 0.85 * sum(toxic[r.doc_id] for r in held)
    assert sum(r.predicted for r in held) - hits <= 0.03 * len(held)


def test_a_model_of_too_many_words_is_refused(spark):
    docs = spark.createDataFrame([(i, "vile words here" if i % 2 else "kind talk there") for i in range(40)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "concat(text, ' ', doc_id) AS text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert len(toxicity.learn(docs, labels).values) > 2
    with pytest.raises(ValueError, match="most_words"):
        toxicity.learn(docs, labels, most_words=2)


def test_learning_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, none)
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5, 0.5]
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), none)).collect() == []
