"""Quality rules, language identification and page text."""

import zlib
from collections import Counter

import pytest

from tests.conftest import SF001
from tests.harness import compare, duck
from tests.llm.test_duplicates import WORD


def test_quality_equals_sql(spark, edge_docs, tmp_path):
    from shopcube.llm import quality_rules
    from shopcube.llm.registry import ORACLES, QUERIES
    name = "op9_quality_rules"
    assert compare(QUERIES[name](spark, SF001), duck(SF001), ORACLES[name])["exact"]
    docs = edge_docs.dropDuplicates(["doc_id"])
    docs.select("doc_id", "text", "lang").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(quality_rules.quality(docs), con, quality_rules.oracle())["exact"]


def test_quality_measures_by_hand(edge_docs, no_docs):
    from shopcube.llm.quality_rules import keep_good, quality
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality(edge_docs).collect())
    want = Counter()
    for r in edge_docs.collect():
        t = r.text or ""
        w = WORD.findall(t)
        wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        n = Counter(wins)
        covered = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want[r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
             len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)] += 1
    assert got == want
    assert quality(no_docs).count() == 0
    kept = keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    good = {r.doc_id for r in quality(edge_docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good


def test_quality_of_other_languages_and_long_texts(spark):
    """Stop words judge the languages of the list only; no text is too long."""
    import random

    from shopcube.llm.quality_rules import RULES, quality
    assert all(r.high is None or r.of != "one" for r in RULES)
    r = random.Random(1)
    words = ["ромашка", "поле", "весна", "książka", "zażółć", "góra", "rzeka", "дерево", "słońce", "небо"]
    text = " ".join(r.choice(words) + str(r.randrange(90)) for _ in range(200))
    rows = [(1, text, "ru"), (2, text, None), (3, text, "en"), (4, text + " the of and a to in" * 3, "EN"), (5, text, "")]
    got = {x.doc_id: (x.base_failed, x.kept) for x in quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {1: (False, True), 2: (False, True), 3: (False, False), 4: (False, True), 5: (False, True)}
    bare = quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert bare[0].kept


def test_quality_plan_is_native(spark):
    from shopcube.llm.quality_rules import keep_good, quality
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for df in (quality(docs), keep_good(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Exchange"))


def test_language_accuracy_on_held_out_rows(spark):
    from shopcube.llm.registry import QUERIES
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op5_language_id"](spark, SF001).collect()
    assert len(got) == len(docs)
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        if r.held_out and docs[r.doc_id].lang:
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert sum(right) / len(right) > 0.95


def brute_language(rows):
    """The same rules in plain Python: sets of kept trigrams without a filter."""
    from collections import Counter, defaultdict

    import regex

    def grams(text):
        out = []
        for run in regex.findall(r"\p{L}+", text or ""):
            run = "".join(c.lower() if len(c.lower()) == 1 else c for c in run)
            padded = "\0" + run + "\0"
            out += [padded[i:i + 3] for i in range(len(run))]
        return out

    counts = defaultdict(Counter)
    for k, text, lang in rows:
        if lang is not None and text is not None and (k is None or zlib.crc32(str(k).encode()) % 3 != 1):
            counts[lang].update(grams(text))
    share = {g: {x: c[g] / sum(c.values()) for x, c in counts.items() if c[g]} for g in set().union(*counts.values())}
    kept = {x: {g for g, p in share.items() if p.get(x, 0) >= 5e-5 and p[x] >= .25 * max(q for q in p.values() if q >= 5e-5)} for x in counts}
    out = {}
    for k, text, _ in rows:
        g = grams(text)
        votes = {x: sum(y in kept[x] for y in g) / max(len(g), 1) for x in sorted(kept)}
        best = max(votes.values(), default=0)
        near = .001                                        # the filter's false positives
        out[k] = (g and {x for x, v in votes.items() if v >= best - near} or {"und"}, best if g else 0.0, near)
    return out


def test_language_equals_brute_force(spark):
    """Counting, kept n-grams and votes; the filter's false positives move a score by very little."""
    from shopcube.llm.language_id import identify
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("length(text) < 20000")
    odd = spark.createDataFrame([(10 ** 6, "été İstanbul ß", "fr"), (10 ** 6 + 1, None, "fr"), (10 ** 6 + 2, "123 !", "de"), (10 ** 6 + 3, "x", None)],
                                "doc_id long, text string, lang string")
    docs = docs.select("doc_id", "text", "lang").unionByName(odd)
    want = brute_language([tuple(r) for r in docs.collect()])
    for r in identify(docs).collect():
        langs, score, near = want[r.doc_id]
        assert r.lang_pred in langs and abs(r.score - score) <= near, (r, langs, score)


def test_language_on_edges(edge_docs, no_docs):
    from shopcube.llm.language_id import identify
    for r in identify(edge_docs).collect():
        text = {x.doc_id: x.text for x in edge_docs.collect()}[r.doc_id]
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or r.score == 0
    assert identify(no_docs).count() == 0
    nothing = identify(edge_docs.withColumn("lang", __import__("pyspark").sql.functions.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_filter_finds_all_languages_of_a_gram():
    import numpy as np
    from shopcube.llm.language_id import Filters, slots_of
    rng = np.random.default_rng(1)
    sets = [set(rng.integers(0, 10 ** 6, 3000).tolist()) for _ in range(70)]      # more than one mask word
    f = Filters.build([f"l{i:02}" for i in range(70)], [(i, g) for i, s in enumerate(sets) for g in s])
    grams = np.array(sorted(sets[3] | sets[66]), np.int64)
    hits = [f.masks[k][slots_of(grams)[0]] & f.masks[k][slots_of(grams)[1]] & f.masks[k][slots_of(grams)[2]] for k in range(2)]
    for i in (3, 66):
        held = (hits[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        assert all(h for g, h in zip(grams.tolist(), held) if g in sets[i])
        assert (f.false_share < 0.01).all()


@pytest.mark.parametrize("html", ["<a b " * 250_000, "<div>t" * 50_000, "<b>" * 20_000 + "</x>" * 20_000 + "t",
                                  "<table>" + "<b>" * 20_000 + "</i>" * 20_000, '<a b="' * 150_000, "<p>" * 60_000, "<li>x" * 60_000,
                                  "<!--" * 200_000, "<!x " * 200_000, "<" * 500_000, "<title>" * 50_000 + "</title" * 50_000,
                                  "<script>" * 100_000 + "x"])
def test_pages_that_never_close_take_linear_time(html):
    import time

    from shopcube.llm.html_text import Page
    start = time.process_time()
    Page(html).main(None, set())
    assert time.process_time() - start < 5


def test_filter_errs_on_few_trigrams():
    """Trigrams that are alike but for a letter: false positives stay at the share that the filter reports."""
    import itertools

    import numpy as np
    from shopcube.llm.language_id import Filters, slots_of
    codes = np.array([a | b << 21 | c << 42 for a, b, c in itertools.product(range(97, 123), repeat=3)], np.int64)
    kept = codes[::7]
    f = Filters.build(["x"], [(0, g) for g in kept.tolist()])
    s = slots_of(codes)
    hit = (f.masks[0][s[0]] & f.masks[0][s[1]] & f.masks[0][s[2]]) & np.uint64(1)
    assert hit[::7].all() and int(hit.sum()) - len(kept) <= 3


def page(body, title="T"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{x}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("body,want", [
    ("<nav><a>m</a></nav><article><h1>A &amp; B</h1><p>x\n\t y&nbsp;z<p>second<br>line</article><footer>f</footer>",
     "A & B\n\nx y z\n\nsecond line"),
    ("<div class='cookie-notice'>we</div><main><p>one</p><aside>side</aside><form>q <input></form><p>two</p></main>", "one\n\ntwo"),
    ("<article><p>a<script>var x='</p>'</script>b</p><div id=comments><p>c</p></div></article>", "ab"),
    ("<article><p>a &lt;b&gt; &#233;&#x4e2d; &copy</p><!-- <p>no</p> --></article>", "a <b> é中 ©"),
    ("<nav><ul><li>never closed<article><p><b>bold<br><p>next</article>", "bold\n\nnext"),
    ("<div><p>no article here</p></div><div class='sidebar'>no</div>", "no article here"),
    ("<article hidden><p>no</p></article>", ""),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\n\ntwo\n\na b\n\nc"),
    ("<article>Let <math>x</math> be <button>B</button> real</article>", "Let x be B real"),
    ("<article><p class=teaser>Lead</p><p class='social-media'>x</p><div class='social media'>y</div></article>", "Lead\n\nx"),
    ("<main><h1>Title</h1><article><p>a</p></article></main>", "Title\n\na"),
    ("<h1>Title</h1><nav>m</nav><article><p>b</p></article>", "Title\n\nb"),
    ("<h1>Site</h1><article><h2>Own</h2><p>b</p></article>", "Own\n\nb"),
    ("<article><p>a</p><!-- x --!><p>b</p><!-- c --><p>d</p><!--></article>", "a\n\nb\n\nd"),
    ("<article><p>1 < 2 and <a href='x>y'>z</a> <b", "1 < 2 and z"),
    ("", ""),
    ("<article><p>cut in the mid", "cut in the mid"),
])
def test_page_rules(body, want):
    from shopcube.llm.html_text import Page
    assert Page(page(body)).main(None, set()) == want


def test_template_slot_without_an_article_element(spark):
    """A host whose article stands in a plain div: the slot follows from the classes of its template."""
    from shopcube.llm.html_text import main_text
    from shopcube.llm.ship import ship_package
    ship_package(spark)
    rows = []
    for i in range(12):
        text = " ".join(f"w{i}x{k}" for k in range(60))
        body = (f"<div id=top><span>Site</span></div><div id=mid><div><p>{text}</p><p>Never miss it again</p>"
                f"<p>end{i}</p></div></div><div id=low><p>All of it {i}</p></div>")
        rows.append((i, f"https://u@Host.example:80/p{i}", page(body), i))
    rows += [(100, None, page("<p>lone</p>"), 0), (101, "https://other.example/", None, 0), (102, "bad url", "", 0),
             (100, None, page("<p>lone</p>"), 0)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, host long")
    got = main_text(table).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id < 12:
            want = " ".join(f"w{r.page_id}x{k}" for k in range(60)) + f"\n\nend{r.page_id}"
            assert r.text == want
        assert r.n_chars == len(r.text)
    assert {r.page_id: r.text for r in got if r.page_id >= 100} == {100: "lone", 101: "", 102: ""}
    assert main_text(table.where("false")).count() == 0


def test_pages_of_the_table(spark):
    import html
    import re
    from shopcube.llm.registry import QUERIES
    got = {r.page_id: r for r in QUERIES["op4_html_text"](spark, SF001).collect()}
    for x in spark.read.parquet(f"{SF001}/pages.parquet").collect():
        m = re.search(r"<article>(.*?)</article>", x.html, re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", m[1])]
        assert got[x.page_id].text == "\n\n".join(b for b in blocks if b)


def texts_of(spark, bodies, host="one.example"):
    from shopcube.llm.html_text import main_text
    from shopcube.llm.ship import ship_package
    ship_package(spark)
    rows = [(i, f"https://{host}/p{i}", page(b)) for i, b in enumerate(bodies)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


@pytest.mark.parametrize("start,end", [
    ("<article>", "</article>"),
    ("<main><article id=post>", "</article></main>"),
    ("<div id=top><span>Site</span></div><div id=mid>", "</div><div id=low><p>All rights</p></div>"),
    ("<div id=top><span>Site</span></div><div id=mid><em>Filed under news</em>", "</div>"),
])
def test_headline_and_lead_beside_the_body(spark, start, end):
    """What stands beside the innermost element that holds nearly all text is article text, too."""
    def body(i, inner):
        return f"{start}<h1>title {i}</h1><p class=lead>lead of {i}</p>{inner}{end}"
    long = [" ".join(f"w{i}x{k}" for k in range(200)) for i in range(12)]
    want = [f"title {i}\n\nlead of {i}\n\n{t}" for i, t in enumerate(long)]
    assert texts_of(spark, [body(i, f"<div class=body><p>{t}</p></div>") for i, t in enumerate(long)]) == want
    assert texts_of(spark, [body(i, f"<section>{t}</section>") for i, t in enumerate(long)]) == want


@pytest.mark.parametrize("menu", ["<nav>{}</nav>", "<div id=top><p>{}</p></div>"])
@pytest.mark.parametrize("start,end", [("<article>", "</article>"), ("<div id=mid>", "</div>")])
def test_copies_under_changing_menus_keep_their_text(spark, menu, start, end):
    """Ten pages of one article whose menus differ: the article is no template."""
    text = " ".join(f"w{k}" for k in range(200))
    got = texts_of(spark, [menu.format(f"menu {i} of {i}") + f"{start}<h1>title</h1><p>{text}</p>{end}" for i in range(10)])
    assert got == [f"title\n\n{text}"] * 10


def test_template_text_in_the_slot_beside_copies(spark):
    """Text on all pages goes, also where some pages are copies of each other."""
    long = [" ".join(f"w{i // 3}x{k}" for k in range(80)) for i in range(12)]
    got = texts_of(spark, [f"<article><p>{t}</p><p>Never miss it again</p></article><p>{i}</p>" for i, t in enumerate(long)])
    assert got == long


@pytest.mark.parametrize("body,want", [
    ('<article><p>a <a href="/hidden/valley">b</a> <a href="?id=search">c</a> <i title="hidden gems">d</i> <b data-x="hidden">e</b>'
     "</p></article>", "a b c d e"),
    ('<article><h2 id="related-work">one</h2><section id="search-methods"><p>two</p></section><p id=notice>three</p></article>',
     "one\n\ntwo\n\nthree"),
    ('<article class="post has-comments"><div class="content with-sidebar"><p>one</p></div></article>', "one"),
    ('<div id="search"><h1>one</h1><p>two three four</p></div><p>five</p>', "one\n\ntwo three four\n\nfive"),
    ('<div class="entry-header"><h1>one</h1></div><p>two</p>', "one\n\ntwo"),
    ('<article><p>one</p><div id=related-posts>no</div><section id=comments>no</section><p hidden>no</p><p HIDDEN="">no</p>'
     '<p class="ad-box">no</p><p aria-hidden="true">no</p><p style="color:red; display: none">no</p></article>', "one"),
    ('<div class="main-menu">no</div><div id="site-footer">no</div><div role=search>no</div><p>one</p>'
     '<div class="x sidebar-left">no no</div><div id=comments><h1>no</h1><p>no no no no no</p></div>', "one"),
])
def test_names_that_leave_out(body, want):
    """Names of menus and adverts count as whole names of the attribute itself, and nothing else."""
    from shopcube.llm.html_text import Page
    assert Page(page(body)).main(None, set()) == want
