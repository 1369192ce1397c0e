from __future__ import annotations

import re
import time
from html import unescape

import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import html_blocks as H

LONG = ("It is the case that the man was in the house and it was not for him to be there, but he said that they "
        "were the ones who had it on that day, as it is for us, and that is what it was to be for all of them.")
SHORT = "Nothing more was said."
JA = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。" * 2
RU = ("Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме "
      "Облонских. Жена узнала, что муж был в связи с бывшею в их доме француженкою, и объявила мужу, что не может жить.")
AR = ("كان يا ما كان في قديم الزمان ملك من ملوك ساسان بجزائر الهند والصين صاحب جند وأعوان وخدم وحشم وكان له ولدان "
      "أحدهما كبير والآخر صغير وكانا بطلين شجاعين وكان الكبير أفرس من الصغير وقد ملك البلاد وحكم بالعدل بين العباد")

CASES = {
    "article": (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}</p><p>x|y|z</p></article>"
                "<footer>&copy; us</footer>", f"Title {LONG} x|y|z"),
    "unclosed": ("<article><h1>A</h1><p><b>one<br><p>two</p><p>three", "A one two three"),
    "references": ("<article><p>&eacute;&#233;&#xe9;&nbsp;&lt;b&gt; &amp;amp; &am A&B</p></article>", "ééé <b> &amp; &am A&B"),
    "white space": ("<article><p>a\n\t b</p>\r\n<p> c</p></article>", "a b c"),
    "scripts": ("<article><p>a<script>if (a<b) '</p>'</script>b<style>p{}</style></p><!-- <p>no</p> --><p>c</p></article>",
                "ab c"),
    "left out": ("<article><p>keep</p><div class='ad-box'>buy</div><aside>side</aside><form>f <input></form>"
                 "<div id=comments><article class=comment><p>mine</p></article></div><p>end</p></article>", "keep end"),
    "header": ("<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>Text</p></main>", "Title Text"),
    "form page": ("<form action=x><div class=menu>m</div><article><p>Hello <a href=x>w</a></p></article></form>", "Hello w"),
    "notice": ("<div class=cookie-notice>We use cookies</div><article><p>Body</p></article>", "Body"),
    "rules": (f"<body><div>Home Login Top</div><h2>About it</h2><div><p>{LONG}</p><p>{SHORT}</p><p>{LONG}</p></div>"
              f"<div><a href=1>one link</a> <a href=2>and another link here</a></div><p>© 2020</p></body>",
              f"About it {LONG} {SHORT} {LONG}"),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></article>", "a b c d e"),
    "links": ("<article><p>A <a href=x>linked</a> word</p><ul><li><a href=1>menu</a></li></ul><p>B</p></article>",
              "A linked word B"),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    "empty": ("", ""), "no text": ("<html><body></body></html>", ""), "menus only": ("<nav>a b</nav>", ""),
    "cut": ("<article><p>abc<p>def <a href=\"x", "abc def"),
    "bare": ("just words", ""),
    # a part of a class name is a prior that the dense text overrules
    "layout": (f"<div class='layout no-sidebar'><nav>menu</nav><article><h1>T</h1><p>{LONG}</p></article></div>", f"T {LONG}"),
    "main": (f"<div id=main class=with-sidebar><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div>",
             f"{LONG} {LONG}"),
    "share": (f"<article><div class='article-body social-share-enabled'><p>{LONG}</p><p>x|y</p></div>"
              "<div class='share-box'>share it</div></article>", f"{LONG} x|y"),
    "has comments": (f"<article class='post has-comments'><p>{LONG}</p><div class=post-comments><p>{LONG}</p><p>{LONG}</p>"
                     "</div></article>", LONG),
    "teasers": (f"<article><p>{LONG}</p><p>{LONG}</p></article><div class=related-box><article><p>{LONG}</p></article></div>",
                f"{LONG} {LONG}"),
    "page form": (f"<form id=aspnet><div class=menu>m</div><p>{LONG}</p><p>{SHORT}</p><p>{LONG}</p></form>",
                  f"{LONG} {SHORT} {LONG}"),
    "small form": (f"<div><p>{LONG}</p></div><form><p>{SHORT} your name</p></form>", LONG),
    "long advert, short article": (f"<div class=ad>{LONG}</div><article><p>{SHORT}</p></article>", SHORT),
    "outside": (f"<div><p>{LONG}</p><p>{SHORT}</p></div><nav><a href=1>x</a></nav><article><p>In</p></article>"
                "<p>more on this</p>", f"{LONG} {SHORT} In"),
    "inline": ("<article><p>Press <label>this key</label> for <math><mi>x</mi><mo>=</mo><mn>2</mn>"
               "<annotation>x=2</annotation></math>.</p></article>", "Press this key for x=2."),
    "japanese": (f"<div><a href=1>{JA[:9]}</a></div><div><p>{JA}</p><p>はい。</p><p>{JA}</p></div><div><a href=2>次</a></div>",
                 f"{JA} はい。 {JA}"),
    "russian": (f"<div><a href=1>Домой</a></div><p>{RU}</p><p>Да.</p><p>{RU}</p>", f"{RU} Да. {RU}"),
    "arabic": (f"<ul><li><a href=1>بيت</a></ul><p>{AR}</p>", AR),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, text = CASES[name]
    assert H.main_text(page) == text


def test_second_pass():
    G, N, S, B = H.GOOD, H.NEAR, H.SHORT, H.BAD
    assert H.second_pass([B, S, G, S, S, B], B) == [False, True, True, True, False, False]
    assert H.second_pass([B, N, B], B) == [False, False, False]
    assert H.second_pass([G, N, B], B) == [True, True, False]
    assert H.second_pass([S, S], G) == [True, True]
    assert H.second_pass([S, S], B) == [False, False]
    assert H.second_pass([], B) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<article>", "</article>", "<a href='x", "\">", "<div class=ad>",
                                 "</div>", "<!--", "-->", "<script>", "</script>", "&amp;", "a", " ", "<", ">", "</"]),
                max_size=25))
def test_any_page_gives_clean_text(parts):
    text = H.main_text("".join(parts))
    assert text == " ".join(text.split())


def test_rows(spark):
    rows = [(k, f"http://x/{k}", page) for k, (page, _) in enumerate(CASES.values())]
    rows += [(100, None, None), (None, "u", CASES["cut"][0]), (0, "http://x/0", rows[0][2]),
             (101, "long", "<article>" + f"<p>{LONG}</p>" * 2000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    out = H.extract(df).collect()
    assert len(out) == len(rows)
    want = [(i, u, H.main_text(h), len(H.main_text(h))) for i, u, h in rows]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert len(H.main_text(rows[-1][2])) == 2000 * (len(LONG) + 1) - 1
    assert H.extract(df.where("false")).count() == 0


def plain_second_pass(labels, edge):
    """The rule word by word: look left and right from every block."""
    def nearest(i, step, decided):
        k, d = i + step, 1
        while 0 <= k < len(labels):
            if labels[k] in decided:
                return labels[k], d, k
            k, d = k + step, d + 1
        return edge, d, None

    def near_kept(i):
        return not all(nearest(i, step, (H.GOOD, H.BAD))[0] == H.BAD for step in (-1, 1))
    out = []
    for i, label in enumerate(labels):
        if label == H.SHORT:
            sides = []
            for step in (-1, 1):
                seen, d, k = nearest(i, step, (H.GOOD, H.BAD, H.NEAR))
                sides.append((d, not (seen == H.GOOD or seen == H.NEAR and near_kept(k))))
            out.append(not min(sides)[1])
        else:
            out.append(label == H.GOOD or label == H.NEAR and near_kept(i))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([H.GOOD, H.NEAR, H.SHORT, H.BAD]), max_size=12), st.sampled_from([H.GOOD, H.BAD]))
def test_second_pass_equals_brute_force(labels, edge):
    assert H.second_pass(labels, edge) == plain_second_pass(labels, edge)


def test_nested_and_unmatched_tags_take_linear_time():
    n = 50_000
    for page in ("<div>" * n + "</span>" * n + "<p>end", "<div class=x-ad>" * n + "x" + "</div>" * n,
                 "<p><b>" * n + "x", "<li><i>" * n + "</ul>" * n):
        began = time.process_time()
        H.main_text(page)
        assert time.process_time() - began < 3


def test_given_pages_equal_their_documents(spark):
    """The given pages are documents in a template, with the title on top."""
    base = "/root/testdata/sf0.01"
    texts = {" ".join((r["text"] or "").split()) for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{base}/pages.parquet").collect()}
    rows = H.extract(spark.read.parquet(f"{base}/pages.parquet")).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    for r in rows:
        title = " ".join(unescape(re.search("<h1>(.*?)</h1>", pages[r["page_id"]], re.S)[1]).split())
        assert r["text"].startswith(title + " ") and r["text"][len(title) + 1:] in texts


def test_given_articles_without_their_marks():
    """Without the article element the blocks alone decide: most of the text is found, and no advert."""
    import duckdb
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' WHERE html IS NOT NULL").fetchall()
    kept = total = 0
    for (page,) in rows:
        marked, bare = H.main_text(page), H.main_text(page.replace("<article>", "<div>").replace("</article>", "</div>"))
        total += len(marked)
        kept += len(bare)
        advert = re.search('<div class="ad">(.*?)</div>', page, re.S)
        if advert and " ".join(unescape(advert[1]).split()) not in marked:
            assert " ".join(unescape(advert[1]).split()) not in bare
    assert kept > 0.7 * total
