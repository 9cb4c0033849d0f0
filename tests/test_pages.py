"""Html extraction, pagination and the walk on hand-written pages."""

import datetime as dt

from docmonitor import RunParams
from docmonitor.functions.html import _page_hits
from docmonitor.operators import extract as X, navigate as N
from docmonitor.plans.walk import walk

SITE = "https://a.fr/"


def hits(html):
    return [(r[0], *r[1:]) for r in _page_hits(html, SITE)]


def pages_table(spark, **pages):
    return spark.createDataFrame([(SITE + n, h) for n, h in pages.items()], "url string, html string")


def test_only_the_first_menu_counts(spark):
    html = (
        "<div id=contenu><div class='a rubrique_avec_sous-rubriques'><ul class=fr-collapse>"
        "<li><a class=lien-sous-rubrique href=1> Ain (01)</a><li><b class=lien-sous-rubrique>x<a href=2>y</a></b>"
        "</ul><a class=lien-sous-rubrique href=no>outside the collapse</a></div>"
        "<div class=rubrique_avec_sous-rubriques><p class=fr-collapse><a class=lien-sous-rubrique href=3>z</a></div></div>"
    )
    rows = X.department_links(pages_table(spark, m=html)).orderBy("pos").collect()
    assert [(r.department, r.href, r.abs_url) for r in rows] == [
        (" Ain (01)", "1", SITE + "1"), ("x", "2", SITE + "2")]


def test_sections(spark):
    html = (
        "<div id=contenu><div class=liste-rubriques><div><i class=rubrique_avec_sous-rubriques>"
        "<p class=fr-tile__title><b>no</b> 2024 </p></i><p class=fr-collapse><a href=s1> S1 </a><a href=s2>S2</a></div>"
        "<div class=item-liste-rubriques-seule><a class=fr-tile__link href=y>2023</a><a href=z>z</a></div>"
        "<div><a href=w>2022</a></div><p><a href=v>2021</a></p></div></div>"
    )
    rows = X.year_sections(pages_table(spark, m=html)).orderBy("block_pos", "pos").collect()
    assert [(r.section_title, r.subdiv, r.href) for r in rows] == [
        ("2024", "S1", "s1"), ("2024", "S2", "s2"), ("2023", "", "y")]


def test_titles_take_direct_text_only(spark):
    df = pages_table(
        spark, a="<h1 class='x titre-article'><b>no</b>Own &amp; one<!-- c --> two</h1>",
        b="<h1 class=titre-article><b>none</b></h1><h1 class=titre-article>second</h1>",
        c="<h1 class=titre-articles>other class</h1>", d="<h1 class=titre-article>\n <b>t</b></h1>",
    )
    got = {r.url[-1]: r.project for r in X.page_title(df).collect()}
    assert got == {"a": "Own & one", "b": "second", "d": "\n "}


def test_downloads_with_base_and_broken_markup(spark):
    html = (
        "<head><base href='/base/'></head><script>var a='<a class=\"fr-download__link\" href=no>';</script>"
        "<!-- <div id=contenu> --><div id=contenu><div class=fr-download><p><a title=it's class='fr-download__link b' href=d.pdf>"
        "\n Avis a < b\n<span>PDF</span></a><p>unclosed</div><a class=fr-download__link href=out>x</a>"
        "<div class=fr-download><a class=fr-download__link>no href</a></div>"
    )
    rows = X.download_links(pages_table(spark, m=html)).collect()
    assert [(r.title, r.href, r.abs_url) for r in rows] == [("Avis a < b", "d.pdf", SITE + "base/d.pdf")]


def test_next_needs_an_href_and_breadcrumb_eight_links(spark):
    crumbs = "".join(f"<li><a>{i}</a></li>" for i in range(7))
    html = (
        "<nav id=breadcrumb><ol class=fr-breadcrumb__list>{}</ol></nav><div id=contenu><ul class=fr-pagination__list>"
        "<li><a class=fr-pagination__link--next{}>n</a></ul></div>"
    )
    df = pages_table(spark, a=html.format(crumbs + "<li><a> 2024</a></li>", " href=?p=2"), b=html.format(crumbs, ""))
    assert [(r.url, r.abs_url) for r in X.next_page(df).collect()] == [(SITE + "a", SITE + "a?p=2")]
    assert [(r.url, r.year) for r in X.breadcrumb_year(df).collect()] == [(SITE + "a", " 2024")]


def test_unclosed_and_hostile_markup_ends():
    assert hits("") == [] and hits("<") == [] and hits("<a" * 2000) == []
    assert hits("<div " + "a=b " * 5000) == [] and hits("<p><!-- " * 3000) == []
    assert hits("<script>" + "<h1 class=titre-article>x</h1>") == []


def test_paginate_chains_and_cycles(spark):
    n = 37  # one long chain, one that joins it in the middle, one that is a cycle
    links = [(f"c{i}", f"c{i + 1}") for i in range(n)] + [("j0", "c30"), ("o0", "o1"), ("o1", "o2"), ("o2", "o0"), ("s", "s")]
    next_links = spark.createDataFrame(links, "url string, abs_url string")
    first = spark.createDataFrame([("c0", 0), ("j0", 1), ("o0", 2), ("s", 3)], "url string, seq int")
    rows = {r.url: (r.start_url, r.page) for r in N.paginate(first, next_links).collect()}
    want = {f"c{i}": ("c0", i + 1) for i in range(30)}
    want |= {f"c{i}": ("j0", i - 28) for i in range(30, n + 1)}
    want |= {"j0": ("j0", 1), "o0": ("o0", 1), "o1": ("o0", 2), "o2": ("o0", 3), "s": ("s", 1)}
    assert rows == want


def test_walk_requests_each_page_once(spark):
    crumbs = "".join("<li><a>x</a></li>" for _ in range(7)) + "<li><a>2024</a></li>"
    listing = "<nav id=breadcrumb><ol class=fr-breadcrumb__list>" + crumbs + "</ol></nav><div id=contenu><p class=liste-articles>{}</p><p class=fr-pagination__list>{}</p></div>"
    nxt = "<a class=fr-pagination__link--next href={}>n</a>"
    card = "<a class=fr-card__link href={}>c</a>"
    df = pages_table(
        spark,
        start="<div id=contenu><div class=rubrique_avec_sous-rubriques><div class=fr-collapse><a class=lien-sous-rubrique href=d1>Ain (01)</a>"
              "<a class=lien-sous-rubrique href=d1#again>Twice (02)</a></div></div></div>",
        d1="<div id=contenu><div class=liste-rubriques><div class=item-liste-rubriques-seule><a class=fr-tile__link href=l1>Année 2024</a></div>"
           "<div class=item-liste-rubriques-seule><a class=fr-tile__link href=l9>2019</a></div></div></div>",
        l1=listing.format(card.format("p1#x") + card.format("d1"), nxt.format("l2")),
        l2=listing.format(card.format("p1") + card.format("p2") + card.format("gone"), nxt.format("l1")),
        l9=listing.format(card.format("p9"), ""),
        p1="<h1 class=titre-article>Un</h1><div id=contenu><div class=fr-download><a class=fr-download__link href=f1.pdf>F1</a>"
           "<a class=fr-download__link href=f1.pdf>again</a></div></div>",
        p2="<div id=contenu><div class=fr-download><a class=fr-download__link href=f2.pdf>F2</a></div></div>",
    )
    params = RunParams(from_year=2024, to_year=2024, run_ts=dt.datetime(2024, 1, 1))
    rows = walk(df, SITE + "start", params).orderBy("crawl_path").collect()
    assert [(r.department, r.year, r.page, r.project, r.source_page_url, r.title, r.source_file_url) for r in rows] == [
        ("Ain (01)", "2024", 1, "Un", SITE + "p1#x", "F1", SITE + "f1.pdf"),
        ("Ain (01)", "2024", 2, None, SITE + "p2", "F2", SITE + "f2.pdf"),
    ]
    links = X.page_hits(df, ("project", "next"))
    assert [r.url for r in N.frontier(links, df).orderBy("url").collect()] == [SITE + "gone", SITE + "p9"]


def test_class_with_character_references(spark):
    html = "<div id=contenu><div class='fr-download'><a class='fr-download&#95;_link' href=a.pdf>A</a></div></div>"
    rows = X.download_links(pages_table(spark, m=html)).collect()
    assert [(r.title, r.href) for r in rows] == [("A", "a.pdf")]


def test_reference_behind_a_quoted_bracket(spark):
    html = ("<div id=contenu><div class='fr-download'>"
            "<a title=\"x > y\" class=\"fr-download&#95;_link\" href=a.pdf>A</a></div></div>")
    pages = pages_table(spark, m=html)
    assert [(r.title, r.href) for r in X.download_links(pages).collect()] == [("A", "a.pdf")]
    assert [r.kind for r in X.page_hits(pages).collect()] == ["download"]
