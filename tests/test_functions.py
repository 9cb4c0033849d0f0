"""Golden cases of the scalar functions."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from docmonitor.functions import dates, departments as G, text, urls


def check(evaluate, fn, cases):
    assert dict(zip(cases, evaluate(fn, list(cases)))) == cases


def test_http_date(evaluate):
    cases = {
        "Mon, 05 Feb 2024 10:11:12 GMT": "2024-02-05T10:11:12.000000Z",
        "Mon, 5 Feb 2024 10:11:12 GMT": "2024-02-05T10:11:12.000000Z",
        "2024-02-05": None, "Xxx, 05 Feb 2024 10:11:12 GMT": None, "": None,
        "Mon, 05 Feb 2024 10:11:12 CET": None,
    }
    check(evaluate, lambda c: dates.publication_datetime_dcformat(dates.http_timestamp(c)), cases)
    one = ["Mon, 05 Feb 2024 10:11:12 GMT"]
    for fn, want in (
        (dates.publication_date, "2024-02-05"), (dates.publication_time, "10:11:12 UTC"),
        (dates.publication_datetime, "2024-02-05 10:11:12 UTC"),
        (dates.iso_last_modified, "2024-02-05T10:11:12"),
    ):
        assert evaluate(lambda c: fn(dates.http_timestamp(c)), one) == [want]


def test_clean_project(evaluate):
    cases = {
        "  parc solaire.,": "Parc solaire",
        "Lyon (69) : parc solaire": "Parc solaire - Lyon (69)",
        "A (01) : B (02) : C": "B (02) : C - A (01)",
        "projet d’usine X": "Projet d'usine X",
        "X. ,": "X.", "élargissement RD 12": "Élargissement RD 12",
        "Corse (2A) : port": "Corse (2A) : port", "ßa": "Ssa", "": "", "  \x1f": "", ".,": "",
    }
    check(evaluate, text.clean_project, cases)
    blank = {x: y == "" for x, y in cases.items()}
    check(evaluate, text.blank_project, blank)


def test_clean_title(evaluate):
    cases = {
        "decision_KKP_001": "Decision KKP 001", "doc. ": "Doc.", "doc.,": "Doc",
        "_annexe_": "Annexe", "ßa": "SSa", "_": "", "": "",
    }
    check(evaluate, text.clean_title, cases)
    check(evaluate, text.blank_title, {x: y == "" for x, y in cases.items()})


def test_extensions(evaluate):
    cases = {
        "a.tar.GZ": ".gz", ".pdf": "", "..pdf": "", "noext": "", "a..pdf": ".pdf", "a.": ".",
        ".a.b": ".b", "": "",
    }
    check(evaluate, text.file_ext, cases)
    check(evaluate, text.original_ext, {x: y.lstrip(".") for x, y in cases.items()})


def test_file_names(evaluate):
    cases = {
        "https://a.fr/x/a b.pdf?x=1": "a b.pdf", "https://a.fr/x/doc.pdf;v=1#f": "doc.pdf",
        "https://a.fr/x/": "", "https://a.fr/IMG/pdf/%C3%A9.pdf": "%C3%A9.pdf",
        "https://a.fr": "", "https://a.fr?x=/y": "", "a/b.pdf": "b.pdf",
        "https://a.fr/a;b/c.pdf": "c.pdf", "https://a.fr/a\nb.pdf": "ab.pdf",
    }
    check(evaluate, lambda c: urls.source_filename(F.lit(""), c), cases)
    assert evaluate(lambda c: urls.source_filename(F.lit("given"), c), ["https://a.fr/b"]) == ["given"]


def test_zip_titles(evaluate):
    check(evaluate, text.zip_title, {
        "dossier_1/sous/plan_masse.pdf": "dossier_1 - sous - plan_masse", "plan.PDF": "plan",
        "a/b.c/note.v2.docx": "a - b.c - note.v2", "a.b/c": "a.b - c",
    })


def test_zip_route(evaluate):
    check(evaluate, urls.is_zip, {"x.ZIP": True, "x.zip?d=1": False, "x.zip": True})


def test_category(evaluate):
    check(evaluate, text.category, {"Décisions au CAS PAR CAS": "Cas par cas", "Avis": None})


@pytest.mark.parametrize("base", [
    "https://a.fr/x/y.html", "http://a.fr", "https://a.fr/x/?q=1#top", "https://a.fr/x/y;p?z",
])
def test_resolve_url_is_urljoin(evaluate, base):
    hrefs = [
        "", "b.pdf", "/b.pdf", "../b.pdf", "../../../b", "./b", "b/../c", "/a/./b/..", "..", ".",
        "?q=2", "#f", "b?x=../y", "b#../z", "//h.fr/k", "http://o.fr/a/../b", "mailto:x@y.fr",
        "a//b", "é b.pdf", "b?", "b#", "/a/b/", "http://o.fr/#",
    ]
    got = evaluate(lambda c: urls.resolve_url(F.lit(base), c), hrefs)
    assert dict(zip(hrefs, got)) == {h: urljoin(base, h) for h in hrefs}


def test_authority(evaluate):
    check(evaluate, G.dept_from_authority, {
        "Préfet de Mayotte et Guyane": "976", "Préfecture de région": "", "préfet de mayotte": "",
        "La Réunion": "974",
    })


def test_label_code(evaluate):
    check(evaluate, G.department_code, {"Ain (01)": "01", "Corse (2A)": None, "Ain": None})


def test_numbers(evaluate):
    cases = {
        "Parc (01)": ["01"], "ZAC (38-73)": ["38", "73"], "Ligne (69+42)": ["69", "42"],
        "Pont (07, 26 et 38)": ["07", "26", "38"], "Projet (38 et 2B)": ["38", "2B"],
        "Projet (38 et 69+42)": [], "Reu (974)": ["974"], "St (977)": ["977"],
        "x (20) (96)": [], "y (1)": [], "Q (001)": [], "abc (zone 3)": [],
        "(01) et (01)": ["01", "01"], "(3)(8)": [], "(0) (1)": [], "none": [],
    }
    check(evaluate, G.dept_numbers, cases)


def test_names(evaluate):
    cases = {
        "Route (haute corse)": ["2B"], "Route (haute corse) phase 2": [],
        "Route (Haute-Corse) phase 2": ["2B"], "Port (Corse du Sud) phase 2": ["2A"],
        "x (ISÈRE) y (ain)": ["01", "38"], "x (ain": [], "((Ain))": ["01"], "(kſ)": [],
        "(Ariège)": ["09"], "(val-d'oıſe)": ["95"], "(Nord ) (nord)": ["59"],
    }
    check(evaluate, lambda c: G.sorted_codes(G.dept_names(c)), cases)


def test_regions(evaluate):
    centre = ["18", "28", "36", "37", "41", "45"]
    cases = {
        "plan région Bretagne phase 2": ["22", "29", "35", "56"],
        "PLAN RÉGION BRETAGNE": ["22", "29", "35", "56"], "plan Bretagne": [],
        "région Pays de la Loire": ["44", "49", "53", "72", "85"],
        "zone région Centre Val de Loire": centre, "région Centre-Val-de-Loire.": centre,
        "région Bretagnes": [], "sous-région Corse et région Guyane": ["2A", "2B", "973"],
        "région Bourgogne-Franche-Comté, x": ["21", "25", "39", "58", "70", "71", "89", "90"],
        "arégion Corse": [],
    }
    check(evaluate, lambda c: G.sorted_codes(G.dept_regions(c)), cases)


def test_cascade_is_sorted_and_distinct(evaluate):
    check(evaluate, G.depts_from_project, {
        "(73) (01) (73)": ["01", "73"], "(Ain) région Corse": ["01"], "région Corse": ["2A", "2B"],
        "(971, 69, 2A, 21)": ["21", "2A", "69", "971"], "rien": [],
    })
