"""Elements of captured pages, as rows.

``html_hits`` is the only place html is parsed: an Arrow function that walks a
page once and returns the few elements the monitoring rules name, tagged with
the rule (``kind``) and with the block they sit in.  Everything that gives those
elements a meaning (first menu only, layouts, years, following) is left to
DataFrame expressions in ``operators.extract``.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIT = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("block_pos", T.IntegerType()),
    T.StructField("block_class", T.StringType()),
    T.StructField("block_title", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("own_text", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("abs_url", T.StringType()),
])

# --- Fixed values: where the site puts things --------------------------------
# kind -> path of simple selectors from the outside in; ">x" means direct child.
SELECTORS = {
    "menu": ("#contenu", ".rubrique_avec_sous-rubriques"),
    "section": ("#contenu", ".liste-rubriques", ">div"),
    "project": ("#contenu", ".liste-articles", ".fr-card__link"),
    "next": ("#contenu", ".fr-pagination__list", ".fr-pagination__link--next[href]"),
    "breadcrumb": ("#breadcrumb", "ol.fr-breadcrumb__list", ">li", ">a"),
    "title": ("h1.titre-article",),
    "download": ("#contenu", "div.fr-download", "a.fr-download__link"),
    "base": ("base[href]",),
}
# kind -> (block kind, path inside the block, the block itself included).
BLOCK_SELECTORS = {
    "department": ("menu", (".fr-collapse", ".lien-sous-rubrique")),
    "section_many": ("section", (".rubrique_avec_sous-rubriques",)),
    "section_one": ("section", (".item-liste-rubriques-seule",)),
    "many_title": ("section", ("p.fr-tile__title",)),
    "one_title": ("section", (".fr-tile__link",)),
    "many_link": ("section", (".fr-collapse", "a")),
    "one_link": ("section", ("a",)),
}
# kind -> text a page must contain to have any; lets Spark skip pages unparsed.
MARKERS = {
    "department": "lien-sous-rubrique",
    "section_link": "liste-rubriques",
    "project": "fr-card__link",
    "next": "fr-pagination__link--next",
    "breadcrumb": "fr-breadcrumb__list",
    "title": "titre-article",
    "download": "fr-download__link",
}
# --- Fixed values: html elements that are closed by rule ---------------------
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"}, "a": {"a"}, **{tag: {"p"} for tag in _CLOSES_P},
}
# an end tag does not reach out of an element of higher rank
_RANK = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180,
    "table": 190, "head": 200, "body": 200, "html": 220,
}


def _compile(path):
    """``("#x", ">div.y[href]")`` -> [(direct, tag, id, classes, needs_href), ...]."""
    steps = []
    for step in path:
        direct, step = step.startswith(">"), step.lstrip(">")
        needs_href, step = step.endswith("[href]"), step.removesuffix("[href]")
        names = step.replace("#", ".#").split(".")
        element_id = next((n[1:] for n in names if n.startswith("#")), None)
        classes = frozenset(n for n in names[1:] if not n.startswith("#"))
        steps.append((direct, names[0] or None, element_id, classes, needs_href))
    return steps


def _by_last_step(rules):
    """Rules under the class, or else the tag, of the element they select."""
    index = {}
    for kind, (block_kind, path) in rules.items():
        steps = _compile(path)
        _, tag, _, classes, _ = steps[-1]
        index.setdefault("." + min(classes) if classes else tag, []).append(
            (kind, block_kind, steps)
        )
    return index


_RULES = _by_last_step({**{k: (None, path) for k, path in SELECTORS.items()}, **BLOCK_SELECTORS})

# Tags (quotes count only as attribute delimiters), comments, declarations.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?"
)
_RAW_END = {
    tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE)
    for tag in ("script", "style", "title", "textarea")
}


_NONE = frozenset()


class _Element:
    __slots__ = ("tag", "id", "classes", "href", "hits")

    def __init__(self, tag, attrs):
        self.tag, self.id, self.href, self.classes, self.hits = tag, None, None, _NONE, ()
        if not attrs:
            return
        for name, *values in reversed(_ATTRIBUTE.findall(attrs)):  # the first one counts
            name = name.lower()
            if name == "class":
                self.classes = frozenset(unescape("".join(values)).split())
            elif name == "href":
                self.href = unescape("".join(values))
            elif name == "id":
                self.id = unescape("".join(values))


def _fits(element, step):
    _, tag, element_id, classes, needs_href = step
    return (
        (tag is None or tag == element.tag)
        and (element_id is None or element_id == element.id)
        and classes <= element.classes
        and not (needs_href and element.href is None)
    )


def _matches(stack, steps, floor=0):
    """Does the innermost element of ``stack`` match, outer steps from ``floor`` up?"""

    def outer(at, step):  # steps[step] must hold at `at`, or above it unless `direct` below
        if step < 0:
            return True
        spots = (at,) if steps[step + 1][0] else range(at, floor - 1, -1)
        return any(
            i >= floor and _fits(stack[i], steps[step]) and outer(i - 1, step - 1) for i in spots
        )

    last = len(stack) - 1
    return _fits(stack[last], steps[-1]) and outer(last - 1, len(steps) - 2)


class _PageWalk:
    """Collects hits while the page streams by; keeps only the open elements."""

    def __init__(self):
        self.stack, self.open_hits, self.open_blocks = [], [], []
        self.hits, self.counts = [], {}

    def read(self, page):
        at = 0
        while found := _MARKUP.search(page, at):
            if found.start() > at:
                self.text(page[at:found.start()])
            at, tag = found.end(), found["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if found["end"]:
                self.end(tag)
                continue
            self.start(tag, found["attrs"])
            if tag in _RAW_END:
                stop = _RAW_END[tag].search(page, at)
                stop = stop.start() if stop else len(page)
                if stop > at:
                    self.text(page[at:stop])
                at = stop
        if at < len(page):
            self.text(page[at:])
        return self.hits

    def text(self, raw):
        """One text node: the first one for whoever still waits."""
        if not self.open_hits:
            return
        text = unescape(raw)
        for hit in self.open_hits:
            if hit["text"] is None:
                hit["text"] = text
        for hit in self.stack[-1].hits if self.stack else ():
            if hit["own_text"] is None:
                hit["own_text"] = text

    def start(self, tag, attrs):
        closes = _CLOSED_BY.get(tag, ())
        while self.stack and self.stack[-1].tag in closes:
            self.close(len(self.stack) - 1)
        element = _Element(tag, attrs)
        self.stack.append(element)
        for key in (tag, *("." + name for name in element.classes)):
            for kind, block_kind, steps in _RULES.get(key, ()):
                self.try_rule(element, kind, block_kind, steps)
        if tag == "a":
            for hit in self.open_hits:
                if hit["link"] is None:
                    hit["link"] = element
        if tag in _VOID:
            self.close(len(self.stack) - 1)

    def try_rule(self, element, kind, block_kind, steps):
        if block_kind is None:
            if _matches(self.stack, steps):
                self.hit(element, kind, None)
            return
        for depth, block in self.open_blocks:  # outermost first
            if block["kind"] == block_kind and _matches(self.stack, steps, depth):
                self.hit(element, kind, block)
                return

    def hit(self, element, kind, block):
        scope = (kind, block["pos"]) if block else kind
        pos = self.counts[scope] = self.counts.get(scope, -1) + 1
        hit = {"kind": kind, "pos": pos, "text": None, "own_text": None,
               "href": element.href, "block": block, "link": None}
        element.hits = (*element.hits, hit)
        self.open_hits.append(hit)
        self.hits.append(hit)
        if kind in _BLOCK_KINDS:
            self.open_blocks.append((len(self.stack) - 1, hit))

    def end(self, tag):
        rank = _RANK.get(tag, 100)
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth].tag
            if name == tag:
                return self.close(depth)
            if _RANK.get(name, 100) > rank:
                return None
        return None

    def close(self, depth):
        closing = sum(len(element.hits) for element in self.stack[depth:])
        del self.open_hits[len(self.open_hits) - closing:]  # opened last, closed first
        del self.stack[depth:]
        while self.open_blocks and self.open_blocks[-1][0] >= depth:
            self.open_blocks.pop()


_BLOCK_KINDS = {block_kind for block_kind, _ in BLOCK_SELECTORS.values()}


def _absolute(base, href):
    try:
        return None if href is None else urljoin(base, href.strip())
    except ValueError:  # not a URL at all
        return None


def _page_hits(page, url):
    hits = _PageWalk().read(page or "")
    base = next((h["href"] for h in hits if h["kind"] == "base"), "")
    base = _absolute(url or "", base)
    by_block = {}
    for hit in hits:
        if hit["block"] is not None:
            by_block.setdefault(id(hit["block"]), {}).setdefault(hit["kind"], []).append(hit)
    heading = next(
        (h for h in hits if h["kind"] == "title" and h["own_text"] is not None), None
    )
    rows = []
    for hit in hits:
        kind, block, layout, title = hit["kind"], hit["block"], None, None
        if block is not None and block["kind"] == "section":
            inside = by_block[id(block)]
            layout = "many" if "section_many" in inside else "one" if "section_one" in inside else None
            if kind != f"{layout}_link" or (layout == "one" and hit["pos"] > 0):
                continue
            titles = (h["own_text"] for h in inside.get(f"{layout}_title", ()))
            title = next((t for t in titles if t is not None), None)
            kind = "section_link"
        elif kind in _BLOCK_KINDS or kind == "base" or (kind == "title" and hit is not heading):
            continue
        elif kind == "department":
            hit["href"] = hit["link"].href if hit["link"] else None
        rows.append((kind, block["pos"] if block else None, layout, title, hit["pos"],
                     hit["text"], hit["own_text"], hit["href"], _absolute(base, hit["href"])))
    return rows


_COLUMNS = {f.name: pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string() for f in HIT}
PAGES_AT_ONCE = 256


def _holds(page, markers):
    """Does a page hold any of ``markers``, as it stands or written with character references?"""
    if any(m in page for m in markers):
        return True
    if "&" not in page:
        return False
    plain = unescape(page)
    return any(m in plain for m in markers)


def _hit_lists(pages, urls, markers):
    ends, rows = [0], []
    for page, address in zip(pages, urls):
        if page and _holds(page, markers):
            rows += _page_hits(page, address)
        ends.append(len(rows))
    cells = [pa.array(c, type=t) for c, t in zip(zip(*rows) if rows else [()] * len(_COLUMNS), _COLUMNS.values())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(cells, list(_COLUMNS)))


@lru_cache(maxsize=None)
def _hits_udf(kinds):
    markers = [MARKERS[kind] for kind in kinds]

    @F.arrow_udf(T.ArrayType(HIT))
    def hits(html: pa.Array, url: pa.Array) -> pa.Array:
        return pa.concat_arrays([
            _hit_lists(html.slice(at, PAGES_AT_ONCE).to_pylist(), url.slice(at, PAGES_AT_ONCE).to_pylist(), markers)
            for at in range(0, max(len(html), 1), PAGES_AT_ONCE)
        ])

    return hits


def html_hits(html: str, url: str, kinds=tuple(MARKERS)) -> Column:
    """Tagged elements of each page; pages without any of ``kinds`` are not parsed and have none.

    A batch is turned into rows a few pages at a time, so that a worker's memory grows
    neither with the batch nor with the table.
    """
    return _hits_udf(tuple(kinds))(html, url)


def may_have(html: Column, kinds) -> Column:
    """Cheap JVM-side test that skips pages without any of ``kinds``.

    A marker may be written with character references, so a page with one anywhere passes
    too: where a tag ends is for the parser to say.
    """
    test = html.rlike("&#?[0-9A-Za-z]")
    for kind in kinds:
        test = test | F.contains(html, F.lit(MARKERS[kind]))
    return test
