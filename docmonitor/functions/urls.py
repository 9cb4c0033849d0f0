"""URL functions (native expressions, no Python worker).

``parse_url`` is no help here: it gives null for the blanks and accents these
sites have in their links.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"


# origin, folders, and then the segment up to its parameters
_BASENAME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?(?:[^?#]*/)?([^?#/;]*)"


def without_breaks(url: Column) -> Column:
    """URL without tabs and line breaks, which count for nothing in one."""
    for char in "\t\r\n":
        url = F.replace(url, F.lit(char), F.lit(""))
    return url


def _without_query(url: Column) -> Column:
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


def request_url(url: Column) -> Column:
    """The address a page is fetched from: without its fragment."""
    return F.substring_index(url, "#", 1)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value's expression in the plan once."""
    return F.transform(F.array(value), use)[0]


def _one_form(tail: Column) -> Column:
    """Escapes in one form: unreserved characters bare, reserved ones as they stand, all
    others as upper-case ``%XX`` of their UTF-8 bytes."""

    def one(c: Column) -> Column:
        char = F.char(F.conv(F.substr(c, F.lit(2)), 16, 10).cast("int"))
        return (
            F.when(c.rlike(r"^[A-Za-z0-9._~/!$&'()*+,;=:@?-]$"), c)
            .when(~c.rlike("^%.."), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")))
            .when(char.rlike(r"^[A-Za-z0-9._~-]$"), char).otherwise(F.upper(c))
        )

    parts = F.regexp_extract_all(tail, F.lit(r"(?s)%[0-9A-Fa-f]{2}|."), F.lit(0))
    return F.array_join(F.transform(parts, one), "")


def request_identity(url: Column, method: str = "GET") -> Column:
    """What makes two requests the same: the address in one canonical form, with the method
    before it unless that is ``GET``.

    Scheme and host are in lower case, the scheme's own port and the fragment are left
    out, an empty path is ``/``, escapes have one form, and the query's arguments are ordered, a
    blank as ``+`` and a missing value as an empty one.  Other texts than ``scheme://`` addresses
    keep their form without the fragment.
    """
    whole = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*@)?([^/?]*)(.*)$"

    def canonical(bare: Column) -> Column:
        scheme, host = (F.lower(F.regexp_extract(bare, whole, i)) for i in (1, 3))
        port = F.when(scheme == "http", ":(80)?$").when(scheme == "https", ":(443)?$").otherwise(":$")
        place = F.concat(scheme, F.lit("://"), F.regexp_extract(bare, whole, 2), F.regexp_replace(host, port, F.lit("")))
        return F.concat(place, _let(_one_form(F.regexp_extract(bare, whole, 4)), path_and_query))

    def path_and_query(tail: Column) -> Column:
        path = F.coalesce(F.nullif(F.substring_index(tail, "?", 1), F.lit("")), F.lit("/"))
        asked = F.split(F.replace(F.regexp_extract(tail, r"\?(.*)", 1), F.lit("%20"), F.lit("+")), "&")
        pairs = F.transform(F.filter(asked, lambda x: x != ""), lambda x: F.when(F.contains(x, F.lit("=")), x).otherwise(F.concat(x, F.lit("="))))
        return F.concat(path, F.regexp_replace(F.array_join(F.array_sort(pairs), "&"), "^(?=.)", "?"))

    # most are in that form already
    address = _let(request_url(without_breaks(url)), lambda bare: F.when(
        bare.rlike(r"^https?://[a-z0-9.-]+/[A-Za-z0-9/._~-]*$") | ~bare.rlike(whole), bare).otherwise(canonical(bare)))
    return address if method == "GET" else F.concat(F.lit(f"{method} "), address)


def is_zip(url: Column) -> Column:
    """Archive by its whole URL, so ``x.zip?d=1`` is none."""
    return F.endswith(F.lower(url), F.lit(".zip"))


def url_basename(url: Column) -> Column:
    """Last path segment: not decoded, without query, fragment and ``;params``."""
    return F.regexp_extract(without_breaks(url), _BASENAME, 1)


def source_filename(filename: Column, url: Column) -> Column:
    """A given non-empty file name, else the one in the URL."""
    return F.coalesce(F.nullif(filename, F.lit("")), url_basename(url))


def event_key(from_zip: Column, url: Column, member_path: Column) -> Column:
    """State key: the URL, plus the path inside the archive for its members."""
    return F.when(from_zip, F.concat(url, F.lit("/"), member_path)).otherwise(url)


def _collapse_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(
            part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).when(part == ".", acc).otherwise(F.concat(acc, F.array(part))),
    )
    # a path ending in a dot segment keeps its final slash
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(F.endswith(joined, F.lit("/")), joined).otherwise(F.concat(joined, tail))


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` as seen from the page ``base`` (an absolute http URL)."""
    scheme = F.regexp_extract(base, _SCHEME, 0)
    origin = F.regexp_extract(base, _ORIGIN, 0)
    base_path = F.regexp_replace(_without_query(base), _ORIGIN, "")
    folder = F.concat(F.regexp_extract(base_path, r"^(.*)/", 1), F.lit("/"))
    ref_path = _without_query(href)
    suffix = F.substr(href, F.length(ref_path) + 1)
    merged = F.when(F.startswith(href, F.lit("/")), ref_path).otherwise(
        F.regexp_replace(F.concat(folder, ref_path), "/{2,}", "/")
    )
    path = F.when(
        merged.rlike(r"/\.\.?(/|$)"), _collapse_dots(merged)
    ).otherwise(merged)
    resolved = (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.substring_index(base, "#", 1), href))
        .when(F.startswith(href, F.lit("?")), F.concat(_without_query(base), href))
        .otherwise(F.concat(origin, path, suffix))
    )
    # an empty query or fragment leaves no mark, but for links to another scheme
    own = ~href.rlike(_SCHEME) | F.startswith(F.lower(href), F.lower(scheme))
    return F.when(
        own & href.rlike(r"[?#]$"), F.regexp_replace(resolved, r"\??#?$", "")
    ).otherwise(resolved)
