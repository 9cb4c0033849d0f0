"""Monitoring inputs derived from the driver's tables, on Spark.

Every view covers the whole table it is made from.  ``views_sql`` states the
same views in SQL for the comparison.  A view is a plan over the given tables, made
anew in every query, so each query reads them and its time includes that.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmonitor.functions.urls import event_key, is_zip

SITE = "https://docs.example.org"
START_URL = f"{SITE}/accueil.html"
YEARS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores, as a captured table of many files would be."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def _pick(key: Column, *values) -> Column:
    """``values[key]`` as a CASE."""
    out = F.when(key == 0, values[0])
    for i, value in enumerate(values[1:-1], 1):
        out = out.when(key == i, value)
    return out.otherwise(values[-1])


def _two_digits(col: Column) -> Column:
    return F.lpad(col.cast("string"), 2, "0")


def docs_base_of(orders: DataFrame) -> DataFrame:
    """One file row per order (row-wise, so it also applies to a stream)."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    k = o.cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return orders.select(
        o.alias("crawl_seq"),
        text("avis_ae_", k, F.when(o % 2 == 0, ". ").otherwise(".,")).alias("title"),
        _pick(
            o % 6,
            text("  parc solaire ", k, " (", _two_digits(c % 100), ").,"),
            text("zone d’activité ", k, " (", _pick(
                c % 4, F.lit("Ain"), F.lit("haute savoie"), F.lit("Corse-du-Sud"), F.lit("RHÔNE")
            ), ")"),
            text("plan climat région ", _pick(
                c % 3, F.lit("Bretagne"), F.lit("Île-de-France"), F.lit("Pays de la Loire")
            ), " phase ", k),
            text("Lyon (69) : tramway ", k),
            text("ligne ", k, " (07, 26+2A et 38)"),
            text("étude n° ", k, " ."),
        ).alias("project"),
        text(f"{SITE}/projets-r", c.cast("string"), ".html").alias("source_page_url"),
        text(f"{SITE}/IMG/f ", k, _pick(
            o % 5, F.lit(".pdf"), F.lit(".PDF?v=1"), F.lit(".zip"), F.lit(".exe"),
            F.lit(".tar.docx;p=1"),
        )).alias("source_file_url"),
        F.when(F.col("o_totalprice") < 5000, "inconnue").otherwise(
            F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
        ).alias("publication_lastmodified"),
        F.when(o % 7 == 0, "Préfet de Mayotte et Guyane")
        .when(o % 7 == 1, "Préfète de La Réunion")
        .otherwise("Préfecture de région").alias("authority"),
        F.when(o % 9 == 0, "Autres avis").otherwise("Décisions au CAS PAR CAS")
        .alias("category_local"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(c % 11 == 0, "Corse (2A)").otherwise(
            text("Département (", _two_digits(c % 95 + 1), ")")
        ).alias("department_label"),
        F.lit(False).alias("file_from_zip"),
        F.lit(None).cast("string").alias("source_filename"),
        F.lit(None).cast("string").alias("member_path"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def docs_base(spark, sf_dir) -> DataFrame:
    return docs_base_of(spread(table(spark, sf_dir, "orders"), "o_orderkey"))


def docs_in(spark, sf_dir) -> DataFrame:
    return docs_base(spark, sf_dir).drop("status", "priority")


def _member_path() -> Column:
    p = F.col("l_partkey")
    ext = _pick(p % 4, F.lit(".pdf"), F.lit(".PDF"), F.lit(".exe"), F.lit(".docx"))
    return F.concat(
        F.lit("dossier_"), F.col("l_linenumber").cast("string"),
        F.lit("/piece_"), p.cast("string"), ext,
    )


def members_in(spark, sf_dir) -> DataFrame:
    """Archive members: the distinct lines of orders whose file is an archive."""
    archives = docs_base_of(table(spark, sf_dir, "orders")).where(is_zip(F.col("source_file_url"))).drop("member_path")
    return _lines(spark, sf_dir).join(archives, F.col("l_orderkey") == F.col("crawl_seq")).select(
        F.col("source_file_url").alias("zip_url"), "member_path"
    )


def _lines(spark, sf_dir) -> DataFrame:
    """Distinct lines of each order, dealt by order: joins on that key need no other shuffle of them."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", _member_path().alias("member_path")).repartition("l_orderkey").distinct()


def seen_in(spark, sf_dir, members: DataFrame | None = None) -> DataFrame:
    """State of an earlier run: finished orders, and the first folder of every archive.

    ``members`` are those of ``members_in`` where a query has written them already.
    """
    members = members_in(spark, sf_dir) if members is None else members
    docs = docs_base(spark, sf_dir).where("status = 'F'").select(
        F.when(is_zip(F.col("source_file_url")), "zips").otherwise("documents").alias("kind"),
        F.col("source_file_url").alias("key"),
    )
    members = members.where("member_path LIKE 'dossier_1/%'").select(
        F.lit("documents").alias("kind"),
        event_key(F.lit(True), F.col("zip_url"), F.col("member_path")).alias("key"),
    )
    return docs.unionByName(members).select(
        "kind", "key",
        F.lit("2001-01-01T00:00:00").alias("last_modified"),
        F.lit("2001-02-03T04:05:06").alias("last_seen"),
        F.lit("2001").alias("target_year"),
    )


def headers_in(spark, sf_dir) -> DataFrame:
    """File headers; urgent orders were moved to another host."""
    url = F.col("source_file_url")
    return docs_base(spark, sf_dir).select(
        url.alias("request_url"),
        F.when(
            F.col("priority").startswith("1"),
            F.replace(url, F.lit(SITE), F.lit("https://files.example.org")),
        ).otherwise(url).alias("final_url"),
        F.col("publication_lastmodified").alias("last_modified"),
    )


# -- a site, as captured pages --------------------------------------------------------
def _html(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _page(*body) -> Column:
    return _html("<!DOCTYPE html><html><head><meta charset=utf-8><title>x</title></head><body>",
                 *body, "</body></html>")


def _blocks(col: str, fn) -> Column:
    return F.array_join(F.transform(col, fn), "")


def site_faults() -> dict[str, Column]:
    """Where the faulty site is broken, by its keys (``views_sql.SITE_FAULTS`` says the same)."""
    return {
        "no_year": F.expr("(d + 3 * y + s + p) % 7 = 5"), "no_title": F.expr("k % 13 = 5"),
        "not_captured": F.expr("k % 29 = 11"),
    }


def site_projects(spark, sf_dir) -> DataFrame:
    """Projects are runs of eight order keys, so no page lists more than eight files."""
    k = F.expr("o_orderkey div 8")
    projects = table(spark, sf_dir, "orders").groupBy(k.alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderdate"))).alias("files")
    )
    return projects.withColumns({
        "d": F.expr("k % 25"), "y": F.expr("k div 25 % 3"), "j": F.expr("k div 75"),
    }).withColumns({
        "s": F.expr("CASE WHEN d % 2 = 0 THEN j % 2 ELSE 0 END"),
        "i": F.expr("CASE WHEN d % 2 = 0 THEN j div 2 ELSE j END"),
    }).withColumn("p", F.expr("i div 10")).drop("j")


def list_url(d, y, s, p) -> Column:
    """List page address (``p`` counts from 0)."""
    return F.concat(
        F.lit(f"{SITE}/liste-d"), d.cast("string"), F.lit("-a"), y.cast("string"),
        F.lit("-s"), s.cast("string"), F.lit(".html"),
        F.when(p > 0, F.concat(F.lit("?debut_page="), p.cast("string"))).otherwise(F.lit("")),
    )


def _file_link(f, faulty: bool = False) -> Column:
    k = f.o_orderkey
    shown = F.when(k % 19 == 7, F.lit("")) if faulty else F.when(F.lit(False), F.lit(""))
    href = _pick(
        k % 3, _html("https://files.example.org/IMG/f ", k, ".pdf"),
        _html("/IMG/f", k, ".pdf"), _html("../IMG/./f", k, ".zip"),
    )
    return _html(
        "<div class=\"fr-download\"><p><a class='x fr-download__link' href=\"", href,
        "\">", shown.otherwise(_html("\n  Avis ", k, " du ", F.date_format(f.o_orderdate, "yyyy-MM-dd"), "\n<span>PDF</span>")),
        "</a></div>",
    )


def pages_in(spark, sf_dir, faulty: bool = False) -> DataFrame:
    """``(url, html)``: start page, departments, paginated lists, projects.

    The faulty site lacks years, titles, link texts and whole pages (``site_faults``).
    """
    faults = site_faults() if faulty else {name: F.lit(False) for name in site_faults()}
    projects = site_projects(spark, sf_dir)
    nation = table(spark, sf_dir, "nation")
    url = lambda *parts: _html(f"{SITE}/", *parts)

    entries = nation.agg(
        F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("entries")
    )
    menu = _blocks("entries", lambda n: _html(
        "<li><a class=\"lien-sous-rubrique\" href=\"departement-", n.n_nationkey, ".html\"> ",
        n.n_name, " (", _two_digits(n.n_nationkey + 1), ")</a>",
    ))
    start = entries.select(F.lit(START_URL).alias("url"), _page(
        "<a class=lien-sous-rubrique href=outside.html>Outside</a><div id=contenu>",
        "<div class='tile rubrique_avec_sous-rubriques'><div class=fr-collapse><ul>", menu,
        "</ul></div></div><div class=rubrique_avec_sous-rubriques><div class=fr-collapse>",
        "<a class=lien-sous-rubrique href=autre.html>Autre (99)</a></div></div></div>",
    ).alias("html"))

    n = F.col("n_nationkey")
    years = F.array(*map(F.lit, range(YEARS)))

    def section(y):
        def link(s, text):
            return _html("<a class='fr-tile__link' href='", list_url(n, y, F.lit(s), F.lit(0)),
                         "'>", text, "</a>")
        many = _html(
            "<div class=fr-col><div class=rubrique_avec_sous-rubriques><p class=fr-tile__title>\n ",
            y + 2022, " <div class=fr-collapse>", link(0, " Semestre 1 "), link(1, "Semestre 2"),
            "</div></div></div>",
        )
        one = _html("<div><div class='item-liste-rubriques-seule'>", link(0, _html("Année ", y + 2022)),
                    "</div></div>")
        return F.when(n % 2 == 0, many).otherwise(one)

    departments = nation.select(url("departement-", n, ".html").alias("url"), _page(
        "<div id=\"contenu\"><div class=\"liste-rubriques\">",
        F.array_join(F.transform(years, section), ""),
        "<div><p>Archives <a href=vieux.html>2022</a></div></div></div>",
    ).alias("html"))

    key = ["d", "y", "s"]
    cards = projects.groupBy(*key, "p").agg(  # ten at most: p is i div 10
        F.sort_array(F.collect_list(F.struct("i", "k"))).alias("cards")
    )
    spans = projects.groupBy(*key).agg(F.max("p").alias("last"))
    lists = spans.select(*key, "last", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("p"))
    lists = lists.join(cards, [*key, "p"], "left")
    d, y, s, p = map(F.col, ("d", "y", "s", "p"))
    crumbs = "".join(f"<li><a href='/n{i}.html'>niveau {i}</a></li>" for i in range(7))
    year = F.when(faults["no_year"], F.lit("")).otherwise(
        _html(f"<nav id=breadcrumb><ol class='fr-breadcrumb__list'>{crumbs}<li><a href='#'>", y + 2022,
              "</a></li><li><a href='#'>ici</a></li></ol></nav>"))
    lists = lists.select(list_url(d, y, s, p).alias("url"), _page(
        year, "<div id=contenu><div class=liste-articles>",
        F.coalesce(_blocks("cards", lambda c: _html(
            "<div class=fr-card><h3><a class=\"fr-card__link\" href=\"projet-", c.k, ".html#top\">",
            "Projet ", c.k, "</a></h3></div>",
        )), F.lit("")),
        "</div><ul class=fr-pagination__list><li><a class='fr-pagination__link--next'",
        F.when(p < F.col("last"), _html(" href=\"", list_url(d, y, s, p + 1), "\"")).otherwise(F.lit("")),
        ">Suivant</a></ul></div>",
    ).alias("html"))

    title = F.when(faults["no_title"], F.lit("")).otherwise(_html(
        "<h1 class=\"big titre-article\">Projet n&deg;&nbsp;", F.col("k"), " &amp; annexes<!-- c --> x</h1>"))
    captured = projects.where(~faults["not_captured"])
    project_pages = captured.select(url("projet-", F.col("k"), ".html").alias("url"), _page(
        title, "<div id='contenu'>", _blocks("files", lambda f: _file_link(f, faulty)), "<br><p>fin<p></div>",
    ).alias("html"))
    site = start.unionByName(departments).unionByName(lists).unionByName(project_pages)
    return spread(site, "url")


def _site_file(k: Column) -> Column:
    """Address of a site's file, as its page links it."""
    k = k.cast("string")
    return _pick(F.col("o_orderkey") % 3, _html("https://files.example.org/IMG/f ", k, ".pdf"),
                 _html(f"{SITE}/IMG/f", k, ".pdf"), _html(f"{SITE}/IMG/f", k, ".zip"))


def _moved(url: Column) -> Column:
    """Files of every eleventh order are served from elsewhere."""
    return F.when(F.col("o_orderkey") % 11 == 3, F.replace(url, F.lit("/IMG/"), F.lit("/files/"))).otherwise(url)


def site_headers_in(spark, sf_dir) -> DataFrame:
    """Headers of the site's files; every seventeenth has none."""
    url = _site_file(F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").where("o_orderkey % 17 <> 2").select(
        url.alias("request_url"), _moved(url).alias("final_url"),
        F.when(F.col("o_orderkey") % 23 == 4, "inconnue").otherwise(
            F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).alias("last_modified"),
    )


def site_members_in(spark, sf_dir) -> DataFrame:
    """Members of the site's archives, by the address these are served from."""
    archives = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 2").select(
        "o_orderkey", _moved(_site_file(F.col("o_orderkey"))).alias("zip_url"))
    return _lines(spark, sf_dir).join(archives, F.col("l_orderkey") == F.col("o_orderkey")).select("zip_url", "member_path")


def site_seen_in(spark, sf_dir, members: DataFrame | None = None) -> DataFrame:
    """What an earlier run knows of the site: linked files, moved files, archives and members."""
    members = site_members_in(spark, sf_dir) if members is None else members
    link = _site_file(F.col("o_orderkey"))
    kind = lambda url: F.when(is_zip(url), "zips").otherwise("documents").alias("kind")
    orders = table(spark, sf_dir, "orders")
    linked = orders.where("o_orderkey % 31 = 5").select(kind(link), link.alias("key"))
    served = orders.where("o_orderkey % 37 = 6").select(kind(_moved(link)), _moved(link).alias("key"))
    members = members.where("member_path LIKE 'dossier_1/%'").select(
        F.lit("documents").alias("kind"), event_key(F.lit(True), F.col("zip_url"), F.col("member_path")).alias("key"))
    return linked.unionByName(served).unionByName(members).distinct().select(
        "kind", "key", F.lit("2001-01-01T00:00:00").alias("last_modified"),
        F.lit("2001-02-03T04:05:06").alias("last_seen"), F.lit("2001").alias("target_year"))


# -- archives ---------------------------------------------------------------------
def _zip_bytes(paths: list) -> bytes:
    """The archive that ``zipfile`` writes (``_slow_zip_bytes``), put together directly."""
    if not all(p.isascii() and "\0" not in p for p in paths) or len(paths) > 1000:
        return _slow_zip_bytes(paths)
    body, contents, at = [], [], 0
    for path in paths:
        name = path.encode()
        data = b"" if path.endswith("/") else b"x" * len(name)
        crc, n = zlib.crc32(data), len(data)
        contents.append(_CONTENTS.pack(b"PK\1\2", 20, 3, 20, 0, 0, 0, 0, 33, crc, n, n, len(name), 0, 0, 0, 0, 0o600 << 16, at) + name)
        body += (_HEADER.pack(b"PK\3\4", 20, 0, 0, 0, 0, 33, crc, n, n, len(name), 0), name, data)
        at += _HEADER.size + len(name) + n
    size = sum(map(len, contents))
    return b"".join([*body, *contents, _END.pack(b"PK\5\6", 0, 0, len(paths), len(paths), size, at, 0)])


_HEADER, _CONTENTS, _END = struct.Struct("<4s2B4HL2L2H"), struct.Struct("<4s4B4HL2L5H2L"), struct.Struct("<4s4H2LH")


def _slow_zip_bytes(paths: list) -> bytes:
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        for path in paths:
            archive.writestr(zipfile.ZipInfo(path), b"x" * (len(path) if not path.endswith("/") else 0))
    return body.getvalue()


@F.arrow_udf(T.BinaryType())
def make_zip(paths: pa.Array) -> pa.Array:
    return pa.array([_zip_bytes(p) for p in paths.to_pylist()], type=pa.binary())


def zip_files(spark, sf_dir) -> DataFrame:
    """A real archive per order: its lines as files, under a folder entry.

    Lines of an order are grouped in blocks of eight part numbers, so that no
    archive grows with the number of lines an order has.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.expr("l_partkey div 8").alias("block"), _member_path().alias("path")
    ).repartition("l_orderkey", "block")  # the only shuffle
    archives = lines.distinct().groupBy("l_orderkey", "block").agg(
        F.sort_array(F.collect_list("path")).alias("paths")
    )
    return archives.select(
        _html(f"{SITE}/zip/", F.col("l_orderkey"), "-", F.col("block"), ".zip").alias("zip_url"),
        make_zip(F.concat(F.array(F.lit("vide/")), F.col("paths"))).alias("content"),
    )


# -- projects of the publishing service --------------------------------------------
def projects_in(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title")
    )


def project_requests(spark, sf_dir) -> DataFrame:
    """Known titles, plain ids and titles nobody has created yet."""
    o, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.when(o % 3 == 0, F.concat(F.lit("Customer#"), F.lpad(c, 9, "0")))
        .when(o % 3 == 1, c)
        .otherwise(F.concat(F.lit("Nouveau projet "), c)).alias("project")
    )
