"""The comparison SQL of every query that SQL can express."""

from __future__ import annotations

from checks import views_sql as Q
from checks.queries import DAY, LARGE_LIMIT, LIMIT, PARAMS, RUN_TS, SITE_RUN

NOW = f"'{RUN_TS.isoformat()}'"
CODE_OF_LABEL = r"nullif(regexp_extract(department_label, '\((\d\d)\)', 1), '')"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
IS_ZIP = "lower(source_file_url) LIKE '%.zip'"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def docs(select: str, *more: str) -> str:
    return with_(Q.DOCS, *more, select=select)


SOURCE = "SELECT d.*, {member} AS member_path FROM docs_base d"
ALL_ROWS = f"""all_rows AS (
  {SOURCE.format(member='NULL')} WHERE NOT {IS_ZIP}
  UNION ALL {SOURCE.format(member='m.member_path')} JOIN members_in m ON m.zip_url = d.source_file_url)"""
PLAIN_ROWS = f"plain_rows AS ({SOURCE.format(member='CAST(NULL AS VARCHAR)')})"
# Candidates of a run on top of the earlier state.
NEW_ROWS = f"""new_rows AS (
  {SOURCE.format(member='NULL')} WHERE NOT {IS_ZIP}
    AND source_file_url NOT IN (SELECT key FROM seen_in WHERE kind = 'documents')
  UNION ALL {SOURCE.format(member='m.member_path')} JOIN members_in m ON m.zip_url = d.source_file_url
  WHERE d.source_file_url NOT IN (SELECT key FROM seen_in WHERE kind = 'zips')
    AND m.zip_url || '/' || m.member_path NOT IN (SELECT key FROM seen_in WHERE kind = 'documents'))"""


def accepted(source: str, select: str, *more: str, ctes=(), limit: int = 0) -> str:
    return with_(Q.DOCS, *ctes, Q.classified(source, limit), Q.tagged("rows_"), Q.ACCEPTED, *more,
                 select=select)


def on_plain(select: str, *more: str) -> str:
    return accepted("plain_rows", select, *more, ctes=(PLAIN_ROWS,))


def on_all(select: str, *more: str) -> str:
    return accepted("all_rows", select, *more, ctes=(Q.MEMBERS, ALL_ROWS))


def on_new(select: str, *more: str) -> str:
    return accepted("new_rows", select, *more, ctes=(Q.MEMBERS, Q.SEEN, NEW_ROWS))


COMPLETE = f"""keys_ AS (SELECT key FROM seen_in WHERE kind = 'documents' UNION SELECT event_data_key FROM accepted),
supported AS (SELECT * FROM members_in WHERE {Q.file_ext('member_path')} IN ({Q._EXTS})),
complete AS (SELECT zip_url FROM supported
  WHERE zip_url IN (SELECT source_file_url FROM accepted WHERE file_from_zip)
  GROUP BY zip_url HAVING bool_and(zip_url || '/' || member_path IN (SELECT key FROM keys_)))"""
NEW_STATE = f"""new_state AS (
  SELECT 'documents' AS kind, event_data_key AS key, {ISO} AS last_modified, {NOW} AS last_seen, year AS target_year FROM accepted
  UNION ALL
  SELECT DISTINCT 'zips', source_file_url, {ISO}, {NOW}, year FROM accepted
  WHERE file_from_zip AND source_file_url IN (SELECT zip_url FROM complete))"""
OLD_STATE = """old_state AS (SELECT kind, key, '2001-01-01T00:00:00' AS last_modified,
  '2001-02-03T04:05:06' AS last_seen, '2001' AS target_year FROM seen_in)"""


def upsert(kind: str) -> str:
    new = f"SELECT * FROM new_state WHERE kind = '{kind}'"
    return (f"SELECT * FROM old_state o WHERE NOT EXISTS (SELECT 1 FROM ({new}) n "
            f"WHERE n.kind = o.kind AND n.key = o.key) UNION ALL {new}")


PAYLOAD = f"""to_json({{{{'authority': authority, 'category': category, 'category_local': category_local,
  'event_data_key': event_data_key, 'source_scraper': '{PARAMS.scraper_name}', 'source_scraper_year': year,
  'source_file_url': source_file_url, 'source_filename': source_filename, 'source_page_url': source_page_url,
  'publication_date': publication_date, 'publication_time': publication_time,
  'publication_datetime': publication_datetime, 'project_id': project_id{{zip}},
  'departments': string_split(departments, ','), 'departments_sources': string_split(departments_sources, ',')}}}})"""
DATA = (
    "CAST(CASE WHEN file_from_zip THEN "
    + PAYLOAD.format(zip=", 'source_file_zip_path': source_file_zip_path").replace("{{", "{").replace("}}", "}")
    + " ELSE " + PAYLOAD.format(zip="").replace("{{", "{").replace("}}", "}")
    + " END AS VARCHAR)"
)

ITEM = "chr(10) || " + " || chr(10) || ".join(
    f"'            {c}: ' || coalesce({c}, '')" for c in (
        "title", "project", "authority", "category", "category_local", "year", "publication_date",
        "source_filename", "source_file_url", "source_page_url", "event_data_key",
    )
) + " || chr(10) || '            '"

PARSED = "strftime(ts, '{}')"


def project_codes(column: str) -> str:
    return with_(
        Q.DOCS, f"cleaned_ AS (SELECT crawl_seq, {Q.clean_project('project')} AS project FROM docs_base)",
        Q.tagged("cleaned_"),
        select=f"SELECT crawl_seq, array_to_string({column}, ',') AS codes FROM cleaned_ JOIN codes USING (project)",
    )


def site(select: str, *more: str) -> str:
    return with_(Q.SITE_LINKS, *more, select=select)


def limited(n: int) -> str:
    return docs(
        "SELECT crawl_seq, CASE WHEN NOT ok THEN 'Unsupported filetype' WHEN r > "
        f"{n} THEN 'Upload limit exceeded.' END AS reason FROM (SELECT crawl_seq, ok, "
        "row_number() OVER (PARTITION BY ok ORDER BY crawl_seq) AS r FROM named)",
        f"named AS (SELECT crawl_seq, {Q.file_ext(Q.url_basename('source_file_url'))} IN ({Q._EXTS}) AS ok FROM docs_base)",
    )


LIST = Q.list_url()
SECTIONS = f"""sections AS (
  SELECT n_nationkey AS d, y, s FROM nation, (SELECT unnest([0, 1, 2]) AS y), (SELECT unnest([0, 1]) AS s)
  WHERE s = 0 OR n_nationkey % 2 = 0)"""
DEPARTMENT_URL = f"'{Q.SITE}/departement-' || n_nationkey || '.html'"
PROJECT_URL = f"'{Q.SITE}/projet-' || k || '.html'"

# -- the faulty site (``views.site_faults``) and a run over it ----------------------------
SITE_FILE = f"""CASE o_orderkey % 3 WHEN 0 THEN 'https://files.example.org/IMG/f ' || o_orderkey || '.pdf'
    WHEN 1 THEN '{Q.SITE}/IMG/f' || o_orderkey || '.pdf' ELSE '{Q.SITE}/IMG/f' || o_orderkey || '.zip' END"""
KIND = "CASE WHEN {x} LIKE '%.zip' THEN 'zips' ELSE 'documents' END"
SITE_WALK = f"""site_orders AS (SELECT o_orderkey, o_orderdate, {SITE_FILE} AS link FROM orders),
site_headers AS (SELECT o_orderkey, o_orderdate, link,
  CASE WHEN o_orderkey % 11 = 3 THEN replace(link, '/IMG/', '/files/') ELSE link END AS final_url FROM site_orders),
site_members AS (SELECT DISTINCT final_url AS zip_url, 'dossier_' || l_linenumber || '/piece_' || l_partkey ||
    CASE l_partkey % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.exe' ELSE '.docx' END AS member_path
  FROM lineitem JOIN site_headers ON l_orderkey = o_orderkey WHERE o_orderkey % 3 = 2),
seen_in AS (SELECT {KIND.format(x='link')} AS kind, link AS key FROM site_orders WHERE o_orderkey % 31 = 5
  UNION SELECT {KIND.format(x='final_url')}, final_url FROM site_headers WHERE o_orderkey % 37 = 6
  UNION SELECT 'documents', zip_url || '/' || member_path FROM site_members WHERE member_path LIKE 'dossier_1/%'),
stops AS (SELECT d, y, s, min(p) FILTER ((d + 3 * y + s + p) % 7 = 5) AS stop FROM lists_ GROUP BY ALL),
listed AS (SELECT * FROM placed JOIN stops USING (d, y, s) WHERE y < 2 AND (stop IS NULL OR p < stop)),
site_links AS (SELECT *, CASE WHEN o_orderkey % 19 = 7 THEN 'No link text' WHEN k % 13 = 5 THEN 'Empty project' END AS lost
  FROM files_ JOIN listed USING (k) WHERE k % 29 <> 11),
fresh AS (SELECT * FROM site_links WHERE lost IS NULL AND abs_url NOT IN (SELECT key FROM seen_in)),
lost_rows AS (
  SELECT {Q.list_url(p='stop')} AS url, 'No year' AS reason FROM stops WHERE y < 2 AND stop IS NOT NULL
  UNION ALL SELECT {Q.list_url(p='0')}, 'Page not captured' FROM sections ANTI JOIN lists_ USING (d, y, s) WHERE y < 2
  UNION ALL SELECT '{Q.SITE}/projet-' || k || '.html', 'Page not captured' FROM listed WHERE k % 29 = 11
  UNION ALL SELECT abs_url, lost FROM site_links WHERE lost IS NOT NULL
  UNION ALL SELECT abs_url, 'No header' FROM fresh WHERE o_orderkey % 17 = 2)"""
SITE_ROWS = f"""site_docs AS (SELECT row_number() OVER (ORDER BY d, y, s, p, card, pos) AS crawl_seq, f.title,
  {Q.project_title('k')} AS project, '{Q.SITE}/projet-' || k || '.html#top' AS source_page_url, final_url AS source_file_url,
  CASE WHEN o_orderkey % 23 = 4 THEN 'inconnue' ELSE strftime(h.o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' GMT' END AS publication_lastmodified,
  CASE WHEN o_orderkey % 23 <> 4 THEN h.o_orderdate END AS ts,
  {Q.quote(SITE_RUN.authority)} AS authority, {Q.quote(SITE_RUN.category_local)} AS category_local,
  CAST(2022 + y AS VARCHAR) AS year, ' ' || {Q.department_label()} AS department_label
  FROM fresh f JOIN site_headers h USING (o_orderkey) JOIN nation ON n_nationkey = d WHERE o_orderkey % 17 <> 2),
site_rows AS (
  SELECT d.*, NULL AS member_path FROM site_docs d WHERE source_file_url NOT LIKE '%.zip'
    AND source_file_url NOT IN (SELECT key FROM seen_in WHERE kind = 'documents')
  UNION ALL SELECT d.*, m.member_path FROM site_docs d JOIN site_members m ON m.zip_url = d.source_file_url
  WHERE d.source_file_url NOT IN (SELECT key FROM seen_in WHERE kind = 'zips')
    AND m.zip_url || '/' || m.member_path NOT IN (SELECT key FROM seen_in WHERE kind = 'documents'))"""


def on_site(select: str, limit: int = 0) -> str:
    return with_(Q.SITE_LINKS, SECTIONS, SITE_WALK, SITE_ROWS, Q.classified("site_rows", limit), Q.tagged("rows_"),
                 Q.ACCEPTED, select=select)


CHAR = "chr(CAST('0x' || substr(c, 2) AS INTEGER))"
REQUESTS = rf"""links AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos FROM pages),
absolute AS (SELECT page_id, pos, (page_id + pos) % 7 AS n, CASE WHEN href LIKE '/%'
  THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS link FROM links),
varied AS (SELECT page_id, pos, CASE n WHEN 0 THEN link WHEN 1 THEN link || '?b=2&a=1&&c' WHEN 2 THEN link || '?a=1&c=&b=2#part'
  WHEN 3 THEN replace(link, '.example.', '.EXAMPLE.') WHEN 4 THEN link || '?q=%e9+x%20y&q=%7e&%='
  WHEN 5 THEN regexp_replace(link, '^(https?://[^/]*)', '\1:443') ELSE link || ' é%41%2f%3F' END AS u FROM absolute),
cut AS (SELECT page_id, pos, lower(regexp_extract(u, '^([^:]*)://', 1)) AS scheme, lower(regexp_extract(u, '://([^/?#]*)', 1)) AS host,
  array_to_string(list_transform(regexp_extract_all(regexp_extract(u, '://[^/?#]*([^#]*)', 1), '(?s)%[0-9A-Fa-f]{{2}}|.'), lambda c:
    CASE WHEN regexp_full_match(c, '%[0-9A-Fa-f]{{2}}') THEN
      CASE WHEN regexp_full_match({CHAR}, '[A-Za-z0-9._~-]') THEN {CHAR} ELSE upper(c) END
    WHEN regexp_full_match(c, '[A-Za-z0-9._~/!$&''()*+,;=:@?-]') THEN c ELSE url_encode(c) END), '') AS tail FROM varied),
formed AS (SELECT page_id, pos, scheme || '://' ||
    CASE WHEN scheme = 'https' THEN regexp_replace(host, ':443$', '') ELSE host END ||
    CASE WHEN tail = '' OR tail LIKE '?%' THEN '/' ELSE '' END || string_split(tail, '?')[1] AS place,
  list_sort(list_transform(list_filter(string_split(replace(regexp_extract(tail, '\?(.*)', 1), '%20', '+'), '&'), lambda q: q <> ''),
    lambda q: CASE WHEN contains(q, '=') THEN q ELSE q || '=' END)) AS pairs FROM cut),
requests AS (SELECT page_id, pos, place || CASE WHEN len(pairs) = 0 THEN '' ELSE '?' || array_to_string(pairs, '&') END AS request FROM formed)"""

SECOND, THIRD = (f"'{(RUN_TS + n * DAY).isoformat()}'" for n in (1, 2))


def progress_rounds(rounds: int) -> str:
    """Limited runs on top of each other: what each accepts, and the archives it finishes."""
    out = [f"pool AS (SELECT *, source_file_url || coalesce('/' || member_path, '') AS key FROM rows_ WHERE pre IS NULL)"]
    for n in range(rounds):
        gone = "".join(f" AND key NOT IN (SELECT key FROM accepted{i})" for i in range(n)) + "".join(
            f" AND source_file_url NOT IN (SELECT zip_url FROM done{i})" for i in range(n))
        known = " UNION ".join(["SELECT key FROM seen_in WHERE kind = 'documents'", *(f"SELECT key FROM accepted{i}" for i in range(n + 1))])
        out.append(f"accepted{n} AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY crawl_seq, member_path NULLS FIRST) AS r "
                   f"FROM pool WHERE true{gone}) WHERE r <= {LIMIT} AND category IS NOT NULL)")
        out.append(f"done{n} AS (SELECT zip_url FROM members_in WHERE {Q.file_ext('member_path')} IN ({Q._EXTS}) "
                   f"AND zip_url IN (SELECT source_file_url FROM accepted{n} WHERE file_from_zip) GROUP BY zip_url "
                   f"HAVING bool_and(zip_url || '/' || member_path IN ({known})))")
    return ",\n".join(out)


ORACLE: dict[str, str] = {
    "scan_pages": "SELECT page_id, url, html FROM pages",
    "scan_file_headers": docs("SELECT * FROM headers_in", Q.HEADERS),
    "zip_members": with_(
        "lines AS (SELECT DISTINCT l_orderkey, l_partkey // 8 AS block, 'dossier_' || l_linenumber || '/piece_' || "
        "l_partkey || CASE l_partkey % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.exe' ELSE '.docx' END AS path "
        "FROM lineitem)",
        select=f"SELECT '{Q.SITE}/zip/' || l_orderkey || '-' || block || '.zip' AS zip_url, "
        "CAST(row_number() OVER (PARTITION BY l_orderkey, block ORDER BY path) - 1 AS INTEGER) AS pos, "
        "path AS member_path, CAST(length(path) AS BIGINT) AS size FROM lines",
    ),
    "load_seen_state": docs("SELECT * FROM old_state", Q.MEMBERS, Q.SEEN, OLD_STATE),
    "dim_departments": docs(
        "SELECT ord, name, code, count(*) AS n_docs FROM dim_departments JOIN "
        f"(SELECT {CODE_OF_LABEL} AS code FROM docs_base) USING (code) GROUP BY ALL", Q.DIM_DEPARTMENTS),
    "dim_regions": docs(
        "SELECT ord, name, count(*) AS n_docs FROM dim_regions JOIN "
        f"(SELECT {CODE_OF_LABEL} AS code FROM docs_base) ON list_contains(string_split(codes, ','), code) "
        "GROUP BY ALL", Q.DIM_REGIONS),
    "items_feed": on_all(
        f"SELECT title, project, project_id, authority, category, category_local, '{PARAMS.source_scraper}' AS source_scraper, "
        "source_file_url, source_filename, source_page_url, publication_date, publication_time, "
        "publication_datetime, publication_datetime_dcformat, publication_lastmodified, year, "
        "CAST(file_from_zip AS VARCHAR) AS file_from_zip, event_data_key, source_file_zip_path, "
        "departments, departments_sources, department_from_scraper FROM accepted"),
    "seen_state_json": docs(
        "SELECT kind, key, '{\"' || kind || '\":{' || CAST(to_json(key) AS VARCHAR) || "
        "':{\"last_modified\":\"' || last_modified || '\",\"last_seen\":\"' || last_seen || "
        "'\",\"target_year\":\"' || target_year || '\"}}}' AS value FROM old_state",
        Q.MEMBERS, Q.SEEN, OLD_STATE),
    "publish_records": on_all(
        "SELECT crawl_seq, CASE WHEN file_from_zip THEN member_path ELSE source_file_url END AS file_path, "
        f"ltrim({Q.file_ext('source_filename')}, '.') AS original_extension, '{PARAMS.project}' AS project, title, "
        f"project AS description, publication_datetime_dcformat AS publish_at, '{PARAMS.source_host}' AS source, "
        f"'fra' AS language, 'public' AS access, {DATA} AS data, year FROM accepted"),
    "run_report": on_plain(
        f"SELECT '{PARAMS.scraper_name} 1995-2001 (New: ' || count(*) || ') [weekly]' AS subject, "
        f"'{PARAMS.scraper_name} Run r-1' || chr(10) || chr(10) || 'SCRAPED ITEMS (' || count(*) || ')' AS heading, "
        "count(*) AS n_items FROM accepted"),
    "department_links": with_(
        "m AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation)",
        select=f"SELECT '{Q.SITE}/accueil.html' AS url, CAST(pos AS INTEGER) AS pos, ' ' || {Q.department_label()} AS department, "
        f"'departement-' || n_nationkey || '.html' AS href, {DEPARTMENT_URL} AS abs_url FROM m"),
    "year_sections": with_(SECTIONS, select=(
        f"SELECT {DEPARTMENT_URL.replace('n_nationkey', 'd')} AS url, y AS block_pos, "
        "CASE WHEN d % 2 = 0 THEN CAST(2022 + y AS VARCHAR) ELSE 'Année ' || (2022 + y) END AS section_title, "
        "CASE WHEN d % 2 = 0 THEN 'Semestre ' || (s + 1) ELSE '' END AS subdiv, "
        f"{Q.list_url(p='0')} AS href, {Q.list_url(p='0')} AS abs_url FROM sections")),
    "project_links": site(
        f"SELECT {LIST} AS url, CAST(card AS INTEGER) AS pos, 'Projet ' || k AS text, 'projet-' || k || '.html#top' AS href, "
        f"{PROJECT_URL} || '#top' AS abs_url FROM placed"),
    "next_page_links": site(
        f"SELECT {LIST} AS url, {Q.list_url(p='(p + 1)')} AS href, {Q.list_url(p='(p + 1)')} AS abs_url "
        "FROM lists_ WHERE p < last"),
    "breadcrumb_year": site(f"SELECT {LIST} AS url, CAST(2022 + y AS VARCHAR) AS year FROM lists_"),
    "page_titles": site(f"SELECT {PROJECT_URL} AS url, {Q.project_title()} AS project FROM projects_"),
    "download_links": site(
        f"SELECT {PROJECT_URL} AS url, CAST(pos AS INTEGER) AS pos, title, href, abs_url FROM files_"),
    "resolve_urls": with_(
        """links AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos FROM pages)""",
        select="SELECT page_id, CAST(pos AS INTEGER) AS pos, href, CASE WHEN href LIKE '/%' "
        "THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS abs_url FROM links"),
    "department_codes": docs(f"SELECT crawl_seq, {CODE_OF_LABEL} AS code FROM docs_base"),
    "follow_links": site(
        f"SELECT {LIST} AS list_url, CAST(card AS INTEGER) AS pos, {PROJECT_URL} || '#top' AS abs_url, "
        f"{PROJECT_URL} AS url, {Q.project_title()} AS project FROM placed"),
    "paginate": site(
        f"SELECT {Q.list_url(p='0')} AS start_url, {LIST} AS url, CAST(p + 1 AS BIGINT) AS page FROM "
        "(SELECT d, y, s, p FROM lists_ UNION SELECT d, y, s, 0 FROM sections)", SECTIONS),
    "walk_to_files": site(
        f"SELECT ' ' || {Q.department_label()} AS department, CAST(2022 + y AS VARCHAR) AS year, "
        "CASE WHEN d % 2 = 0 THEN 'Semestre ' || (s + 1) ELSE '' END AS subdiv, CAST(p + 1 AS BIGINT) AS page, "
        f"{Q.project_title('k')} AS project, {PROJECT_URL} || '#top' AS source_page_url, title, abs_url AS source_file_url "
        "FROM placed JOIN nation ON n_nationkey = d JOIN files_ USING (k) WHERE y < 2"),
    "frontier": site(
        "SELECT DISTINCT url FROM (SELECT abs_url AS url FROM files_ UNION ALL "
        f"SELECT {Q.list_url(p='0')} FROM sections ANTI JOIN placed USING (d, y, s))", SECTIONS),
    "with_headers": docs(
        "SELECT crawl_seq, final_url AS source_file_url, last_modified AS publication_lastmodified "
        "FROM docs_base JOIN headers_in ON request_url = source_file_url", Q.HEADERS),
    "not_seen_links": docs(
        "SELECT crawl_seq, source_file_url FROM docs_base WHERE source_file_url NOT IN (SELECT key FROM seen_in)",
        Q.MEMBERS, Q.SEEN),
    "not_seen_final": docs(
        f"SELECT crawl_seq, source_file_url FROM docs_base WHERE ({IS_ZIP} AND source_file_url NOT IN "
        f"(SELECT key FROM seen_in WHERE kind = 'zips')) OR (NOT {IS_ZIP} AND source_file_url NOT IN "
        "(SELECT key FROM seen_in WHERE kind = 'documents'))", Q.MEMBERS, Q.SEEN),
    "not_seen_members": docs(
        "SELECT zip_url, member_path FROM members_in WHERE zip_url || '/' || member_path NOT IN "
        "(SELECT key FROM seen_in WHERE kind = 'documents')", Q.MEMBERS, Q.SEEN),
    "expand_zip_docs": docs(
        "SELECT crawl_seq, project, category_local, authority, source_page_url, source_file_url, "
        "publication_lastmodified, year, department_label, true AS file_from_zip, "
        "regexp_extract(member_path, '[^/]*$') AS source_filename, member_path "
        "FROM members_in JOIN docs_base ON zip_url = source_file_url", Q.MEMBERS),
    "target_years": docs(
        "SELECT crawl_seq, publication_lastmodified FROM docs_base "
        "WHERE regexp_matches(publication_lastmodified, '1996|1997|1998')"),
    "route_zip": docs(
        f"SELECT crawl_seq, source_file_url, CASE WHEN {IS_ZIP} THEN 'zip' ELSE 'file' END AS route FROM docs_base"),
    "supported_filetypes": docs(
        f"SELECT crawl_seq, {Q.url_basename('source_file_url')} AS source_filename, "
        f"CASE WHEN {Q.file_ext(Q.url_basename('source_file_url'))} NOT IN ({Q._EXTS}) "
        "THEN 'Unsupported filetype' END AS reason FROM docs_base"),
    "upload_limit": limited(LIMIT),
    "upload_limit_large": limited(LARGE_LIMIT),
    "dedupe_requests": docs(
        "SELECT source_page_url, min(crawl_seq) AS crawl_seq, arg_min(source_file_url, crawl_seq) AS source_file_url "
        "FROM docs_base GROUP BY source_page_url"),
    "quarantine": docs(
        "SELECT crawl_seq, member_path, reason FROM rows_", Q.MEMBERS, ALL_ROWS, Q.classified("all_rows")),
    "parse_http_date": docs(
        "SELECT crawl_seq, publication_lastmodified, strftime(ts, '%Y-%m-%d') AS publication_date, "
        "strftime(ts, '%H:%M:%S UTC') AS publication_time, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS publication_datetime, "
        "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS publication_datetime_dcformat FROM docs_base"),
    "iso_last_modified": docs(f"SELECT crawl_seq, {ISO} AS last_modified FROM docs_base"),
    "categorize": docs(
        "SELECT crawl_seq, CASE WHEN category_local ILIKE '%cas par cas%' THEN 'Cas par cas' END AS category FROM docs_base"),
    "source_filename": docs(f"SELECT crawl_seq, {Q.url_basename('source_file_url')} AS source_filename FROM docs_base"),
    "clean_project": docs(f"SELECT crawl_seq, {Q.clean_project('project')} AS project FROM docs_base"),
    "clean_title": docs(f"SELECT crawl_seq, {Q.clean_title('title')} AS title FROM docs_base"),
    "file_ext": docs(f"SELECT crawl_seq, {Q.file_ext(Q.url_basename('source_file_url'))} AS ext FROM docs_base"),
    "zip_titles": docs(f"SELECT zip_url, member_path, {Q.zip_title('member_path')} AS title FROM members_in", Q.MEMBERS),
    "project_id": docs(
        f"SELECT crawl_seq, sha256(source_page_url || ' ' || {Q.clean_project('project')}) AS project_id FROM docs_base"),
    "event_keys": docs(
        "SELECT crawl_seq, member_path, source_file_url || coalesce('/' || member_path, '') AS event_data_key, "
        "member_path AS source_file_zip_path FROM all_rows", Q.MEMBERS, ALL_ROWS),
    "data_payload": on_all(f"SELECT crawl_seq, member_path, {DATA} AS data FROM accepted"),
    "year_label": docs(
        "SELECT source_page_url, CASE WHEN min(year) = max(year) THEN min(year) ELSE min(year) || '-' || max(year) END AS label "
        "FROM docs_base GROUP BY source_page_url"),
    "original_ext": docs(
        f"SELECT crawl_seq, ltrim({Q.file_ext(Q.url_basename('source_file_url'))}, '.') AS ext FROM docs_base"),
    "constant_columns": docs(
        f"SELECT crawl_seq, title, {Q.quote(PARAMS.authority)} AS authority, "
        f"{Q.quote(PARAMS.category_local)} AS category_local, '{PARAMS.source_scraper}' AS source_scraper FROM docs_base"),
    "dept_from_authority": docs(
        f"SELECT crawl_seq, {Q.AUTHORITY_CODE.format(x='authority')} AS code FROM docs_base", Q.DIM_AUTHORITY),
    "dept_numbers": project_codes("numbers"),
    "dept_names": project_codes("list_sort(names)"),
    "dept_regions": project_codes("list_sort(regions)"),
    "depts_from_project": project_codes("found"),
    "tag_departments": with_(
        Q.DOCS, Q.DOCS.replace("docs_base AS", "_unused AS"),
        f"rows_ AS (SELECT crawl_seq, CAST(NULL AS VARCHAR) AS member_path, false AS file_from_zip, {Q.clean_project('project')} AS project, "
        f"title, source_page_url, source_file_url, '' AS source_filename, publication_lastmodified, ts, authority, "
        f"'' AS category, category_local, year, {CODE_OF_LABEL} AS department_from_scraper, "
        f"CASE WHEN {CODE_OF_LABEL} IS NULL THEN 'x' END AS reason FROM docs_base)",
        Q.tagged("rows_"), Q.ACCEPTED,
        select="SELECT crawl_seq, departments, departments_sources FROM accepted"),
    "zip_supported_files": docs(
        "SELECT zip_url, array_to_string(list(member_path ORDER BY member_path), ',') AS supported_files FROM members_in "
        f"WHERE {Q.file_ext('member_path')} IN ({Q._EXTS}) GROUP BY zip_url", Q.MEMBERS),
    "complete_zips": on_new("SELECT zip_url FROM complete", COMPLETE),
    "run_counts": on_new(
        "SELECT kind AS name, count(*) AS n FROM seen_in GROUP BY kind UNION ALL SELECT 'new', count(*) FROM accepted"),
    "report_items": on_plain(f"SELECT crawl_seq, {ITEM} AS item_text FROM accepted"),
    "drop_counts": docs(
        "SELECT reason, count(*) AS n, reason = 'Upload limit exceeded.' AS quiet FROM rows_ WHERE reason IS NOT NULL GROUP BY reason",
        Q.MEMBERS, Q.SEEN, NEW_ROWS, Q.classified("new_rows", LIMIT)),
    "upsert_documents": accepted(
        "all_rows", upsert("documents"), COMPLETE, NEW_STATE, OLD_STATE, ctes=(Q.MEMBERS, Q.SEEN, ALL_ROWS)),
    "upsert_zips": on_new(upsert("zips"), COMPLETE, NEW_STATE, OLD_STATE),
    "resolve_project": """WITH asked AS (SELECT DISTINCT CASE o_orderkey % 3
    WHEN 0 THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
    WHEN 1 THEN CAST(o_custkey AS VARCHAR) ELSE 'Nouveau projet ' || o_custkey END AS project FROM orders),
known AS (SELECT c_name AS project, min(c_custkey) AS id FROM customer GROUP BY c_name),
found AS (SELECT project, coalesce(try_cast(project AS BIGINT), id) AS id FROM asked LEFT JOIN known USING (project)),
created AS (SELECT project, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY project) AS id
  FROM found WHERE id IS NULL)
SELECT project, id AS project_ref, false AS created FROM found WHERE id IS NOT NULL
UNION ALL SELECT project, id, true FROM created""",
    "document_records": on_plain(
        "SELECT crawl_seq, title, project, project_id, authority, category, category_local, source_filename, source_file_url, "
        "source_page_url, publication_datetime_dcformat, year, departments, departments_sources FROM accepted"),
    "monitor_run": on_new(
        "SELECT * FROM old_state UNION ALL SELECT * FROM new_state", COMPLETE, NEW_STATE, OLD_STATE),
    "site_run": on_site(
        "SELECT CAST(0 AS BIGINT) AS batch, event_data_key, project_id, title, source_page_url, department_from_scraper, year FROM accepted"),
    "site_run_limited": on_site("SELECT event_data_key, title FROM accepted", LIMIT),
    "walk_drops": site("SELECT url, reason FROM lost_rows", SECTIONS, SITE_WALK),
    "run_metrics": on_site(
        "SELECT reason AS name, count(*) AS n FROM (SELECT reason FROM rows_ UNION ALL SELECT reason FROM lost_rows) "
        "WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 'accepted', count(*) FROM accepted", LIMIT),
    "request_identity": with_(
        REQUESTS, select="SELECT request, page_id, CAST(pos AS INTEGER) AS pos, count(*) OVER (PARTITION BY request) AS links "
        "FROM requests QUALIFY row_number() OVER (PARTITION BY request ORDER BY page_id, pos) = 1"),
    "project_registry": """WITH asked AS (SELECT DISTINCT CASE o_orderkey % 3
    WHEN 0 THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
    WHEN 1 THEN CAST(o_custkey AS VARCHAR) ELSE 'Nouveau projet ' || o_custkey END AS project FROM orders),
known AS (SELECT c_name AS project, min(c_custkey) AS id FROM customer GROUP BY c_name),
found AS (SELECT project, coalesce(try_cast(project AS BIGINT), id) AS id FROM asked LEFT JOIN known USING (project)),
created AS (SELECT project, late AS allocation, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY late, project) AS id
  FROM (SELECT project, CAST(length(project) % 2 AS BIGINT) AS late FROM found WHERE id IS NULL))
SELECT project, id AS project_ref, false AS created, CAST(NULL AS BIGINT) AS allocation FROM found WHERE id IS NOT NULL
UNION ALL SELECT project, id, allocation = 1, allocation FROM created""",
    "seen_as_of": on_new(
        f"""SELECT *, 0 AS runs FROM old_state UNION ALL SELECT *, 1 FROM old_state UNION ALL SELECT *, 2 FROM old_state
UNION ALL SELECT kind, key, last_modified, {SECOND}, target_year, 1 FROM added WHERE crawl_seq % 4 < 2
UNION ALL SELECT kind, key, last_modified, CASE WHEN crawl_seq % 4 < 2 THEN {SECOND} ELSE {THIRD} END, target_year, 2 FROM added""",
        COMPLETE, OLD_STATE, f"""added AS (
  SELECT 'documents' AS kind, event_data_key AS key, {ISO} AS last_modified, year AS target_year, crawl_seq FROM accepted
  UNION ALL SELECT DISTINCT 'zips', source_file_url, {ISO}, year, crawl_seq FROM accepted
  WHERE file_from_zip AND source_file_url IN (SELECT zip_url FROM complete))"""),
    "zip_progress": docs(
        "SELECT key, '2001-02-03T04:05:06' AS last_seen FROM seen_in WHERE kind = 'zips'" + "".join(
            f" UNION ALL SELECT zip_url, '{(RUN_TS + (n + 1) * DAY).isoformat()}' FROM done{n}" for n in range(3)),
        Q.MEMBERS, Q.SEEN, NEW_ROWS, Q.classified("new_rows").replace("FROM judged)", "FROM judged)"), progress_rounds(3)),
    "published_after_run": on_new("SELECT CAST(0 AS BIGINT) AS batch, event_data_key, project_id FROM accepted"),
}
ORACLE["monitor_stream"] = ORACLE["monitor_run"]
ORACLE["monitor_mixed"] = ORACLE["monitor_run"]
ORACLE["tag_departments"] = ORACLE["tag_departments"].replace(Q.DOCS.replace("docs_base AS", "_unused AS") + ",\n", "")
