"""The derived views in SQL (independent of the Spark side), as WITH entries."""

from __future__ import annotations

from docmonitor import reference_data as ref

SITE = "https://docs.example.org"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DIM_DEPARTMENTS = "dim_departments(ord, name, code) AS (VALUES " + ", ".join(
    f"({i}, {quote(n)}, '{c}')" for i, (n, c) in enumerate(ref.DEPARTMENTS.items())
) + ")"
DIM_AUTHORITY = "dim_authority(ord, keyword, code) AS (VALUES " + ", ".join(
    f"({i}, {quote(n)}, '{c}')" for i, (n, c) in enumerate(ref.AUTHORITIES.items())
) + ")"
DIM_REGIONS = "dim_regions(ord, name, codes) AS (VALUES " + ", ".join(
    f"({i}, {quote(n)}, '{','.join(c)}')" for i, (n, c) in enumerate(ref.REGIONS.items())
) + ")"

DOCS = f"""docs_base AS (SELECT
  o_orderkey AS crawl_seq,
  'avis_ae_' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '. ' ELSE '.,' END AS title,
  CASE o_orderkey % 6
    WHEN 0 THEN '  parc solaire ' || o_orderkey || ' (' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || ').,'
    WHEN 1 THEN 'zone d’activité ' || o_orderkey || ' (' || CASE o_custkey % 4 WHEN 0 THEN 'Ain' WHEN 1 THEN 'haute savoie' WHEN 2 THEN 'Corse-du-Sud' ELSE 'RHÔNE' END || ')'
    WHEN 2 THEN 'plan climat région ' || CASE o_custkey % 3 WHEN 0 THEN 'Bretagne' WHEN 1 THEN 'Île-de-France' ELSE 'Pays de la Loire' END || ' phase ' || o_orderkey
    WHEN 3 THEN 'Lyon (69) : tramway ' || o_orderkey
    WHEN 4 THEN 'ligne ' || o_orderkey || ' (07, 26+2A et 38)'
    ELSE 'étude n° ' || o_orderkey || ' .' END AS project,
  '{SITE}/projets-r' || o_custkey || '.html' AS source_page_url,
  '{SITE}/IMG/f ' || o_orderkey || CASE o_orderkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF?v=1' WHEN 2 THEN '.zip' WHEN 3 THEN '.exe' ELSE '.tar.docx;p=1' END AS source_file_url,
  CASE WHEN o_totalprice < 5000 THEN 'inconnue' ELSE strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' GMT' END AS publication_lastmodified,
  CASE WHEN o_totalprice < 5000 THEN NULL ELSE o_orderdate END AS ts,
  CASE o_orderkey % 7 WHEN 0 THEN 'Préfet de Mayotte et Guyane' WHEN 1 THEN 'Préfète de La Réunion' ELSE 'Préfecture de région' END AS authority,
  CASE WHEN o_orderkey % 9 = 0 THEN 'Autres avis' ELSE 'Décisions au CAS PAR CAS' END AS category_local,
  CAST(year(o_orderdate) AS VARCHAR) AS year,
  CASE WHEN o_custkey % 11 = 0 THEN 'Corse (2A)' ELSE 'Département (' || lpad(CAST(o_custkey % 95 + 1 AS VARCHAR), 2, '0') || ')' END AS department_label,
  o_orderstatus AS status, o_orderpriority AS priority
FROM orders)"""

MEMBERS = """members_in AS (
  SELECT DISTINCT d.source_file_url AS zip_url,
    'dossier_' || l_linenumber || '/piece_' || l_partkey ||
      CASE l_partkey % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.exe' ELSE '.docx' END AS member_path
  FROM lineitem JOIN docs_base d ON l_orderkey = d.crawl_seq
  WHERE lower(d.source_file_url) LIKE '%.zip')"""

SEEN = """seen_in AS (
  SELECT CASE WHEN lower(source_file_url) LIKE '%.zip' THEN 'zips' ELSE 'documents' END AS kind, source_file_url AS key
  FROM docs_base WHERE status = 'F'
  UNION ALL
  SELECT 'documents', zip_url || '/' || member_path FROM members_in WHERE member_path LIKE 'dossier_1/%')"""

HEADERS = f"""headers_in AS (SELECT source_file_url AS request_url,
  CASE WHEN priority LIKE '1%' THEN replace(source_file_url, '{SITE}', 'https://files.example.org') ELSE source_file_url END AS final_url,
  publication_lastmodified AS last_modified FROM docs_base)"""

# -- cleaning, as the rules read ----------------------------------------------------
_WS = quote("".join(c for c in ref.WHITESPACE if c != "\x00"))
_EXTS = ", ".join(f"'{e}'" for e in ref.DEFAULT_EXTENSIONS)


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def first_upper(x: str) -> str:
    return f"(upper(left({x}, 1)) || substr({x}, 2))"


def clean_project(x: str) -> str:
    inner = f"rtrim(replace(replace({strip(x)}, chr(160), ' '), '’', ''''), '.,')"
    swapped = rf"regexp_replace({inner}, '(.*? \(\d\d\)) : (.*)', '\2 - \1', 'g')"
    return first_upper(strip(swapped))


def clean_title(x: str) -> str:
    inner = f"rtrim(replace({x}, '_', ' '), '.,')"
    return first_upper(strip(inner))


def url_basename(x: str) -> str:
    path = f"regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    return f"regexp_extract({path}, '([^/;]*)(;[^/]*)?$', 1)"


def file_ext(x: str) -> str:
    return rf"lower(regexp_extract({x}, '(?s)^\.*[^.].*(\.[^.]*)$', 1))"


def zip_title(x: str) -> str:
    base = f"regexp_extract({x}, '[^/]*$')"
    stem = f"left({x}, length({x}) - length({file_ext(base)}))"
    return f"array_to_string(string_split({stem}, '/'), ' - ')"


AUTHORITY_CODE = (
    "coalesce((SELECT arg_max(a.code, a.ord) FROM dim_authority a WHERE contains({x}, a.keyword)), '')"
)

CODE_GROUP = r"\(([A-B0-9 \-,;/+]+(?: et[A-B0-9 \-,;/]+)?)\)"
CODE = r"\b([02][1-9]|2[AB]|[1345678][0-9]|9[012345]|97[1-8])\b"


def numbers(x: str) -> str:
    return (
        f"flatten(list_transform(regexp_extract_all({x}, '{CODE_GROUP}', 1), "
        f"lambda m: regexp_extract_all(replace(m, '+', ' '), '{CODE}', 1)))"
    )


def tagged(docs: str) -> str:
    """``tags(crawl_seq, member_path, project, numbers, names, regions, found)`` of cleaned rows."""
    return rf"""{DIM_DEPARTMENTS}, {DIM_AUTHORITY}, {DIM_REGIONS},
projects AS (SELECT DISTINCT project FROM {docs}),
by_name AS (SELECT project, list(DISTINCT code) AS names FROM projects JOIN dim_departments
  ON contains(lower(project), '(' || lower(name) || ')')
  OR suffix(lower(project), '(' || replace(lower(name), '-', ' ') || ')') GROUP BY project),
by_region AS (SELECT project, list(DISTINCT code) AS regions FROM (
  SELECT project, unnest(string_split(codes, ',')) AS code FROM projects JOIN dim_regions
  ON CASE WHEN contains(lower(project), 'région ' || lower(name)) OR contains(lower(project), 'région ' || replace(lower(name), '-', ' '))
    THEN regexp_matches(project, '(?i)\brégion (' || name || '|' || replace(name, '-', ' ') || ')\b') ELSE false END) GROUP BY project),
tags AS (SELECT p.project, {numbers('p.project')} AS numbers,
    coalesce(names, []) AS names, coalesce(regions, []) AS regions
  FROM projects p LEFT JOIN by_name USING (project) LEFT JOIN by_region USING (project)),
codes AS (SELECT *, list_sort(list_distinct(CASE WHEN len(numbers) > 0 THEN numbers
    WHEN len(names) > 0 THEN names ELSE regions END)) AS found FROM tags)"""


# Rows of documents and archive members, cleaned, with the reason they are dropped for.
def classified(source: str, limit: int = 0) -> str:
    """``rows`` from ``source(crawl_seq, member_path, ..., ts)``."""
    cut = (
        f"CASE WHEN pre IS NULL AND row_number() OVER (PARTITION BY pre IS NULL ORDER BY crawl_seq, "
        f"member_path NULLS FIRST) > {limit} THEN 'Upload limit exceeded.' END" if limit else "NULL"
    )
    return f"""cleaned AS (SELECT crawl_seq, member_path, member_path IS NOT NULL AS file_from_zip,
  {clean_project('project')} AS project,
  {clean_title('CASE WHEN member_path IS NULL THEN title ELSE ' + zip_title('member_path') + ' END')} AS title,
  source_page_url, source_file_url, publication_lastmodified, ts, authority, category_local, year,
  CASE WHEN category_local ILIKE '%cas par cas%' THEN 'Cas par cas' END AS category,
  nullif(regexp_extract(department_label, '\\((\\d\\d)\\)', 1), '') AS department_from_scraper,
  CASE WHEN member_path IS NULL THEN {url_basename('source_file_url')} ELSE regexp_extract(member_path, '[^/]*$') END AS source_filename
  FROM {source}),
judged AS (SELECT *, CASE
  WHEN department_from_scraper IS NULL THEN 'No department code'
  WHEN ts IS NULL THEN 'Bad Last-Modified'
  WHEN project = '' THEN 'Empty project'
  WHEN title = '' THEN 'Empty title'
  WHEN {file_ext('source_filename')} NOT IN ({_EXTS}) THEN 'Unsupported filetype' END AS pre FROM cleaned),
rows_ AS (SELECT *, coalesce(pre, {cut}, CASE WHEN category IS NULL THEN 'No category' END) AS reason FROM judged)"""


# Accepted rows with every derived column.
ACCEPTED = f"""accepted AS (SELECT r.crawl_seq, r.member_path, r.file_from_zip, r.project, r.title,
  r.source_page_url, r.source_file_url, r.source_filename, r.publication_lastmodified, r.ts, r.authority,
  r.category, r.category_local, r.year, r.department_from_scraper,
  strftime(ts, '%Y-%m-%d') AS publication_date,
  strftime(ts, '%H:%M:%S UTC') AS publication_time,
  strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS publication_datetime,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS publication_datetime_dcformat,
  sha256(r.source_page_url || ' ' || r.project) AS project_id,
  CASE WHEN r.member_path IS NULL THEN r.source_file_url ELSE r.source_file_url || '/' || r.member_path END AS event_data_key,
  r.member_path AS source_file_zip_path,
  {{departments}} AS departments, {{sources}} AS departments_sources
  FROM (SELECT *, {AUTHORITY_CODE.format(x='authority')} AS auth FROM rows_ WHERE reason IS NULL) r
  JOIN codes c ON c.project = r.project)""".format(
    departments="""array_to_string(list_sort(list_distinct(CASE
    WHEN auth <> '' AND auth <> department_from_scraper THEN [department_from_scraper, auth]
    WHEN len(found) > 0 AND found <> [department_from_scraper] THEN list_concat([department_from_scraper], found)
    ELSE [department_from_scraper] END)), ',')""",
    sources="""CASE WHEN auth <> '' AND auth <> department_from_scraper THEN 'scraper,authority'
    WHEN len(found) > 0 AND found <> [department_from_scraper] THEN 'scraper,regex' ELSE 'scraper' END""",
)

# -- the site ------------------------------------------------------------------------
SITE_LINKS = f"""links_ AS (SELECT o_orderkey, o_orderdate, o_orderkey // 8 AS k FROM orders),
projects_ AS (SELECT DISTINCT k, k % 25 AS d, (k // 25) % 3 AS y,
  CASE WHEN (k % 25) % 2 = 0 THEN (k // 75) % 2 ELSE 0 END AS s,
  CASE WHEN (k % 25) % 2 = 0 THEN (k // 75) // 2 ELSE k // 75 END AS i FROM links_),
placed AS (SELECT *, i // 10 AS p, row_number() OVER (PARTITION BY d, y, s, i // 10 ORDER BY i) - 1 AS card FROM projects_),
lists_ AS (SELECT d, y, s, unnest(generate_series(0, max(p))) AS p, max(p) AS last FROM placed GROUP BY d, y, s),
files_ AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o_orderkey) - 1 AS pos,
  'Avis ' || o_orderkey || ' du ' || strftime(o_orderdate, '%Y-%m-%d') AS title,
  CASE o_orderkey % 3 WHEN 0 THEN 'https://files.example.org/IMG/f ' || o_orderkey || '.pdf'
    WHEN 1 THEN '/IMG/f' || o_orderkey || '.pdf' ELSE '../IMG/./f' || o_orderkey || '.zip' END AS href,
  CASE o_orderkey % 3 WHEN 0 THEN 'https://files.example.org/IMG/f ' || o_orderkey || '.pdf'
    WHEN 1 THEN '{SITE}/IMG/f' || o_orderkey || '.pdf' ELSE '{SITE}/IMG/f' || o_orderkey || '.zip' END AS abs_url
  FROM links_)"""


def list_url(d="d", y="y", s="s", p="p") -> str:
    return (
        f"('{SITE}/liste-d' || {d} || '-a' || {y} || '-s' || {s} || '.html' || "
        f"CASE WHEN {p} > 0 THEN '?debut_page=' || {p} ELSE '' END)"
    )


def project_title(k="k") -> str:
    return f"('Projet n°' || chr(160) || {k} || ' & annexes')"


def department_label() -> str:
    return "(n_name || ' (' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || ')')"
