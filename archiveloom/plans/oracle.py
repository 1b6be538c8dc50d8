"""SQL twins of the registered queries, for DuckDB over the same tables.

The common table expressions restate the bindings of ``bindings.py``; a query names the ones
it needs.
"""

from __future__ import annotations

import re

from archiveloom import dimensions as dim
from archiveloom.operators.keywords import STOP_WORDS
from archiveloom.operators.language import FUNCTION_WORDS
from archiveloom.plans.bindings import EXTENSIONS, TYPES
from archiveloom.plans.report import REPORT_BLOCKS


def _lit(v) -> str:
    if v is None:
        return "NULL"
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_lit(v) for v in values)


def _values(columns: str, rows) -> str:
    body = ", ".join(f"({_list(r)})" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"


def _pick(key: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(values))
    return f"(CASE {key} {whens} END)"


_QDA = _list(dim.QDA_EXTENSIONS)
_PRIMARY = _list(dim.PRIMARY_DATA_EXTENSIONS)
_JUNK_NAMES = _list(dim.JUNK_FILE_NAMES)
_JUNK_EXT = _list(dim.JUNK_EXTENSIONS)
_RESULTS = _list(dim.DOWNLOAD_RESULTS)
_SECTION_TITLES = dict(dim.SECTIONS)

# the extension of a file, from columns file_type and file_name
_EXT = (
    "coalesce(nullif(ltrim(lower(trim(file_type)), '.'), ''), "
    "CASE WHEN contains(file_name, '.') THEN regexp_extract(lower(trim(file_name)), '[^.]*$') END, '')"
)
_CONTENT = f"(lower(trim(coalesce(file_name, ''))) NOT IN ({_JUNK_NAMES}) AND ext <> '' AND ext NOT IN ({_JUNK_EXT}))"
_PRIORITY = f"max(CASE WHEN {_CONTENT} THEN CASE WHEN ext IN ({_QDA}) THEN 3 WHEN ext IN ({_PRIMARY}) THEN 2 ELSE 1 END END)"
_TYPE_OF = (
    "CASE priority WHEN 3 THEN 'QDA_PROJECT' WHEN 2 THEN 'QD_PROJECT' "
    "WHEN 1 THEN 'OTHER_PROJECT' ELSE 'NOT_A_PROJECT' END"
)
_TYPE_LABEL = (
    "CASE type " + " ".join(f"WHEN {_lit(t)} THEN {_lit(label)}" for t, label in dim.TYPE_LABELS)
    + " ELSE 'No project' END"
)
_KEY = lambda c: f"nullif(trim(lower(regexp_replace(CAST({c} AS VARCHAR), '\\s+', ' ', 'g'))), '')"
_WORDS = lambda c: f"list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"

CTES: dict[str, str] = {
    "repos": _values("repository_id, label", dim.REPOSITORY_LABELS),
    "divisions": _values(
        "idx, section, code, title, label, text",
        [
            (i, s, c, t, f"{s}{c} - {c} - {t}", f"{_SECTION_TITLES[s]}. {t}")
            for i, (s, c, t) in enumerate(dim.DIVISIONS)
        ],
    ),
    "projects": f"""
        SELECT o_orderkey AS id, o_custkey % 22 + 1 AS repository_id,
               o_orderpriority || ' ' || o_orderkey AS title,
               {_pick(f'o_orderkey % {len(TYPES)}', TYPES)} AS type,
               d1.label AS primary_class, d2.label AS secondary_class
        FROM orders
        LEFT JOIN divisions d1 ON d1.idx = nullif(o_custkey % 45, 0)
        LEFT JOIN divisions d2 ON d2.idx = nullif(o_custkey % 30, 0)""",
    "files0": f"""
        SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id,
               l_orderkey AS project_id, {_pick(f'l_partkey % {len(EXTENSIONS)}', EXTENSIONS)} AS e,
               CASE WHEN l_linenumber % 4 = 0 THEN split_part(p_name, ' ', 1)
                    ELSE replace(p_name, ' ', '_') END AS stem,
               l_suppkey, l_returnflag,
               CASE WHEN l_partkey % 7 > 0 THEN l_partkey % 45 END AS class
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "files": f"""
        SELECT *, {_EXT} AS ext FROM (
          SELECT id, project_id, stem || CASE WHEN e = '' THEN '' ELSE '.' || e END AS file_name,
                 CASE l_suppkey % 3 WHEN 1 THEN '' WHEN 2 THEN '.' || e END AS file_type,
                 CASE l_returnflag WHEN 'A' THEN 'SUCCEEDED' WHEN 'N' THEN 'FAILED_LOGIN_REQUIRED'
                      ELSE 'ERROR 500' END AS status, class
          FROM files0)""",
    "people": """
        SELECT conv_id * 1000 + turn AS id, conv_id AS project_id, role || (turn % 3) AS name,
               CASE role WHEN 'user' THEN 'uploader' WHEN 'assistant' THEN 'AUTHOR' END AS role
        FROM conversations""",
    "licenses": """
        SELECT o_orderkey AS id, CAST(floor(o_orderkey / 8) AS BIGINT) AS project_id,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority || ' ' ELSE lower(o_orderpriority) END AS license
        FROM orders""",
    "labelled": """
        SELECT p.*, coalesce(r.label, 'unknown (' || p.repository_id || ')') AS repository,
               coalesce(nullif(p.primary_class, ''), 'UNCLASSIFIED') AS class_label
        FROM projects p LEFT JOIN repos r USING (repository_id)""",
    "class_counts": """
        SELECT repository, class_label AS primary_class, count(*) AS n, min(id) AS first_id
        FROM labelled GROUP BY ALL""",
    "type_counts": f"""
        SELECT repository, {_TYPE_LABEL} AS type_label, count(*) AS n FROM labelled GROUP BY ALL""",
    "file_counts": """
        SELECT l.repository, d.label AS primary_class, count(*) AS n, min(f.id) AS first_id
        FROM files f JOIN labelled l ON l.id = f.project_id JOIN divisions d ON d.idx = f.class
        GROUP BY ALL""",
    "wide_types": """
        SELECT repository, CAST(sum(n) AS BIGINT) AS total,
               CAST(coalesce(sum(n) FILTER (type_label = 'QDA'), 0) AS BIGINT) AS qda,
               CAST(coalesce(sum(n) FILTER (type_label = 'QD'), 0) AS BIGINT) AS qd,
               CAST(coalesce(sum(n) FILTER (type_label = 'Other project'), 0) AS BIGINT) AS other,
               CAST(coalesce(sum(n) FILTER (type_label = 'No project'), 0) AS BIGINT) AS no_project
        FROM type_counts GROUP BY repository""",
    "facts": """
        SELECT repository, CAST(sum(n) AS BIGINT) AS total, count(*) AS classes,
               CAST(coalesce(sum(n) FILTER (primary_class = 'UNCLASSIFIED'), 0) AS BIGINT) AS unclassified,
               first(primary_class ORDER BY n DESC, first_id) AS top_label, max(n) AS top_n,
               round(max(n) * 100.0::DOUBLE / sum(n), 6) AS top_share,
               round(coalesce(sum(n) FILTER (primary_class = 'UNCLASSIFIED'), 0) * 100.0::DOUBLE / sum(n), 6)
                 AS unclassified_share
        FROM class_counts GROUP BY repository""",
    "type_shares": """
        SELECT *, round(qda * 100.0::DOUBLE / total, 6) AS qda_share, round(qd * 100.0::DOUBLE / total, 6) AS qd_share,
               round(other * 100.0::DOUBLE / total, 6) AS other_share,
               round(no_project * 100.0::DOUBLE / total, 6) AS no_project_share
        FROM wide_types""",
    "scoped": """
        SELECT repository, 'all' AS scope, primary_class, n, first_id FROM class_counts
        UNION ALL
        SELECT repository, CASE type WHEN 'QDA_PROJECT' THEN 'qda' ELSE 'qd' END, class_label, count(*), min(id)
        FROM labelled WHERE type IN ('QDA_PROJECT', 'QD_PROJECT') GROUP BY ALL""",
    "rank_tables": """
        SELECT repository, scope, primary_class, n,
               row_number() OVER (PARTITION BY repository, scope ORDER BY n DESC, first_id) AS rank
        FROM scoped QUALIFY rank <= 20""",
    "file_ranks": """
        SELECT repository, 'files' AS scope, primary_class, n,
               row_number() OVER (PARTITION BY repository ORDER BY n DESC, first_id) AS rank
        FROM file_counts""",
    "class_ranks": """
        SELECT *, row_number() OVER (PARTITION BY repository ORDER BY n DESC, first_id) AS rank FROM class_counts""",
    "class_fold": """
        SELECT repository, least(rank, 8) AS slice,
               CASE WHEN rank <= 7 THEN primary_class ELSE 'Other' END AS primary_class,
               CAST(sum(n) AS BIGINT) AS n
        FROM class_ranks GROUP BY ALL""",
    "type_slots": """
        SELECT repository, u.label, u.n, row_number() OVER (PARTITION BY repository ORDER BY u.n DESC, u.place) AS slice
        FROM (SELECT repository, unnest([
                {'place': 1, 'label': 'QDA', 'n': qda}, {'place': 2, 'label': 'QD', 'n': qd},
                {'place': 3, 'label': 'Other project', 'n': other}, {'place': 4, 'label': 'No project', 'n': no_project}
              ]) AS u FROM wide_types)""",
    "harvested": f"""
        SELECT d.doc_id, d.lang, d.text, p.url, CAST(substr(d.source, 4) AS BIGINT) + 1 AS repository_id,
               CASE WHEN d.doc_id % 5 <> 0 THEN '10.5072/' || md5(d.text) END AS doi,
               split_part(d.text, chr(10), 1) AS title,
               {_pick('d.doc_id % 6', ('API', 'api', 'SCRAPING', 'API-CALL', 'x', None))} AS method,
               CASE WHEN d.doc_id % 11 <> 0 THEN '2024-05-01T00:00:00' END AS download_date
        FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id""",
    "source_list": _values(
        "source_name, source_rank, lang, mirror",
        [
            (name, rank, name[-2:], int(name.startswith("mirror")))
            for rank, name in enumerate(
                ["a_list", "de", "en", "es", "fr", "mirror_de", "mirror_en", "mirror_es", "mirror_fr"]
            )
            if name != "a_list"
        ],
    ),
    "records": """
        SELECT (s.source_rank::BIGINT << 52) + h.doc_id AS ord, s.source_name, s.source_rank::BIGINT AS source_rank,
               h.doc_id AS local_id, NULL::VARCHAR AS query_string, NULL::VARCHAR AS language,
               CASE WHEN mirror = 0 OR h.doc_id % 2 = 1 THEN repository_id END AS repository_id,
               CASE WHEN mirror = 0 THEN url WHEN url IS NOT NULL THEN ' ' || upper(url) || '/'
                    WHEN h.doc_id % 4 = 0 THEN '' END AS project_url,
               CASE WHEN mirror = 0 THEN title
                    ELSE translate(title, 'abcdefghijklm', 'ABCDEFGHIJKLM') || '  ' END AS title,
               CASE WHEN mirror = 0 THEN text END AS description,
               CASE WHEN mirror = 0 THEN doi WHEN h.doc_id % 4 = 1 THEN upper(doi) END AS doi,
               CASE WHEN mirror = 0 THEN method END AS download_method,
               CASE WHEN mirror = 0 THEN download_date END AS download_date
        FROM harvested h JOIN source_list s ON s.lang = h.lang""",
    "keywords": """
        SELECT doc_id * 1000000 + pos - 1 AS id, doc_id AS project_id, keyword, lang
        FROM (SELECT doc_id, lang, unnest(words) AS keyword, generate_subscripts(words, 1) AS pos
              FROM (SELECT doc_id, lang, regexp_split_to_array(text, '\\s+') AS words FROM documents))""",
    "keyed": f"""
        SELECT *, nullif(lower(rtrim(trim(project_url), '/')), '') AS url_key, nullif(lower(trim(doi)), '') AS doi_key,
               {_KEY('title')} AS title_key
        FROM records""",
    "by_document": "SELECT local_id, min(ord) AS label, count(*) AS members FROM records GROUP BY local_id",
    "fragments": """
        SELECT doc_id AS project_id, 1 AS kind, 0 AS seq, source AS text FROM documents WHERE source <> 'src4'
        UNION ALL SELECT doc_id, 2, 0, text FROM documents
        UNION ALL SELECT project_id, 3, id, keyword FROM keywords
        UNION ALL SELECT conv_id, 4, turn, role FROM conversations""",
    "tokens": f"SELECT doc_id, unnest({_WORDS('text')}) AS word FROM documents",
    "terms": f"""
        SELECT doc_id, word, count(*) AS tf FROM tokens
        WHERE length(word) >= 2 AND word NOT IN ({_list(STOP_WORDS)}) GROUP BY ALL""",
    "used": "SELECT d.idx, d.section, d.text, count(o_orderkey) AS n FROM divisions d LEFT JOIN orders ON o_custkey % 87 = d.idx GROUP BY ALL",
    "landed": """
        SELECT doc_id AS record_id, *, md5(text) AS key, regexp_split_to_array(text, '\\s+') AS words,
               (doc_id % 5 + 1) || '.' || (doc_id % 3) AS version
        FROM documents WHERE doc_id % 10 NOT IN (3, 5)""",
    "detected": "",
}


def _votes(lang: str) -> str:
    return f"len(list_filter(words, lambda w: list_contains([{_list(FUNCTION_WORDS[lang])}], w)))"


CTES["detected"] = f"""
    SELECT doc_id, lang, text,
           CASE WHEN greatest(de, en, es, fr) = 0 THEN NULL WHEN de >= greatest(en, es, fr) THEN 'de'
                WHEN en >= greatest(es, fr) THEN 'en' WHEN es >= fr THEN 'es' ELSE 'fr' END AS detected
    FROM (SELECT *, {_votes('de')} AS de, {_votes('en')} AS en, {_votes('es')} AS es, {_votes('fr')} AS fr
          FROM (SELECT doc_id, lang, text, {_WORDS('text')} AS words FROM documents))"""


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the table expressions it uses, in order of definition."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(sql)
    parts = [f"{n} AS ({sql})" for n, sql in CTES.items() if n in needed]
    if not parts:
        return body
    recursive = "RECURSIVE " if body.lstrip().startswith("RECURSIVE") else ""
    body = body.lstrip().removeprefix("RECURSIVE")
    glue = "," if recursive else ""
    return f"WITH {recursive}" + ", ".join(parts) + glue + " " + body


SQL: dict[str, str] = {
    "multi_source_scan": "SELECT source_name, source_rank, local_id, ord FROM records",
    "scan_by_signature": "SELECT source_name, source_rank, local_id, ord FROM records",
    "resolve_sources": """
        SELECT 'projects' AS entity, source_name, count(*) AS n FROM records GROUP BY source_name
        UNION ALL
        SELECT 'keywords', s.source_name, count(*) FROM keywords k JOIN source_list s ON s.lang = k.lang
        WHERE s.lang <> 'fr' GROUP BY s.source_name""",
    "harmonise_schema": """
        SELECT ord, source_name, repository_id, project_url, title, description, doi, download_date,
               download_method, query_string, language FROM records""",
    "attach_children": """
        SELECT a.label, (s.source_rank::BIGINT << 52) + k.id AS ord, k.keyword
        FROM keywords k JOIN source_list s ON s.lang = k.lang
        JOIN (SELECT ord, min(ord) OVER (PARTITION BY length(title)) AS label FROM records WHERE source_name <> 'es') a
          ON a.ord = (s.source_rank::BIGINT << 52) + k.project_id
        WHERE s.lang <> 'fr'""",
    "unwrap_hits": """
        SELECT doc_id, hit_no, lookup_id,
               CASE WHEN (doc_id + hit_no) % 3 = 0 THEN CAST(doc_id * 10 + hit_no AS VARCHAR) ELSE lookup_id END AS target,
               text AS name
        FROM (SELECT doc_id, text, hit_no, CASE WHEN (doc_id + hit_no) % 3 = 0 THEN 'doi:' || hit_no || '/' || doc_id
                     ELSE 'ID' || hit_no || '-' || doc_id END AS lookup_id
              FROM (SELECT doc_id, text, unnest([0, 1])::BIGINT AS hit_no FROM documents WHERE doc_id % 7 <> 0))""",
    "parse_dataverse_projects": """
        SELECT record_id, l.lang AS query_string, CASE WHEN source = 'src3' THEN 18 ELSE 10 END::BIGINT AS repository_id,
               CASE WHEN source = 'src3' THEN 'https://www.murray.harvard.edu/dataverse' ELSE 'https://site' END AS repository_url,
               'https://site/dataset.xhtml?persistentId=doi:10.5072/FK2/' || key AS project_url, version,
               split_part(l.text, chr(10), 1) AS title, l.text AS description,
               CASE WHEN record_id % 2 = 0 THEN l.lang ELSE d.detected END AS language,
               'https://doi.org/10.5072/FK2/' || key AS doi,
               CASE WHEN record_id % 4 <> 0 THEN '2023-06-07' ELSE '2024-02-03' END AS upload_date,
               CASE WHEN source = 'src3' THEN 'harvard-murray' ELSE 'harvard-dataverse' END AS download_repository_folder,
               key AS download_project_folder, 'v' || version AS download_version_folder, 'API-CALL' AS download_method
        FROM landed l JOIN detected d ON d.doc_id = l.record_id""",
    "parse_dataverse_files": """
        SELECT record_id, seq, CAST(record_id AS VARCHAR) AS file_ref,
               CASE WHEN seq = 0 THEN 'Interview ' || record_id || '.v1.PDF' WHEN record_id % 9 <> 0 THEN 'readme'
                    ELSE 'unknown' END AS file_name,
               CASE WHEN seq = 0 THEN 'pdf' ELSE 'unknown' END AS file_type, 'SUCCEEDED' AS status
        FROM (SELECT record_id, unnest([0, 1])::BIGINT AS seq FROM landed)""",
    "parse_dataverse_keywords": """
        SELECT record_id, unnest(words) AS keyword, generate_subscripts(words, 1) - 1 AS seq FROM landed""",
    "parse_dataverse_person_role": """
        SELECT record_id, seq, name, role FROM (
          SELECT record_id, 0::BIGINT AS seq, 'Author ' || lang AS name, 'AUTHOR' AS role FROM landed
          UNION ALL SELECT record_id, 1, nullif(source, 'src1'), 'OWNER' FROM landed
          UNION ALL SELECT record_id, 2, CASE WHEN record_id % 3 = 0 THEN 'Depositor ' || (record_id % 7) END, 'UPLOADER' FROM landed)
        WHERE name IS NOT NULL""",
    "parse_dataverse_licenses": "SELECT record_id, source AS license FROM landed WHERE record_id % 6 <> 0",
    "parse_failures": """
        SELECT doc_id AS record_id, CASE doc_id % 10 WHEN 3 THEN 'malformed record' ELSE 'missing description' END AS reason
        FROM documents WHERE doc_id % 10 IN (3, 5)""",
    "parse_nada_projects": """
        SELECT doc_id AS record_id, lang AS query_string, 9::BIGINT AS repository_id, 'https://site' AS repository_url,
               'https://site/catalog/' || doc_id AS project_url, version, split_part(text, chr(10), 1) AS title, text AS description,
               detected AS language, CASE WHEN doc_id % 7 <> 0 THEN 'https://doi.org/10.5072/' || doc_id END AS doi,
               '2020-01-02' AS upload_date, 'ihsn' AS download_repository_folder,
               CASE WHEN doc_id % 3 <> 0 THEN 'DDI_' || doc_id || '_x' ELSE CAST(doc_id AS VARCHAR) END AS download_project_folder,
               'v' || version AS download_version_folder, 'API-CALL' AS download_method
        FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN '3.0' WHEN 1 THEN '2.0' END AS version FROM detected)""",
    "parse_nada_files": """
        SELECT doc_id AS record_id, seq, 'https://site/catalog/' || doc_id || '/download/' || (seq + 1) AS file_ref,
               CASE WHEN seq = 0 THEN 'Report ' || lang || ' é ' || doc_id || '.pdf' ELSE 'dataset.CSV' END AS file_name,
               CASE WHEN seq = 0 THEN 'pdf' ELSE 'csv' END AS file_type, NULL::VARCHAR AS status
        FROM (SELECT doc_id, lang, unnest([0, 1])::BIGINT AS seq FROM documents)""",
    "parse_nada_resources": """
        SELECT doc_id AS record_id, seq, (doc_id * 10 + seq)::VARCHAR AS file_ref,
               'https://site/catalog/download/' || (doc_id * 10 + seq) AS download_url,
               CASE WHEN seq = 1 THEN 'file_' || (doc_id * 10 + 1) || '.pdf' WHEN doc_id % 3 = 0 THEN 'data ' || doc_id || '.csv'
                    ELSE 'Codebook A ' || doc_id || '.pdf' END AS file_name,
               CASE WHEN seq = 0 AND doc_id % 3 = 0 THEN 'csv' ELSE 'pdf' END AS file_type, NULL::VARCHAR AS status
        FROM (SELECT doc_id, unnest([0, 1])::BIGINT AS seq FROM documents)""",
    "parse_nada_person_role": """
        SELECT doc_id AS record_id, seq, name, role FROM (
          SELECT doc_id, 0::BIGINT AS seq, 'Author ' || lang AS name, 'AUTHOR' AS role FROM documents
          UNION ALL SELECT doc_id, 1, source, 'OWNER' FROM documents
          UNION ALL SELECT doc_id, 3, 'Fund', 'OWNER' FROM documents
          UNION ALL SELECT doc_id, 4, nullif(source, 'src2'), 'UPLOADER' FROM documents) WHERE name IS NOT NULL""",
    "parse_nada_licenses": "SELECT doc_id AS record_id, 'Licensed' AS license FROM documents WHERE doc_id % 8 <> 0",
    "ingest_keywords": f"""
        SELECT record_id, keyword FROM (
          SELECT doc_id AS record_id, word AS keyword FROM (
            SELECT *, round(tf * ln((SELECT count(*) FROM documents WHERE doc_id % 2 = 0)::DOUBLE / df), 6) AS score FROM (
              SELECT *, count(*) OVER (PARTITION BY word) AS df FROM t2))
          QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) <= 5
          UNION SELECT doc_id, 'Kind ' || lang FROM documents WHERE doc_id % 5 <> 0)""",
    "harvest_links": r"""
        SELECT page_id, download_url, first(name ORDER BY place) AS name FROM (
          SELECT page_id, place, base || href AS download_url, trim(content) AS name FROM (
            SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base,
                   unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 1)) AS href,
                   unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 2)) AS content,
                   generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 1), 1) AS place
            FROM pages)) GROUP BY page_id, download_url""",
    "worklist_cross_join": """
        SELECT DISTINCT p_name AS term, r_name AS repository, 'https://' || lower(r_name) AS base_url
        FROM part CROSS JOIN region WHERE r_regionkey <> 2""",
    "topk_per_query": """
        SELECT p_name AS term, p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS hit_rank
        FROM part QUALIFY hit_rank <= 25""",
    "delete_cascade": """
        SELECT entity, count(*) AS n, CAST(sum(id % 1000003) AS BIGINT) AS id_sum FROM (
          SELECT 'projects' AS entity, id, id AS project_id FROM projects
          UNION ALL SELECT 'files', id, project_id FROM files
          UNION ALL SELECT 'licenses', id, project_id FROM licenses)
        WHERE project_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY entity""",
    "fill_url_from_doi": """
        SELECT ord, CASE WHEN project_url = '' AND doi <> '' THEN doi ELSE project_url END AS project_url
        FROM (SELECT ord, project_url, coalesce(doi, title) AS doi FROM records)""",
    "normalise_method": """
        SELECT ord, CASE WHEN download_method IN ('API', 'api', 'SCRAPING | API') THEN 'API-CALL'
                         WHEN download_method NOT IN ('SCRAPING', 'API-CALL') THEN 'SCRAPING'
                         ELSE download_method END AS download_method FROM records""",
    "normalise_status": f"""
        SELECT project_id, CASE WHEN status NOT IN ({_RESULTS}) THEN 'FAILED_LOGIN_REQUIRED' ELSE status END AS status,
               count(*) AS n FROM files GROUP BY ALL""",
    "normalise_role": "SELECT id, CASE WHEN role = 'uploader' THEN 'UPLOADER' ELSE role END AS role FROM people",
    "impute_date": f"""
        SELECT ord, coalesce(download_date, {_lit(dim.IMPUTED_DOWNLOAD_DATE)}) AS download_date,
               download_date IS NULL AS download_date_imputed FROM records""",
    "fix_repository_ids": """
        SELECT id, CASE WHEN repository_id BETWEEN 1 AND 20 THEN repository_id ELSE 17 END AS repository_id FROM projects""",
    "repository_id_audit": "SELECT id, repository_id FROM projects WHERE repository_id NOT BETWEEN 1 AND 20",
    "list_qda_files": f"SELECT id, project_id, file_name, file_type FROM files WHERE ext IN ({_QDA})",
    "filter_ignored_types": f"""
        SELECT ext AS file_type, count(*) AS n FROM files WHERE ext NOT IN ({_list(dim.IGNORED_FILE_TYPES)}) GROUP BY ext""",
    "fetch_status": """
        SELECT event_id, CASE event_type WHEN 'error' THEN 'FAILED_LOGIN_REQUIRED' WHEN 'purchase' THEN 'FAILED_TOO_LARGE'
               WHEN 'signup' THEN 'FAILED_SERVER_UNRESPONSIVE' ELSE 'SUCCEEDED' END AS status FROM events""",
    "incremental_antijoin": """
        SELECT min(ord) AS ord, url_key AS project_url FROM keyed
        WHERE source_name <> 'en' AND url_key IS NOT NULL
          AND url_key NOT IN (SELECT project_url FROM records WHERE source_name = 'en' AND project_url IS NOT NULL)
        GROUP BY url_key""",
    "indexed_antijoin": """
        SELECT min(ord) AS ord, url_key AS project_url FROM keyed
        WHERE source_name <> 'en' AND url_key IS NOT NULL
          AND url_key NOT IN (SELECT project_url FROM records WHERE source_name = 'en' AND project_url IS NOT NULL)
        GROUP BY url_key""",
    "cooccurrence": f"""
        SELECT * FROM (WITH spoken AS (
          SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {_WORDS('text')} AS w FROM documents)
        ), frequent AS (
          SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS place FROM spoken GROUP BY word
        ), kept AS (
          SELECT t.* FROM spoken t JOIN frequent f ON f.word = t.word AND f.place <= 1000
        ), forward AS (
          SELECT a.word, b.word AS near FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 4
        ), counted AS (
          SELECT word, near, count(*) AS n FROM (FROM forward UNION ALL SELECT near, word FROM forward) GROUP BY word, near
        ), rowsums AS (
          SELECT word, sum(n) AS r FROM counted GROUP BY word
        )
        SELECT c.word, near, n, round(ln(n::DOUBLE * (SELECT sum(r) FROM rowsums) / (a.r::DOUBLE * b.r)), 6) AS pmi
        FROM counted c JOIN rowsums a ON a.word = c.word JOIN rowsums b ON b.word = c.near)""",
    "rebuild_projection": """
        SELECT id, NULL::VARCHAR AS query_string, repository_id, NULL::VARCHAR AS repository_url, NULL::VARCHAR AS project_url,
               NULL::VARCHAR AS version, type, title, NULL::VARCHAR AS description, NULL::VARCHAR AS language, NULL::VARCHAR AS doi,
               NULL::VARCHAR AS download_repository_folder, NULL::VARCHAR AS download_project_folder,
               NULL::VARCHAR AS download_version_folder, NULL::VARCHAR AS download_method, primary_class, secondary_class
        FROM projects""",
    "cleaning_audit": f"""
        SELECT 'project_url from doi' AS rule, count(*) AS changed FROM records
          WHERE project_url = '' AND coalesce(doi, title) <> ''
        UNION ALL SELECT 'download_method to API-CALL', count(*) FROM records WHERE download_method IN ('API', 'api', 'SCRAPING | API')
        UNION ALL SELECT 'download_method to SCRAPING', count(*) FROM records
          WHERE download_method NOT IN ('API', 'api', 'SCRAPING | API', 'SCRAPING', 'API-CALL')
        UNION ALL SELECT 'download_date imputed', count(*) FROM records WHERE download_date IS NULL
        UNION ALL SELECT 'status to FAILED_LOGIN_REQUIRED', count(*) FROM files WHERE status NOT IN ({_RESULTS})
        UNION ALL SELECT 'role to UPLOADER', count(*) FROM people WHERE role = 'uploader'""",
    "norm_url": "SELECT ord, url_key, project_url IS NOT NULL AS url_set FROM keyed",
    "norm_doi": "SELECT ord, doi_key, doi IS NOT NULL AS doi_set FROM keyed",
    "norm_title_repo": "SELECT ord, title_key, repository_id AS repo FROM keyed",
    "link_components": """RECURSIVE
        keys AS (
          SELECT ord, 'u' || url_key AS k FROM keyed WHERE url_key IS NOT NULL
          UNION ALL SELECT ord, 'd' || doi_key FROM keyed WHERE doi_key IS NOT NULL
          UNION ALL SELECT ord, 't' || repository_id || '|' || title_key FROM keyed
            WHERE title_key IS NOT NULL AND repository_id IS NOT NULL),
        edges AS (SELECT DISTINCT a.ord AS a, b.ord AS b FROM keys a JOIN keys b USING (k)),
        reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b)
        SELECT r.ord, coalesce(min(x.b), r.ord) AS component FROM records r LEFT JOIN reach x ON x.a = r.ord GROUP BY r.ord""",
    "surrogate_ids": "SELECT label, row_number() OVER (ORDER BY label) AS id FROM by_document",
    "dedupe_files": f"""
        SELECT CAST(floor(project_id / 50) AS BIGINT) AS label, first(file_name ORDER BY id) AS file_name,
               first(file_type ORDER BY id) FILTER (file_type IS NOT NULL) AS file_type,
               first(status ORDER BY id) AS status, min(id) AS ord
        FROM files GROUP BY 1, {_KEY('file_name')}""",
    "dedupe_keywords": f"""
        SELECT CAST(floor(project_id / 20) AS BIGINT) AS label, first(keyword ORDER BY id) AS keyword, min(id) AS ord
        FROM keywords WHERE {_KEY('keyword')} IS NOT NULL GROUP BY 1, {_KEY('keyword')}""",
    "dedupe_person_role": f"""
        SELECT CAST(floor(project_id / 3) AS BIGINT) AS label, first(name ORDER BY id) AS name, first(role ORDER BY id) AS role,
               min(id) AS ord
        FROM people GROUP BY 1, {_KEY('name')}, {_KEY('role')}""",
    "dedupe_licenses": f"""
        SELECT project_id AS label, first(license ORDER BY id) AS license, min(id) AS ord
        FROM licenses GROUP BY 1, {_KEY('license')}""",
    "dedupe_stats": """
        SELECT count(DISTINCT source_name) AS sources, count(*) AS records,
               (SELECT count(*) FROM by_document) AS clusters FROM records""",
    "duplicate_urls": "SELECT url_key AS project_url, count(*) AS n FROM keyed WHERE url_key IS NOT NULL GROUP BY url_key HAVING count(*) > 1",
    "orphan_children": """
        SELECT id, project_id FROM licenses
        WHERE project_id NOT IN (SELECT id FROM projects WHERE type = 'QD_PROJECT')""",
    "projects_summary": f"""
        SELECT p.id, p.repository_id, {_TYPE_OF} AS type, p.title, p.primary_class, p.secondary_class,
               coalesce(f.n, 0) AS n_files
        FROM projects p LEFT JOIN (SELECT project_id, count(*) AS n, {_PRIORITY} AS priority FROM files GROUP BY 1) f
          ON f.project_id = p.id""",
    "projects_summary_stored": """
        SELECT p.id, p.repository_id, p.type, p.title, p.primary_class, p.secondary_class, count(f.id) AS n_files
        FROM projects p LEFT JOIN files f ON f.project_id = p.id GROUP BY ALL""",
    "classify_project_type": f"""
        SELECT p.id, {_TYPE_OF} AS type
        FROM projects p LEFT JOIN (SELECT project_id, {_PRIORITY} AS priority FROM files GROUP BY 1) f ON f.project_id = p.id""",
    "type_tally": f"""
        SELECT t.type, count(x.type) AS n FROM ({_values('type', [(t,) for t in dim.PROJECT_TYPES])}) t
        LEFT JOIN (SELECT {_TYPE_OF} AS type FROM projects p
                   LEFT JOIN (SELECT project_id, {_PRIORITY} AS priority FROM files GROUP BY 1) f ON f.project_id = p.id) x
          ON x.type = t.type GROUP BY t.type""",
    "count_by_repository": "SELECT repository, count(*) AS n FROM labelled GROUP BY repository",
    "count_by_type": "SELECT coalesce(nullif(type, ''), 'UNCLASSIFIED') AS label, count(*) AS n FROM projects GROUP BY 1",
    "count_by_class": """
        SELECT 'primary_class' AS column_name, coalesce(primary_class, 'UNCLASSIFIED') AS label, count(*) AS n FROM projects GROUP BY 2
        UNION ALL SELECT 'secondary_class', coalesce(secondary_class, 'UNCLASSIFIED'), count(*) FROM projects GROUP BY 2""",
    "repo_class_counts": "SELECT repository, primary_class, n FROM class_counts",
    "repo_type_counts": "SELECT * FROM type_counts",
    "repo_rollup": """
        SELECT repository, 'class' AS "grouping", NULL::VARCHAR AS type, class_label AS primary_class, count(*) AS n
          FROM labelled GROUP BY repository, class_label
        UNION ALL SELECT repository, 'type', type, NULL, count(*) FROM labelled GROUP BY repository, type
        UNION ALL SELECT repository, 'type and class', type, class_label, count(*) FROM labelled GROUP BY repository, type, class_label""",
    "repo_file_class_counts": "SELECT repository, primary_class, n FROM file_counts",
    "repo_key_facts": "SELECT * FROM facts",
    "top_class": "SELECT repository, top_label, top_n, top_share FROM facts",
    "rank_table": "SELECT repository, rank, primary_class, n FROM class_ranks WHERE rank <= 20",
    "rank_table_scoped": "SELECT repository, scope, rank, primary_class, n FROM rank_tables WHERE scope <> 'all'",
    "rank_table_files": "SELECT repository, rank, primary_class, n FROM file_ranks WHERE rank <= 10",
    "fold_top_n": "SELECT * FROM class_fold",
    "fold_types": """
        SELECT 'type' AS series, least(rank, 5) AS slice, CASE WHEN rank <= 4 THEN label ELSE 'Other' END AS label,
               CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT *, row_number() OVER (ORDER BY n DESC, label) AS rank FROM (
                SELECT coalesce(nullif(type, ''), 'UNCLASSIFIED') AS label, count(*) AS n FROM projects GROUP BY 1))
        GROUP BY ALL""",
    "fold_nonzero": "SELECT repository, 'type' AS pie, slice, label, n FROM type_slots WHERE n > 0",
    "bar_series": """
        SELECT repository, n, row_number() OVER (ORDER BY n, tie) AS position
        FROM (SELECT repository, count(*) AS n, min(repository_id) AS tie FROM labelled GROUP BY 1)""",
    "pie_shares": """
        SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY repository), 6) AS share FROM class_fold""",
    "repo_narrative": "SELECT f.*, t.* EXCLUDE (repository, total) FROM facts f JOIN type_shares t USING (repository)",
    "repo_findings": """
        SELECT repository, line_no, fact, label, n, share FROM (
          SELECT repository, 1::BIGINT AS line_no, 'total projects' AS fact, '' AS label, total AS n, NULL::DOUBLE AS share FROM facts
          UNION ALL SELECT repository, 2, 'distinct primary classes', '', classes, NULL FROM facts
          UNION ALL SELECT repository, 3, 'most common primary class', top_label, top_n, top_share FROM facts
          UNION ALL SELECT repository, 4, 'unclassified projects', '', unclassified, unclassified_share FROM facts WHERE unclassified > 0
          UNION ALL SELECT repository, 5, 'type', 'QDA', qda, qda_share FROM type_shares
          UNION ALL SELECT repository, 6, 'type', 'QD', qd, qd_share FROM type_shares
          UNION ALL SELECT repository, 7, 'type', 'Other project', other, other_share FROM type_shares
          UNION ALL SELECT repository, 8, 'type', 'No project', no_project, no_project_share FROM type_shares)""",
    "repo_pies": """
        SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY repository, pie), 6) AS share FROM (
          SELECT repository, 'class' AS pie, slice,
                 CASE WHEN length(primary_class) > 34 THEN rtrim(substr(primary_class, 1, 33)) || '…' ELSE primary_class END AS label, n
          FROM class_fold WHERE n > 0
          UNION ALL SELECT repository, 'type', slice, label, n FROM type_slots WHERE n > 0)""",
    "repo_histograms": """
        SELECT repository, scope, rank, n,
               CASE WHEN length(primary_class) > 34 THEN rtrim(substr(primary_class, 1, 33)) || '…' ELSE primary_class END AS label
        FROM (SELECT repository, scope, rank, n, primary_class FROM rank_tables
              UNION ALL SELECT repository, scope, rank, n, primary_class FROM file_ranks WHERE rank <= 20)""",
    "archive_series": """
        SELECT series, least(rank, top + 1) AS slice, CASE WHEN rank <= top THEN label ELSE 'Other' END AS label,
               CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT *, CASE series WHEN 'type' THEN 4 ELSE 7 END AS top,
                     row_number() OVER (PARTITION BY series ORDER BY n DESC, tie) AS rank
              FROM (SELECT 'repository' AS series, repository AS label, count(*) AS n, lpad(CAST(min(repository_id) AS VARCHAR), 20, '0') AS tie
                      FROM labelled GROUP BY 2
                    UNION ALL SELECT 'type', coalesce(nullif(type, ''), 'UNCLASSIFIED') AS l, count(*),
                      CASE WHEN l = 'UNCLASSIFIED' THEN '' ELSE l END FROM projects GROUP BY 2
                    UNION ALL SELECT 'primary_class', coalesce(primary_class, 'UNCLASSIFIED') AS l, count(*),
                      CASE WHEN l = 'UNCLASSIFIED' THEN '' ELSE l END FROM projects GROUP BY 2
                    UNION ALL SELECT 'secondary_class', coalesce(secondary_class, 'UNCLASSIFIED') AS l, count(*),
                      CASE WHEN l = 'UNCLASSIFIED' THEN '' ELSE l END FROM projects GROUP BY 2))
        GROUP BY ALL""",
    "report_blocks": f"""
        SELECT s.section_no, s.section_title, b.block_no, b.block, b.scope, l.rank, l.primary_class, l.n
        FROM ({_values('section_no, section_title, slug', [(i, t, s) for i, (t, s) in enumerate(dim.REPORT_SECTIONS, 1)])}) s
        CROSS JOIN ({_values('block_no, block, scope', [(i, x, y) for i, (x, y) in enumerate(REPORT_BLOCKS, 1)])}) b
        LEFT JOIN (
          SELECT 'histogram' AS block, * FROM (SELECT repository, scope, rank, primary_class, n FROM rank_tables
                 UNION ALL SELECT repository, scope, rank, primary_class, n FROM file_ranks WHERE rank <= 20)
          UNION ALL SELECT 'table', * FROM (SELECT repository, scope, rank, primary_class, n FROM rank_tables
                 UNION ALL SELECT repository, scope, rank, primary_class, n FROM file_ranks WHERE rank <= 10)) l
          ON trim(regexp_replace(lower(l.repository), '[^a-z0-9]+', '-', 'g'), '-') = s.slug AND l.block = b.block AND l.scope = b.scope
        WHERE b.block = 'overview' OR (b.block = 'histogram' AND b.scope <> 'files') OR l.rank IS NOT NULL""",
    "division_corpus": "SELECT idx, text, n FROM used",
    "division_label": "SELECT o_orderkey AS id, label FROM orders JOIN divisions ON idx = o_custkey % 87",
    "section_counts": "SELECT section, CAST(sum(n) AS BIGINT) AS n FROM used GROUP BY section",
    "project_text": """
        SELECT project_id, trim(string_agg(text, ' ' ORDER BY kind, seq), chr(10) || ' ') AS text
        FROM fragments WHERE text <> '' GROUP BY project_id""",
    "nearest2": """
        SELECT vec_id, max(idx) FILTER (r = 1) AS first, max(score) FILTER (r = 1) AS first_score,
               max(idx) FILTER (r = 2) AS second, max(score) FILTER (r = 2) AS second_score
        FROM (SELECT q.vec_id, d.vec_id AS idx,
                     round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6) AS score,
                     row_number() OVER (PARTITION BY q.vec_id
                       ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) DESC, d.vec_id) AS r
              FROM embeddings q JOIN embeddings d ON d.vec_id < 87)
        GROUP BY vec_id""",
    "file_candidates": f"""
        SELECT f.id AS file_id, array_to_string(tokens, ' ') AS text, len(tokens) >= 2 AS by_name
        FROM (SELECT *, list_filter(regexp_split_to_array(regexp_replace(file_name, '\\.[^.]*$', ''), '[^A-Za-z]+'), lambda t: length(t) >= 3) AS tokens
              FROM files WHERE ext IN ({_PRIMARY}) AND lower(trim(file_name)) NOT IN ({_JUNK_NAMES})) f
        JOIN projects p ON p.id = f.project_id WHERE p.type IN ('QDA_PROJECT', 'QD_PROJECT')""",
    "file_class_fallback": f"""
        SELECT f.id AS file_id, p.primary_class, p.secondary_class
        FROM files f JOIN projects p ON p.id = f.project_id
        WHERE p.type IN ('QDA_PROJECT', 'QD_PROJECT') AND f.ext IN ({_PRIMARY}) AND lower(trim(file_name)) NOT IN ({_JUNK_NAMES})
          AND len(list_filter(regexp_split_to_array(regexp_replace(file_name, '\\.[^.]*$', ''), '[^A-Za-z]+'), lambda t: length(t) >= 3)) < 2""",
    "top_tags": """
        SELECT doc_id, word, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS rank
        FROM (SELECT doc_id, word, round(tf * ln((SELECT count(*) FROM documents)::DOUBLE / df), 6) AS score
              FROM (SELECT *, count(*) OVER (PARTITION BY word) AS df FROM terms))
        QUALIFY rank <= 5""",
    "detect_language": "SELECT doc_id, detected FROM detected",
    "language_accuracy": "SELECT lang AS truth, coalesce(detected, 'none') AS detected, count(*) AS n FROM detected GROUP BY ALL",
    "file_extensions": f"SELECT ext AS extension, count(*) AS n, count(*) FILTER ({_CONTENT}) AS content FROM files GROUP BY ext",
    "file_stem_tokens": r"""
        SELECT id, array_to_string(list_filter(regexp_split_to_array(regexp_replace(file_name, '\.[^.]*$', ''), '[^A-Za-z]+'),
               lambda t: length(t) >= 3), '|') AS tokens FROM files""",
    "text_expressions": r"""
        SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
               CASE WHEN length(text) > 34 THEN rtrim(substr(text, 1, 33), chr(10) || ' ') || '…' ELSE text END AS short,
               CASE WHEN contains(kept, '.') THEN kept ELSE kept || '.pdf' END AS file_name,
               CASE WHEN contains(text, '.') THEN lower(regexp_extract(text, '(?s)[^.]*$')) ELSE 'unknown' END AS label_type
        FROM (SELECT *, trim(regexp_replace(text, '[^\p{L}\p{N}._\- ]', '', 'g')) AS kept FROM documents)""",
}

CTES["t2"] = f"""
    SELECT doc_id, word, count(*) AS tf FROM (
      SELECT doc_id, unnest({_WORDS("source || ' field notes ' || text")}) AS word FROM documents WHERE doc_id % 2 = 0)
    WHERE length(word) >= 2 AND word NOT IN ({_list(STOP_WORDS)}) GROUP BY ALL"""

# hashed bags of words: a word's bucket, the bags of projects and divisions, and their cosines
_BUCKET = "('0x' || left(md5(word), 8))::BIGINT % 256"
CTES["division_bags"] = f"""
    SELECT idx, bucket, n, sqrt(sum(n * n) OVER (PARTITION BY idx)) AS norm
    FROM (SELECT idx, {_BUCKET} AS bucket, count(*) AS n FROM (SELECT idx, unnest({_WORDS('text')}) AS word FROM divisions) GROUP BY ALL)"""
CTES["project_bags"] = f"""
    SELECT project_id, bucket, n, sqrt(sum(n * n) OVER (PARTITION BY project_id)) AS norm
    FROM (SELECT project_id, {_BUCKET} AS bucket, count(*) AS n FROM (SELECT project_id, unnest({_WORDS('text')}) AS word FROM fragments) GROUP BY ALL)"""


def _two_nearest(bags: str, key: str) -> str:
    """(key, r, idx, score): the two nearest divisions; equal scores go to the lower idx."""
    return f"""
        SELECT {key}, idx, score, row_number() OVER (PARTITION BY {key} ORDER BY round(score, 12) DESC, idx) AS r
        FROM (SELECT k.{key}, d.idx, coalesce(dot, 0) / (k.norm * d.norm) AS score
              FROM (SELECT DISTINCT {key}, norm FROM {bags}) k, (SELECT DISTINCT idx, norm FROM division_bags) d
              LEFT JOIN (SELECT {key}, idx, sum(b.n * v.n) AS dot FROM {bags} b JOIN division_bags v USING (bucket) GROUP BY ALL) x
                ON x.{key} = k.{key} AND x.idx = d.idx)
        QUALIFY r <= 2"""


SQL |= {
    "nearest2_sparse": SQL["nearest2"].replace("d.vec_id < 87", "d.vec_id % 3 = 1 AND d.vec_id < 400"),
    "embed_text": f"""
        SELECT doc_id, string_agg(coalesce(n, 0)::VARCHAR, ',' ORDER BY bucket) AS vector
        FROM (SELECT doc_id, unnest(range(256)) AS bucket FROM documents)
        LEFT JOIN (SELECT doc_id, {_BUCKET} AS bucket, count(*) AS n FROM tokens GROUP BY ALL) USING (doc_id, bucket)
        GROUP BY doc_id""",
    "project_nearest2": f"""
        SELECT project_id, max(round(score, 6)) FILTER (r = 1) AS first_score, max(round(score, 6)) FILTER (r = 2) AS second_score,
               max(label) FILTER (r = 1) AS primary_class, max(label) FILTER (r = 2) AS secondary_class
        FROM ({_two_nearest('project_bags', 'project_id')}) JOIN divisions USING (idx) GROUP BY project_id""",
    "file_nearest2": f"""
        SELECT f.file_id, f.project_id, max(label) FILTER (r = 1) AS primary_class, max(label) FILTER (r = 2) AS secondary_class
        FROM (SELECT f.id AS file_id, f.project_id, array_to_string(tokens, ' ') AS text
              FROM (SELECT *, list_filter(regexp_split_to_array(regexp_replace(file_name, '\\.[^.]*$', ''), '[^A-Za-z]+'), lambda t: length(t) >= 3) AS tokens
                    FROM files WHERE ext IN ({_PRIMARY}) AND lower(trim(file_name)) NOT IN ({_JUNK_NAMES})) f
              JOIN projects p ON p.id = f.project_id WHERE p.type IN ('QDA_PROJECT', 'QD_PROJECT') AND len(tokens) >= 2) f
        JOIN (WITH texts AS (
                SELECT DISTINCT array_to_string(list_filter(regexp_split_to_array(regexp_replace(file_name, '\\.[^.]*$', ''), '[^A-Za-z]+'), lambda t: length(t) >= 3), ' ') AS text FROM files),
              bags AS (
                SELECT text, bucket, n, sqrt(sum(n * n) OVER (PARTITION BY text)) AS norm
                FROM (SELECT text, {_BUCKET} AS bucket, count(*) AS n FROM (SELECT text, unnest({_WORDS('text')}) AS word FROM texts) GROUP BY ALL))
              {_two_nearest('bags', 'text')}) t USING (text)
        JOIN divisions USING (idx) GROUP BY ALL""",
    "cosine_tags": f"""
        SELECT project_id, word, score, row_number() OVER (PARTITION BY project_id ORDER BY score DESC, word) AS rank
        FROM (SELECT w.project_id, word, round(n / norm, 9) AS score
              FROM (SELECT DISTINCT project_id, word, {_BUCKET} AS bucket FROM (SELECT project_id, unnest({_WORDS('text')}) AS word FROM fragments)
                    WHERE length(word) >= 2 AND word NOT IN ({_list(STOP_WORDS)})) w
              JOIN project_bags b ON b.project_id = w.project_id AND b.bucket = w.bucket)
        QUALIFY rank <= 5""",
}

# the merge rule, one record per step; the keyed state holds owners (u, d, p), the fields a
# cluster has taken so far (f), the label of every record (l) and the step number (n)
SQL["dedupe_projects"] = """RECURSIVE
    numbered AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY ord) AS n, CAST(ord AS VARCHAR) AS ord, url_key, doi_key, title_key,
             CAST(repository_id AS VARCHAR) AS repo,
             CASE WHEN project_url IS NOT NULL THEN coalesce(url_key, '') END AS url,
             CASE WHEN doi IS NOT NULL THEN coalesce(doi_key, '') END AS doi,
             CASE WHEN title IS NOT NULL THEN coalesce(title_key, '') END AS title
      FROM keyed),
    state(kind, k, v, fu, fd, ft, fr) USING KEY (kind, k) AS (
      SELECT 'n', '', '0', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR
      UNION
      (WITH cur AS (SELECT r.* FROM state s JOIN numbered r ON s.kind = 'n' AND r.n = CAST(s.v AS BIGINT) + 1),
       asked AS (
         SELECT unnest([{'tier': 1, 'kind': 'u', 'k': url_key}, {'tier': 2, 'kind': 'd', 'k': doi_key},
                        {'tier': 3, 'kind': 'p', 'k': repo || '|' || title_key}], recursive := true) FROM cur),
       hit AS (SELECT arg_min(s.v, a.tier) AS home FROM asked a JOIN recurring.state s ON s.kind = a.kind AND s.k = a.k),
       placed AS (SELECT cur.*, coalesce(home, ord) AS home FROM cur, hit),
       filled AS (
         SELECT n, ord, home, coalesce(s.fu, url) AS fu, coalesce(s.fd, doi) AS fd, coalesce(s.ft, title) AS ft,
                coalesce(s.fr, repo) AS fr
         FROM placed LEFT JOIN recurring.state s ON s.kind = 'f' AND s.k = home),
       out AS (
         SELECT unnest([
           {'kind': 'n', 'k': '', 'v': CAST(n AS VARCHAR)}, {'kind': 'l', 'k': ord, 'v': home}, {'kind': 'f', 'k': home, 'v': home},
           {'kind': 'u', 'k': nullif(fu, ''), 'v': home}, {'kind': 'd', 'k': nullif(fd, ''), 'v': home},
           {'kind': 'p', 'k': fr || '|' || nullif(ft, ''), 'v': home}], recursive := true), fu, fd, ft, fr
         FROM filled)
       SELECT o.kind, o.k, o.v, o.fu, o.fd, o.ft, o.fr FROM out o
       LEFT JOIN recurring.state s ON s.kind = o.kind AND s.k = o.k
       WHERE o.k IS NOT NULL AND (s.k IS NULL OR o.kind IN ('n', 'f'))))
    SELECT CAST(k AS BIGINT) AS ord, CAST(v AS BIGINT) AS label FROM state WHERE kind = 'l'"""

SQL["merge_increment"] = SQL["dedupe_projects"]
SQL["merge_decrement"] = SQL["dedupe_projects"].replace("FROM keyed)", "FROM keyed WHERE source_name <> 'de')")
CTES["ids_before"] = """
    SELECT local_id, min(ord) AS founder, row_number() OVER (ORDER BY min(ord)) AS id
    FROM records WHERE source_name NOT IN ('de', 'mirror_fr') GROUP BY local_id"""
SQL["stable_ids"] = """
    SELECT label, coalesce(kept, (SELECT count(*) FROM ids_before) + row_number() OVER (PARTITION BY kept IS NULL ORDER BY label)) AS id,
           greatest(n - 1, 0) AS retired
    FROM (SELECT r.local_id // 2 AS pair, min(r.ord) AS label, min(i.id) AS kept, count(DISTINCT i.id) AS n
          FROM records r LEFT JOIN ids_before i ON i.founder = r.ord GROUP BY 1)"""

SQL["cube_delta"] = """
    SELECT repository_id, type, coalesce(nullif(primary_class, ''), 'UNCLASSIFIED') AS primary_class, count(*) AS n, min(id) AS first_id
    FROM (SELECT id, repository_id, CASE WHEN id % 7 = 0 THEN 'QDA_PROJECT' ELSE type END AS type, primary_class
          FROM projects WHERE id % 11 <> 0) GROUP BY 1, 2, 3"""

CTES["grams"] = r"""
    SELECT doc_id, lang, len(grams) AS n_grams, unnest(grams) AS gram
    FROM (SELECT doc_id, lang, list_transform(range(1, length(line) - 1), lambda i: substr(line, i, 3)) AS grams
          FROM (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(text), '(?:[^\p{L}]|[\x{10000}-\x{10FFFF}])+', ' ', 'g')) || ' ' AS line FROM documents))"""
CTES["gram_counts"] = "SELECT lang, gram, count(*) AS n FROM grams WHERE doc_id % 4 <> 2 AND lang IS NOT NULL GROUP BY ALL"
CTES["profiles"] = """
    SELECT lang, gram, round(1000000 * ln((n + 1)::DOUBLE))::BIGINT AS weight, -round(1000000 * ln((total + kinds)::DOUBLE))::BIGINT AS base
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place, sum(n) OVER (PARTITION BY lang) AS total,
                 (SELECT count(DISTINCT gram) FROM gram_counts) AS kinds FROM gram_counts)
    WHERE place <= 1000"""
CTES["profiled"] = """
    SELECT doc_id, arg_min(lang, (-total, lang)) AS detected, (max(total) // any_value(n_grams))::BIGINT AS score
    FROM (SELECT g.doc_id, p.lang, any_value(n_grams) AS n_grams, (sum(weight) + any_value(n_grams) * any_value(base))::BIGINT AS total
          FROM grams g JOIN profiles p USING (gram) GROUP BY g.doc_id, p.lang)
    GROUP BY doc_id"""
SQL["detect_by_profiles"] = "SELECT doc_id, detected, score FROM documents LEFT JOIN profiled USING (doc_id)"
SQL["profile_accuracy"] = """
    SELECT d.lang AS truth, coalesce(p.detected, 'none') AS detected, count(*) AS n
    FROM documents d LEFT JOIN profiled p USING (doc_id) WHERE doc_id % 4 = 2 GROUP BY ALL"""

_MERGED_FIELDS = ("title", "doi", "project_url", "repository_id")
_steps, _labels = SQL["dedupe_projects"].rsplit("\n", 1)
SQL["merged_archive"] = _steps + f""",
    merged AS MATERIALIZED ({_labels}),
    numbers AS (SELECT label, row_number() OVER (ORDER BY label) AS id, count(*) AS members FROM merged GROUP BY label),
    words AS (
      SELECT m.label, count(DISTINCT {_KEY('k.keyword')}) AS n
      FROM keywords k JOIN source_list s ON s.lang = k.lang
      JOIN merged m ON m.ord = (s.source_rank::BIGINT << 52) + k.project_id
      WHERE s.lang <> 'fr' GROUP BY m.label)
    SELECT n.id, n.members, {', '.join(f"first(r.{c} ORDER BY r.ord) FILTER (r.{c} IS NOT NULL) AS {c}" for c in _MERGED_FIELDS)},
           coalesce(any_value(w.n), 0) AS n_keywords
    FROM numbers n JOIN merged m USING (label) JOIN records r ON r.ord = m.ord LEFT JOIN words w ON w.label = n.label
    GROUP BY n.id, n.members"""

_FIRST = lambda c: f"(SELECT first({c} ORDER BY ord) FROM records r WHERE r.local_id = b.local_id AND {c} IS NOT NULL) AS {c}"
SQL["coalesce_first"] = "SELECT label, members, " + ", ".join(
    _FIRST(c)
    for c in ("repository_id", "project_url", "title", "description", "doi", "download_date", "download_method")
) + " FROM by_document b"

_NULL_CHECKS = {
    "projects": "repository_url project_url description download_date download_repository_folder "
    "download_project_folder download_method".split(),
    "files": ["file_type"],
    "person_role": ["role"],
}


def _violations() -> str:
    parts = []
    for table, columns in _NULL_CHECKS.items():
        view = {"person_role": "people"}.get(table, table)
        for c in columns:
            test = f"{c} IS NULL" if table != "projects" else "TRUE"
            parts.append(f"SELECT '{table.upper()}.{c} is NULL' AS rule, count(*) AS violations FROM {view} WHERE {test}")
    parts += [
        f"SELECT 'PROJECTS.type has a value outside the PROJECT_TYPE enum', count(*) FROM projects WHERE type NOT IN ({_list(dim.PROJECT_TYPES)})",
        f"SELECT 'FILES.status has a value outside the DOWNLOAD_RESULT enum', count(*) FROM files WHERE status NOT IN ({_RESULTS})",
        f"SELECT 'PERSON_ROLE.role has a value outside the PERSON_ROLE enum', count(*) FROM people WHERE role NOT IN ({_list(dim.PERSON_ROLES)})",
    ]
    return " UNION ALL ".join(parts)


SQL["constraint_violations"] = f"SELECT * FROM ({_violations()}) WHERE violations > 0"
SQL["gate"] = f"""SELECT * FROM ({_violations()}
    UNION ALL SELECT 'FILES without a project', count(*) FROM files WHERE project_id NOT IN (SELECT id FROM projects)
    UNION ALL SELECT 'PERSON_ROLE without a project', count(*) FROM people WHERE project_id NOT IN (SELECT id FROM projects)
    UNION ALL SELECT 'LICENSES without a project', count(*) FROM licenses WHERE project_id NOT IN (SELECT id FROM projects))
    WHERE violations > 0"""


def all_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in SQL.items()}
