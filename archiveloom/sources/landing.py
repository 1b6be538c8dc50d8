"""Landed repository responses to the five entities.

A landed table has a ``record_id`` and the raw JSON of one record. Nothing is inferred: each
shape is read with a fixed schema, so a document that lacks a part gives NULL there. Every
parser returns the entities as DataFrames keyed by ``record_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.functions.files import resource_name, safe_file_name, type_of_label
from archiveloom.functions.text import blank_to_null
from archiveloom.operators.clean import drop_ignored_types, fetch_status
from archiveloom.operators.harmonise import Source
from archiveloom.operators.keywords import ingest_keywords
from archiveloom.operators.language import detect_language, language_or_detected
from archiveloom.schema import CHILD_COLUMNS
from archiveloom.staging import StagingArea

DOI_RESOLVER = "https://doi.org/"

# --- search responses -----------------------------------------------------------------


def unwrap_hits(responses: DataFrame, item_schema: str, json: str = "json") -> DataFrame:
    """One row per hit of a search response, whichever envelope it came in.

    ``data.items`` and ``result.rows`` are understood; a response without hits (or that is
    no JSON at all) gives no rows.
    """
    schema = (
        f"data struct<items: array<{item_schema}>>, result struct<rows: array<{item_schema}>>"
    )
    body = F.from_json(json, schema)
    hits = F.coalesce(body["data"]["items"], body["result"]["rows"])
    rest = [c for c in responses.columns if c != json]
    return responses.select(*rest, F.posexplode(hits).alias("hit_no", "hit"))


def lookup_id(idno: Column, global_id: Column) -> Column:
    return F.coalesce(blank_to_null(idno), global_id)


def fetch_target(repository_id: Column, item_id: Column, lookup: Column) -> Column:
    """What to ask a repository for: repository 9 by its numeric id, others by lookup id."""
    return F.when(F.coalesce(repository_id, F.lit(-1)) == 9, item_id.cast("string")).otherwise(lookup)


# --- failures -------------------------------------------------------------------------


def split_failures(
    landed: DataFrame, schema: str, required: dict[str, str], staging: StagingArea | None = None,
    json: str = "json",
) -> tuple[DataFrame, DataFrame]:
    """(good records with ``doc``, failures with ``reason``).

    ``required`` maps a field to the SQL path that must be filled. One bad record never
    stops the others. The JSON is parsed once, into a staged columnar table that all entities
    are then read from.
    """
    staging = staging or StagingArea(landed.sparkSession, "landed")
    parsed = landed.withColumn(
        "doc",
        F.from_json(
            json, f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
        ),
    )
    reason = F.when(
        F.col("doc").isNull() | F.col("doc._corrupt").isNotNull(), F.lit("malformed record")
    )
    for name, path in required.items():
        reason = reason.when(F.expr(f"doc.{path}").isNull(), F.lit(f"missing {name}"))
    judged, _ = staging.write(parsed.withColumn("reason", reason).drop(json), "parsed")
    good = judged.where(F.col("reason").isNull()).drop("reason")
    return good, judged.where(F.col("reason").isNotNull()).select("record_id", "reason")


# --- Dataverse shape ------------------------------------------------------------------

DATAVERSE_SCHEMA = (
    "query string, "
    "item struct<global_id: string, name: string, description: string, publisher: string, "
    "published_at: string>, "
    "version struct<versionNumber: string, versionMinorNumber: string, releaseTime: string, "
    "license: struct<name: string>, "
    "files: array<struct<label: string, dataFile: struct<id: string>>>, "
    "metadataBlocks: struct<citation: struct<fields: array<struct<typeName: string, value: string>>>>>"
)
DATAVERSE_REQUIRED = {
    "title": "item.name", "description": "item.description", "global_id": "item.global_id"
}


def citation_field(type_name: str) -> Column:
    """Raw JSON of the first citation field of a type; NULL when there is none."""
    fields = F.col("doc.version.metadataBlocks.citation.fields")
    same = F.filter(fields, lambda f: f["typeName"] == type_name)
    return F.try_element_at(same, F.lit(1))["value"]


def _named(type_name: str, member: str) -> Column:
    """array<string>: the ``member.value`` of every entry of a compound citation field."""
    entries = F.from_json(citation_field(type_name), f"array<struct<{member}: struct<value: string>>>")
    return F.coalesce(F.transform(entries, lambda e: e[member]["value"]), F.array().cast("array<string>"))


def _people(names: Column, role: str) -> Column:
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(role).alias("role")))


def _explode_named(docs: DataFrame, items: Column, column: str) -> DataFrame:
    return docs.select("record_id", F.posexplode(items).alias("seq", column))


def _explode_entries(docs: DataFrame, type_name: str, member: str, column: str) -> DataFrame:
    """:func:`_explode_named` of one citation field, whose entries become rows as they are parsed."""
    raw = docs.select("record_id", citation_field(type_name).alias("_raw"))
    entries = F.from_json("_raw", f"array<struct<{member}: struct<value: string>>>")
    rows = raw.select("record_id", F.posexplode(entries).alias("seq", "_entry"))
    return rows.select("record_id", "seq", F.col("_entry")[member]["value"].alias(column))


def doi_of_identifier(identifier: Column) -> Column:
    return F.concat(F.lit(DOI_RESOLVER), F.replace(identifier, F.lit("doi:"), F.lit("")))


def dataverse_projects(docs: DataFrame, base_url: str) -> DataFrame:
    gid = F.col("doc.item.global_id")
    murray = F.contains(F.lower(F.coalesce("doc.item.publisher", F.lit(""))), F.lit("murray"))
    version = F.concat_ws(".", "doc.version.versionNumber", "doc.version.versionMinorNumber")
    languages = F.from_json(citation_field("language"), "array<string>")
    day = lambda c: blank_to_null(F.split_part(F.col(c), F.lit("T"), F.lit(1)))
    return docs.select(
        "record_id",
        F.col("doc.query").alias("query_string"),
        F.when(murray, 18).otherwise(10).cast("bigint").alias("repository_id"),
        F.when(murray, "https://www.murray.harvard.edu/dataverse").otherwise(base_url).alias("repository_url"),
        F.concat(F.lit(f"{base_url}/dataset.xhtml?persistentId="), gid).alias("project_url"),
        version.alias("version"),
        F.col("doc.item.name").alias("title"),
        F.col("doc.item.description").alias("description"),
        language_or_detected(F.try_element_at(languages, F.lit(1)), F.col("doc.item.description")).alias("language"),
        doi_of_identifier(gid).alias("doi"),
        F.coalesce(day("doc.version.releaseTime"), day("doc.item.published_at")).alias("upload_date"),
        F.when(murray, "harvard-murray").otherwise("harvard-dataverse").alias("download_repository_folder"),
        F.coalesce(F.substring_index(gid, "/", -1), F.lit("unknown_project")).alias("download_project_folder"),
        F.concat(F.lit("v"), version).alias("download_version_folder"),
        F.lit("API-CALL").alias("download_method"),
    )


def parse_dataverse(
    landed: DataFrame, base_url: str, staging: StagingArea | None = None
) -> dict[str, DataFrame]:
    """Entities and failures of landed Dataverse records {query, item, version}.

    A file's status is SUCCEEDED unless a fetch log says otherwise.
    """
    docs, failures = split_failures(landed, DATAVERSE_SCHEMA, DATAVERSE_REQUIRED, staging)
    files = docs.select("record_id", F.posexplode("doc.version.files").alias("seq", "file"))
    label = F.coalesce("file.label", F.lit("unknown"))
    depositor = blank_to_null(citation_field("depositor"))
    people = F.concat(
        _people(_named("author", "authorName"), "AUTHOR"),
        _people(_named("datasetContact", "datasetContactName"), "OWNER"),
        _people(F.array(depositor), "UPLOADER"),
    )
    return {
        "projects": dataverse_projects(docs, base_url),
        "files": files.select(
            "record_id", "seq", F.col("file.dataFile.id").alias("file_ref"),
            label.alias("file_name"), type_of_label(label).alias("file_type"),
            F.lit("SUCCEEDED").alias("status"),
        ),
        "keywords": _explode_entries(docs, "keyword", "keywordValue", "keyword"),
        "person_role": _explode_named(docs, people, "person")
        .select("record_id", "seq", "person.name", "person.role")
        .where(F.col("name") != ""),
        "licenses": docs.select("record_id", F.col("doc.version.license.name").alias("license")).where(
            F.col("license").isNotNull()
        ),
        "failures": failures,
    }


# --- NADA shape -----------------------------------------------------------------------

_NAMES = "array<struct<name: string>>"
NADA_SCHEMA = (
    "query string, id string, "
    f"doc_desc struct<version_statement: struct<version: string>, prod_date: string, producers: {_NAMES}>, "
    "study_desc struct<title_statement: struct<idno: string, title: string>, "
    "study_info: struct<abstract: string, notes: string, data_kind: string>, "
    "data_access: struct<dataset_use: struct<cit_req: string, conditions: string>>, "
    f"authoring_entity: {_NAMES}, production_statement: struct<funding_agencies: {_NAMES}>, "
    f"distribution_statement: struct<contact: {_NAMES}>>, "
    "scraped_files_list array<struct<download_url: string, name: string>>"
)
NADA_REQUIRED = {
    "id": "id", "title": "study_desc.title_statement.title", "description": "study_desc.study_info.abstract"
}
NADA_REPOSITORY_ID = 9


def version_number(text: Column) -> Column:
    """The number after ``version`` or ``v``; NULL when the text names none."""
    digits = F.regexp_extract(text, r"(?i)\b(?:version|v)\s*0*(\d+)\b", 1)
    return blank_to_null(digits).try_cast("double")


def doi_in_citation(text: Column) -> Column:
    return blank_to_null(F.regexp_extract(text, r"https://doi\.org/\S+", 0))


def nada_projects(docs: DataFrame, site: str) -> DataFrame:
    number = version_number(F.col("doc.doc_desc.version_statement.version"))
    version = number.cast("string")
    study = "doc.study_desc"
    folder = F.coalesce(blank_to_null(f"{study}.title_statement.idno"), F.col("doc.id"))
    return docs.select(
        "record_id",
        F.col("doc.query").alias("query_string"),
        F.lit(NADA_REPOSITORY_ID).cast("bigint").alias("repository_id"),
        F.lit(site).alias("repository_url"),
        F.concat(F.lit(f"{site}/catalog/"), "doc.id").alias("project_url"),
        version.alias("version"),
        F.col(f"{study}.title_statement.title").alias("title"),
        F.col(f"{study}.study_info.abstract").alias("description"),
        detect_language(F.col(f"{study}.study_info.abstract")).alias("language"),
        doi_in_citation(F.col(f"{study}.data_access.dataset_use.cit_req")).alias("doi"),
        F.col("doc.doc_desc.prod_date").alias("upload_date"),
        F.lit("ihsn").alias("download_repository_folder"),
        F.replace(folder, F.lit("/"), F.lit("_")).alias("download_project_folder"),
        # version 0 stands for none
        F.when(number != 0, F.concat(F.lit("v"), version)).alias("download_version_folder"),
        F.lit("API-CALL").alias("download_method"),
    )


def nada_studies(docs: DataFrame) -> DataFrame:
    """(record_id, notes, abstract, data_kind): what ingest keywords are drawn from."""
    info = "doc.study_desc.study_info"
    return docs.select("record_id", f"{info}.notes", f"{info}.abstract", f"{info}.data_kind")


def parse_nada(
    landed: DataFrame, site: str, staging: StagingArea | None = None
) -> dict[str, DataFrame]:
    """Entities and failures of landed NADA exports; files have no status until fetched."""
    docs, failures = split_failures(landed, NADA_SCHEMA, NADA_REQUIRED, staging)
    study = "doc.study_desc"
    none = F.array().cast(_NAMES)
    roles = (
        (f"{study}.authoring_entity", "AUTHOR"),
        ("doc.doc_desc.producers", "OWNER"),
        (f"{study}.production_statement.funding_agencies", "OWNER"),
        (f"{study}.distribution_statement.contact", "UPLOADER"),
    )
    people = F.concat(
        *[_people(F.transform(F.coalesce(path, none), lambda e: e["name"]), role) for path, role in roles]
    )
    files = docs.select("record_id", F.posexplode("doc.scraped_files_list").alias("seq", "file"))
    name = safe_file_name("file.name")
    return {
        "projects": nada_projects(docs, site),
        "files": files.select(
            "record_id", "seq", F.col("file.download_url").alias("file_ref"),
            name.alias("file_name"), type_of_label(name).alias("file_type"),
            F.lit(None).cast("string").alias("status"),
        ),
        "keywords": ingest_keywords(nada_studies(docs), "record_id"),
        "person_role": _explode_named(docs, people, "person")
        .select("record_id", "seq", "person.name", "person.role")
        .where(F.col("name") != ""),
        "licenses": docs.select(
            "record_id", F.col(f"{study}.data_access.dataset_use.conditions").alias("license")
        ).where(F.col("license").isNotNull()),
        "failures": failures,
    }


def nada_resources(responses: DataFrame, site: str, json: str = "json") -> DataFrame:
    """Files of landed resource lists: one row per resource, in order.

    A resource without a file name has its title for one, without a title ``file_<id>``; its id is
    ``resource_id``, else ``id``. A response without resources, or that is no JSON, gives no rows.
    """
    body = F.from_json(json, "resources array<struct<resource_id: string, id: string, filename: string, title: string>>")
    found = responses.select("record_id", F.posexplode(body["resources"]).alias("seq", "resource"))
    number = F.coalesce(blank_to_null("resource.resource_id"), F.col("resource.id"))
    name = safe_file_name(resource_name("resource.filename", "resource.title", number))
    return found.select(
        "record_id", "seq", number.alias("file_ref"),
        F.concat(F.lit(f"{site}/catalog/download/"), number).alias("download_url"),
        name.alias("file_name"), type_of_label(name).alias("file_type"), F.lit(None).cast("string").alias("status"),
    )


# --- any shape ------------------------------------------------------------------------

SHAPES = {"dataverse": parse_dataverse, "nada": parse_nada}


def parse_landed(
    landed: DataFrame, shape: str, base_url: str, fetch_log: DataFrame | None = None, keep_ignored: bool = False
) -> dict[str, DataFrame]:
    """Entities and failures of landed records of a known shape, the JSON parsed once.

    Files of ignored types are left out, and files have the status of ``fetch_log`` (see
    :func:`with_fetch_log`) where it knows them.
    """
    if shape not in SHAPES:
        raise ValueError(f"shape {shape!r}: expected one of {sorted(SHAPES)}")
    parsed = SHAPES[shape](landed, base_url, StagingArea(landed.sparkSession, f"landed-{shape}"))
    files = parsed["files"] if keep_ignored else drop_ignored_types(parsed["files"])
    return parsed | {"files": files if fetch_log is None else with_fetch_log(files, fetch_log)}


def with_fetch_log(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files with the status their download had; files the log does not know keep theirs.

    ``log`` has one row per (record_id, file_ref) with the HTTP status, NULL for no answer.
    """
    outcome = log.select("record_id", "file_ref", "http_status", F.lit(True).alias("_fetched"))
    status = F.when(
        F.col("_fetched"), fetch_status(F.col("http_status"), F.col("file_name"))
    ).otherwise(F.col("status"))
    return (
        files.join(outcome, ["record_id", "file_ref"], "left")
        .withColumn("status", status)
        .drop("http_status", "_fetched")
    )


def as_source(name: str, parsed: dict[str, DataFrame]) -> Source:
    """Parsed entities as a catalogue for the merge: the record id is the local id."""
    tables = {"projects": parsed["projects"].withColumnRenamed("record_id", "id")}
    for entity in CHILD_COLUMNS:
        tables[entity] = parsed[entity].withColumnRenamed("record_id", "project_id")
    return Source(name, tables)


# --- incremental ----------------------------------------------------------------------


def without_url(incoming: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, reason) of incoming projects that no URL tells apart."""
    return incoming.where(F.col("project_url").isNull()).select(key, F.lit("missing project_url").alias("reason"))


def new_projects(incoming: DataFrame, known: DataFrame, order: str = "ord") -> DataFrame:
    """Incoming projects whose exact URL is not known yet, each URL once (the first one).

    Projects without a URL are none of them; :func:`without_url` lists those.
    """
    firsts = (
        incoming.groupBy("project_url")
        .agg(F.min(order).alias(order))
        .join(known.select("project_url"), "project_url", "left_anti")
    )
    return incoming.join(firsts, ["project_url", order], "left_semi")
