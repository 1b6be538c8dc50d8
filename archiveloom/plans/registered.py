"""Every operator as a query over the driver's tables.

A query takes (spark, sf_dir) and gives a DataFrame; ``oracle.py`` has the SQL twins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.functions import files as fx
from archiveloom.functions import text as tx
from archiveloom.operators import clean as cl
from archiveloom.operators import cooccurrence as co
from archiveloom.operators import counts as ct
from archiveloom.operators import cube as cb
from archiveloom.operators import harmonise as hz
from archiveloom.operators import increment as inc
from archiveloom.operators import keywords as kw
from archiveloom.operators import language as lg
from archiveloom.operators import ledger as lgr
from archiveloom.operators import merge as mg
from archiveloom.operators import profiles as pf
from archiveloom.operators import project_type as pt
from archiveloom.operators import ranks as rk
from archiveloom.operators import taxonomy as tax
from archiveloom.operators import validate as vd
from archiveloom.operators import vectors as vec
from archiveloom.operators.components import link_components
from archiveloom.plans import bindings as b
from archiveloom.plans import report as rp
from archiveloom.plans.archive import merge_sources
from archiveloom.schema import Archive
from archiveloom.sources import landing as ld
from archiveloom.sources.folders import harmonise_folders
from archiveloom.sources.known_urls import KnownUrls
from archiveloom.sources.links import harvest_links
from archiveloom.sources.sinks import published
from archiveloom.sources.worklist import Repository, first_hits, worklist
from archiveloom.staging import StagingArea

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _cube(spark: SparkSession, sf: str) -> DataFrame:
    return ct.class_cube(b.projects(spark, sf), b.repositories(spark))


def _file_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ct.repo_file_class_counts(
        b.projects(spark, sf), b.classified_files(spark, sf), b.repositories(spark)
    )


def _typed_projects(spark: SparkSession, sf: str) -> DataFrame:
    return pt.classify_project_type(b.projects(spark, sf), b.files(spark, sf))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources ----------------------------------------------------------------------------


@query
def multi_source_scan(spark, sf):
    projects = hz.harmonise(b.sources(spark, sf))["projects"]
    return projects.select(
        "source_name", F.col("source_rank").cast("bigint").alias("source_rank"), "local_id", "ord"
    )


@query
def scan_by_signature(spark, sf):
    """The catalogues as folders, scanned once per kind of table."""
    folders = b.folders(spark, sf, StagingArea(spark, "folders"))
    projects = harmonise_folders(spark, folders)["projects"]
    return projects.select(
        "source_name", F.col("source_rank").cast("bigint").alias("source_rank"), "local_id", "ord"
    )


@query
def resolve_sources(spark, sf):
    """Rows taken per source and entity once tables and columns are resolved."""
    entities = hz.harmonise(b.sources(spark, sf))
    counted = [
        df.groupBy("source_name").agg(F.count(F.lit(1)).alias("n")).select(F.lit(e).alias("entity"), "source_name", "n")
        for e, df in entities.items() if e in ("projects", "keywords")
    ]
    return counted[0].union(counted[1])


@query
def harmonise_schema(spark, sf):
    projects = hz.harmonise(b.sources(spark, sf))["projects"]
    return projects.select(
        "ord", "source_name", "repository_id", "project_url", "title", "description", "doi",
        "download_date", "download_method", "query_string", "language",
    )


@query
def attach_children(spark, sf):
    entities = hz.harmonise(b.sources(spark, sf))
    projects = entities["projects"].where("source_name <> 'es'")
    first = projects.groupBy(F.length("title").alias("size")).agg(F.min("ord").alias("label"))
    assignment = projects.select("ord", F.length("title").alias("size")).join(first, "size").drop("size")
    return mg.attach_children(entities["keywords"], assignment).select("label", "ord", "keyword")


@query
def unwrap_hits(spark, sf):
    schema = "struct<idno: string, global_id: string, id: bigint, repository_id: bigint, name: string>"
    hits = ld.unwrap_hits(b.landed_responses(spark, sf), schema)
    lookup = ld.lookup_id(F.col("hit.idno"), F.col("hit.global_id"))
    return hits.select(
        "doc_id", F.col("hit_no").cast("bigint").alias("hit_no"), lookup.alias("lookup_id"),
        ld.fetch_target(F.col("hit.repository_id"), F.col("hit.id"), lookup).alias("target"),
        F.col("hit.name").alias("name"),
    )


SITE = "https://site"


def _dataverse(entity: str) -> Query:
    def run(spark, sf):
        out = ld.parse_dataverse(b.landed_dataverse(spark, sf), SITE)[entity]
        return out.withColumn("seq", F.col("seq").cast("bigint")) if "seq" in out.columns else out

    return run


def _nada(entity: str) -> Query:
    def run(spark, sf):
        out = ld.parse_nada(b.landed_nada(spark, sf), SITE)[entity]
        return out.withColumn("seq", F.col("seq").cast("bigint")) if "seq" in out.columns else out

    return run


for _name in ("projects", "files", "keywords", "person_role", "licenses"):
    QUERIES[f"parse_dataverse_{_name}"] = _dataverse(_name)
    if _name != "keywords":
        QUERIES[f"parse_nada_{_name}"] = _nada(_name)
QUERIES["parse_nada_resources"] = lambda spark, sf: ld.nada_resources(b.landed_resources(spark, sf), SITE).withColumn(
    "seq", F.col("seq").cast("bigint")
)
QUERIES["parse_failures"] = _dataverse("failures")
QUERIES["ingest_keywords"] = _nada("keywords")


@query
def harvest_links_query(spark, sf):
    base = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    return harvest_links(b.table(spark, sf, "pages"), base, marker="/")


QUERIES["harvest_links"] = QUERIES.pop("harvest_links_query")


@query
def worklist_cross_join(spark, sf):
    regions = b.table(spark, sf, "region").orderBy("r_regionkey").collect()  # configuration: five rows
    repos = [
        Repository(r.r_name, f"https://{r.r_name.lower()}", None if r.r_regionkey == 2 else "token")
        for r in regions
    ]
    terms = b.table(spark, sf, "part").select(F.col("p_name").alias("term")).distinct()
    return worklist(terms, repos)


@query
def topk_per_query(spark, sf):
    hits = b.table(spark, sf, "part").select(F.col("p_name").alias("term"), "p_partkey")
    return first_hits(hits, ["term"], ["p_partkey"])


# --- cleaning -----------------------------------------------------------------------------


@query
def delete_cascade(spark, sf):
    doomed = b.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    archive = cl.delete_projects(
        Archive(b.projects(spark, sf), files=b.files(spark, sf), licenses=b.licenses(spark, sf)), doomed
    )
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id") % 1000003).alias("id_sum")).select(F.lit(e).alias("entity"), "n", "id_sum")
        for e, df in archive.tables().items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


def _harvested_projects(spark, sf) -> DataFrame:
    return hz.harmonise(b.sources(spark, sf))["projects"]


@query
def fill_url_from_doi(spark, sf):
    rows = _harvested_projects(spark, sf).withColumn("doi", F.coalesce("doi", "title"))
    return rows.select("ord", cl.cleaned_project_url().alias("project_url"))


@query
def normalise_method(spark, sf):
    return _harvested_projects(spark, sf).select("ord", cl.cleaned_download_method().alias("download_method"))


@query
def normalise_status(spark, sf):
    return cl.clean_files(b.files(spark, sf)).groupBy("project_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def normalise_role(spark, sf):
    return cl.clean_person_role(b.people(spark, sf)).select("id", "role")


@query
def impute_date(spark, sf):
    rows = cl.clean_projects(_harvested_projects(spark, sf))
    return rows.select("ord", "download_date", "download_date_imputed")


@query
def fix_repository_ids(spark, sf):
    return cl.fix_repository_ids(b.projects(spark, sf), b.repositories(spark)).select("id", "repository_id")


@query
def repository_id_audit(spark, sf):
    return cl.invalid_repository_ids(b.projects(spark, sf), b.repositories(spark)).select("id", "repository_id")


@query
def list_qda_files(spark, sf):
    return pt.list_qda_files(b.files(spark, sf)).select("id", "project_id", "file_name", "file_type")


@query
def filter_ignored_types(spark, sf):
    typed = b.files(spark, sf).withColumn("file_type", fx.file_extension("file_type", "file_name"))
    return cl.drop_ignored_types(typed).groupBy("file_type").agg(F.count(F.lit(1)).alias("n"))


def _fetch_log(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "error", 403).when(kind == "purchase", 413).when(kind == "signup", 500).otherwise(200)
    return b.table(spark, sf, "events").select("event_id", status.alias("http_status"), kind.alias("name"))


@query
def fetch_status(spark, sf):
    return _fetch_log(spark, sf).select(
        "event_id", cl.fetch_status(F.col("http_status"), F.col("name")).alias("status")
    )


@query
def incremental_antijoin(spark, sf):
    rows = _harvested_projects(spark, sf)
    known = rows.where("source_name = 'en'").select("project_url")
    incoming = rows.where("source_name <> 'en'").withColumn("project_url", tx.url_key("project_url"))
    return ld.new_projects(incoming, known).select("ord", "project_url")


@query
def indexed_antijoin(spark, sf):
    """:func:`incremental_antijoin` against an index of the known URLs in three batches."""
    rows = _harvested_projects(spark, sf)
    known = rows.where("source_name = 'en'").select("ord", "project_url")
    index = KnownUrls(spark, f"{StagingArea(spark, 'index').path}/known")
    for batch in range(3):
        index.add(known.where(F.col("ord") % 3 == batch), batch)
    incoming = rows.where("source_name <> 'en'").withColumn("project_url", tx.url_key("project_url"))
    return ld.new_projects(incoming, index.among(incoming, 3)).select("ord", "project_url")


@query
def rebuild_projection(spark, sf):
    return published("projects", b.projects(spark, sf)).drop("tags", "upload_date", "download_date")


@query
def cleaning_audit(spark, sf):
    rows = _harvested_projects(spark, sf).withColumn("doi", F.coalesce("doi", "title"))
    return cl.cleaning_audit(rows, b.files(spark, sf), b.people(spark, sf))


@query
def cube_delta(spark, sf):
    """The cube after projects came, went and changed their type, from the changes."""
    every = b.projects(spark, sf).select("id", "repository_id", "type", "primary_class")
    old = every.where("id % 10 <> 3")
    cube, _ = StagingArea(spark, "cube").write(cb.cells(old), "cube")
    retyped = F.when(F.col("id") % 7 == 0, "QDA_PROJECT").otherwise(F.col("type"))
    now = every.where("id % 11 <> 0").withColumn("type", retyped)
    changed = "id % 11 = 0 or id % 7 = 0"
    return cb.maintained(cube, old.where(changed), now.where(f"{changed} or id % 10 = 3"), now)


# --- merge --------------------------------------------------------------------------------


@query
def norm_url(spark, sf):
    return mg.match_keys(_harvested_projects(spark, sf)).select("ord", "url_key", "url_set")


@query
def norm_doi(spark, sf):
    return mg.match_keys(_harvested_projects(spark, sf)).select("ord", "doi_key", "doi_set")


@query
def norm_title_repo(spark, sf):
    return mg.match_keys(_harvested_projects(spark, sf)).select("ord", "title_key", "repo")


@query
def link_components_query(spark, sf):
    return link_components(_harvested_projects(spark, sf))


QUERIES["link_components"] = QUERIES.pop("link_components_query")


@query
def dedupe_projects(spark, sf):
    return mg.assign_clusters(_harvested_projects(spark, sf))


LATE = "de"  # a source that comes after the others and ranks before nearly all of them


def _keys_of(spark, sf, names=None) -> DataFrame:
    """Match keys of some sources, at the places they have among all."""
    every = b.sources(spark, sf)
    ranks = {s.name: r for r, s in hz.ranked(every)}
    return mg.match_keys(hz.harmonise([s for s in every if names is None or s.name in names], ranks)["projects"])


@query
def merge_increment(spark, sf):
    """All sources but one are merged, then the one that ranks first of them comes in."""
    path = StagingArea(spark, "merge-increment").path
    names = {s.name for s in b.sources(spark, sf)}
    inc.start(_keys_of(spark, sf, names - {LATE}), path)
    inc.update(spark, path, _keys_of(spark, sf, {LATE}))
    return inc.assignment(spark, path).select("ord", "label")


@query
def merge_decrement(spark, sf):
    """All sources are merged, then the records of one are taken out."""
    path = StagingArea(spark, "merge-decrement").path
    inc.start(_keys_of(spark, sf), path)
    inc.update(spark, path, removed=_keys_of(spark, sf, {LATE}).select("ord"))
    return inc.assignment(spark, path).select("ord", "label")


@query
def stable_ids(spark, sf):
    """Ids of clusters by document; then more sources come, and neighbouring documents become one cluster."""
    path = StagingArea(spark, "stable-ids").path
    rows = _harvested_projects(spark, sf).select("ord", "source_name", "local_id")

    def by(records, key):
        first = records.groupBy(key.alias("k")).agg(F.min("ord").alias("label"))
        return records.select("ord", key.alias("k")).join(first, "k").select("ord", "label")

    lgr.stable_ids(by(rows.where("source_name not in ('de', 'mirror_fr')"), F.col("local_id")), path)
    ids = lgr.stable_ids(by(rows, F.floor(F.col("local_id") / 2)), path)
    retired = lgr.forwarded(spark, path).groupBy(F.col("into").alias("id")).agg(F.count(F.lit(1)).alias("retired"))
    return ids.join(retired, "id", "left").select("label", "id", F.coalesce("retired", F.lit(0)).cast("bigint").alias("retired"))


def _by_document(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Records with an assignment that both engines can state: by document number."""
    rows = _harvested_projects(spark, sf)
    first = rows.groupBy("local_id").agg(F.min("ord").alias("label"))
    return rows, rows.select("ord", "local_id").join(first, "local_id").drop("local_id")


@query
def coalesce_first(spark, sf):
    rows, assignment = _by_document(spark, sf)
    return mg.coalesce_clusters(rows, assignment).select(
        "label", "members", "repository_id", "project_url", "title", "description", "doi",
        "download_date", "download_method",
    )


@query
def surrogate_ids(spark, sf):
    _, assignment = _by_document(spark, sf)
    return mg.surrogate_ids(assignment, StagingArea(spark, "surrogate_ids"))


@query
def dedupe_files(spark, sf):
    rows = b.files(spark, sf).withColumns(
        {"label": F.floor(F.col("project_id") / 50), "ord": F.col("id")}
    )
    return mg.dedupe_files(rows)


@query
def dedupe_keywords(spark, sf):
    rows = b.keywords(spark, sf).withColumns({"label": F.floor(F.col("project_id") / 20), "ord": F.col("id")})
    return mg.dedupe_values(rows, "keyword")


@query
def dedupe_person_role(spark, sf):
    rows = b.people(spark, sf).withColumns({"label": F.floor(F.col("project_id") / 3), "ord": F.col("id")})
    return mg.dedupe_person_role(rows)


@query
def dedupe_licenses(spark, sf):
    rows = b.licenses(spark, sf).withColumns({"label": F.col("project_id"), "ord": F.col("id")})
    return mg.dedupe_values(rows, "license")


@query
def dedupe_stats(spark, sf):
    _, assignment = _by_document(spark, sf)
    return mg.merge_stats(assignment)


@query
def merged_archive(spark, sf):
    """Catalogues to archive, end to end: (id, title, doi, number of keywords)."""
    archive = merge_sources(b.sources(spark, sf))
    counted = archive.keywords.groupBy(F.col("project_id").alias("id")).agg(F.count(F.lit(1)).alias("n_keywords"))
    return archive.projects.join(counted, "id", "left").select(
        "id", "members", "title", "doi", "project_url", "repository_id",
        F.coalesce("n_keywords", F.lit(0)).cast("bigint").alias("n_keywords"),
    )


# --- validation ---------------------------------------------------------------------------


def _tables(spark, sf) -> dict[str, DataFrame]:
    return {
        "projects": published("projects", b.projects(spark, sf)),
        "files": b.files(spark, sf),
        "person_role": b.people(spark, sf),
        "licenses": b.licenses(spark, sf),
    }


@query
def constraint_violations(spark, sf):
    return vd.constraint_violations(_tables(spark, sf))


@query
def duplicate_urls(spark, sf):
    rows = _harvested_projects(spark, sf)
    return vd.duplicate_urls(rows.withColumn("project_url", tx.url_key("project_url")))


@query
def gate(spark, sf):
    return vd.violation_report(_tables(spark, sf))


@query
def orphan_children(spark, sf):
    kept = b.projects(spark, sf).where(F.col("type") == "QD_PROJECT")
    return vd.orphan_children(b.licenses(spark, sf), kept).select("id", "project_id")


# --- project types and counts -------------------------------------------------------------


@query
def projects_summary(spark, sf):
    return pt.typed_summary(b.projects(spark, sf), b.files(spark, sf))


@query
def projects_summary_stored(spark, sf):
    return pt.projects_summary(b.projects(spark, sf), b.classified_files(spark, sf))


@query
def classify_project_type(spark, sf):
    return _typed_projects(spark, sf).select("id", "type")


@query
def type_tally(spark, sf):
    return pt.type_tally(_typed_projects(spark, sf), dim.type_labels_table(spark))


@query
def count_by_repository(spark, sf):
    return ct.count_by_repository(b.projects(spark, sf), b.repositories(spark)).select("repository", "n")


@query
def count_by_type(spark, sf):
    return ct.count_by_type(b.projects(spark, sf))


@query
def count_by_class(spark, sf):
    return ct.count_by_class(b.projects(spark, sf))


@query
def repo_class_counts(spark, sf):
    return ct.repo_class_counts(_cube(spark, sf)).select("repository", "primary_class", "n")


@query
def repo_type_counts(spark, sf):
    return ct.repo_type_counts(_cube(spark, sf))


@query
def repo_rollup(spark, sf):
    return ct.repo_rollup(_cube(spark, sf))


@query
def repo_file_class_counts(spark, sf):
    return _file_counts(spark, sf).select("repository", "primary_class", "n")


@query
def repo_key_facts(spark, sf):
    return _rounded(rp.repo_key_facts(_cube(spark, sf)), "top_share", "unclassified_share")


@query
def top_class(spark, sf):
    return _rounded(rp.repo_key_facts(_cube(spark, sf)), "top_share").select(
        "repository", "top_label", "top_n", "top_share"
    )


# --- ranks and folds ----------------------------------------------------------------------


@query
def rank_table(spark, sf):
    ranked = rk.rank_table(ct.repo_class_counts(_cube(spark, sf)), ["repository"])
    return ranked.select("repository", "rank", "primary_class", "n")


@query
def rank_table_scoped(spark, sf):
    return rp.rank_tables(_cube(spark, sf)).where("scope <> 'all'")


@query
def rank_table_files(spark, sf):
    return rp.file_rank_tables(_file_counts(spark, sf)).drop("scope")


@query
def fold_top_n(spark, sf):
    counts = ct.repo_class_counts(_cube(spark, sf))
    return rk.fold_into_other(counts, ["repository"], "primary_class")


@query
def fold_types(spark, sf):
    counts = ct.count_by_type(b.projects(spark, sf)).select(F.lit("type").alias("series"), "label", "n")
    return rk.fold_into_other(counts, ["series"], "label", len(dim.PROJECT_TYPES), tie="label")


@query
def fold_nonzero(spark, sf):
    return rp.type_donut(_cube(spark, sf))


@query
def bar_series(spark, sf):
    counts = ct.count_by_repository(b.projects(spark, sf), b.repositories(spark))
    return rk.bar_series(counts, "repository", StagingArea(spark, "bar_series"))


@query
def pie_shares(spark, sf):
    counts = ct.repo_class_counts(_cube(spark, sf))
    folded = rk.fold_into_other(counts, ["repository"], "primary_class")
    return _rounded(rk.with_share(folded, ["repository"]), "share")


# --- report -------------------------------------------------------------------------------


@query
def repo_narrative(spark, sf):
    out = rp.repo_narrative(_cube(spark, sf)).drop("narrative")
    return _rounded(out, *[c for c in out.columns if c.endswith("_share")])


@query
def repo_findings(spark, sf):
    return _rounded(rp.repo_findings(_cube(spark, sf)), "share")


@query
def repo_pies(spark, sf):
    return _rounded(rp.repo_pies(_cube(spark, sf)), "share")


@query
def repo_histograms(spark, sf):
    return rp.histograms(_cube(spark, sf), _file_counts(spark, sf)).drop("primary_class")


@query
def archive_series(spark, sf):
    return rp.archive_series(b.projects(spark, sf), b.repositories(spark))


@query
def report_blocks(spark, sf):
    cube, files = _cube(spark, sf), _file_counts(spark, sf)
    return rp.report_blocks(
        rp.rank_tables(cube), rp.file_rank_tables(files),
        rp.file_rank_tables(files, rk.TABLE_ROWS), dim.report_sections_table(spark),
    )


# --- taxonomy and text --------------------------------------------------------------------


def _division_usage(spark, sf) -> DataFrame:
    used = b.table(spark, sf, "orders").groupBy((F.col("o_custkey") % 87).alias("idx")).agg(F.count(F.lit(1)).alias("n"))
    return b.corpus(spark).join(F.broadcast(used), "idx", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


@query
def division_corpus(spark, sf):
    """Division texts with the number of projects each was assigned."""
    return _division_usage(spark, sf).select("idx", "text", "n")


@query
def division_label(spark, sf):
    """Label of the division each project points to."""
    labels = F.broadcast(b.corpus(spark).select("idx", "label"))
    orders = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 87).alias("idx"))
    return orders.join(labels, "idx").select("id", "label")


@query
def section_counts(spark, sf):
    return _division_usage(spark, sf).groupBy("section").agg(F.sum("n").alias("n"))


def _fragments(spark, sf) -> DataFrame:
    """Documents as projects with keywords, and the turns of the same number as files."""
    projects = b.texts(spark, sf).select(
        F.col("doc_id").alias("id"), F.nullif("source", F.lit("src4")).alias("title"), F.col("text").alias("description")
    )
    turns = b.table(spark, sf, "conversations").select(
        F.col("turn").alias("id"), F.col("conv_id").alias("project_id"), F.col("role").alias("file_name")
    )
    return tax.project_fragments(projects, b.keywords(spark, sf), turns)


@query
def project_text(spark, sf):
    return tax.project_text(_fragments(spark, sf))


@query
def project_nearest2(spark, sf):
    found = tax.classify_projects(_fragments(spark, sf), b.corpus(spark))
    return _rounded(found, "first_score", "second_score")


@query
def nearest2(spark, sf):
    vectors = b.table(spark, sf, "embeddings").select("vec_id", "embedding")
    refs = vectors.where("vec_id < 87").select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vector"))
    return _rounded(vec.nearest_two(vectors, "embedding", refs), "first_score", "second_score").drop("embedding")


@query
def nearest2_sparse(spark, sf):
    """References whose idx has gaps: every third vector, numbered by its id."""
    vectors = b.table(spark, sf, "embeddings").select("vec_id", "embedding")
    refs = vectors.where("vec_id % 3 = 1 and vec_id < 400").select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vector"))
    return _rounded(vec.nearest_two(vectors, "embedding", refs), "first_score", "second_score").drop("embedding")


@query
def embed_text(spark, sf):
    docs = b.texts(spark, sf).select("doc_id", vec.hashed_embedder()(F.col("text")).alias("v"))
    return docs.select("doc_id", F.array_join(F.transform("v", lambda x: x.cast("bigint").cast("string")), ",").alias("vector"))


@query
def cooccurrence(spark, sf):
    """How much more often than by chance the thousand most frequent words stand near each other."""
    docs = b.texts(spark, sf).select("text")
    vocabulary = co.frequent_words(docs, "text", 1000)
    pairs, _ = StagingArea(spark, "cooccurrence").write(co.near_pairs(docs, "text", vocabulary), "pairs")
    return co.associations(pairs, vocabulary).select(
        "word", "near", "n", F.round("pmi", 6).alias("pmi")
    )


@query
def file_candidates(spark, sf):
    found = pt.file_candidates(b.files(spark, sf), b.projects(spark, sf))
    return found.select("file_id", "text", "by_name")


@query
def file_nearest2(spark, sf):
    found = tax.classify_files(b.files(spark, sf), b.projects(spark, sf), b.corpus(spark))
    return found.where("by_name").drop("by_name")


@query
def file_class_fallback(spark, sf):
    found = pt.file_candidates(b.files(spark, sf), b.projects(spark, sf))
    return found.where(~F.col("by_name")).select(
        "file_id", F.col("project_primary").alias("primary_class"), F.col("project_secondary").alias("secondary_class")
    )


@query
def top_tags(spark, sf):
    return kw.top_tags(b.texts(spark, sf), "doc_id")


@query
def cosine_tags(spark, sf):
    """The tags that classify() gives, over all projects."""
    fragments = _fragments(spark, sf)
    return kw.nearest_tags(fragments, "project_id", tax.project_vectors(fragments))


@query
def detect_language(spark, sf):
    return b.texts(spark, sf).select("doc_id", lg.detect_language(F.col("text")).alias("detected"))


@query
def language_accuracy(spark, sf):
    return lg.detection_accuracy(b.texts(spark, sf), "text", "lang")


def _by_profiles(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Texts, and their languages by profiles learned from three quarters of them."""
    texts = b.texts(spark, sf)
    profiles, _ = StagingArea(spark, "profiles").write(pf.learn_profiles(texts.where("doc_id % 4 <> 2")), "profiles")
    return texts, pf.detect_by_profiles(texts, profiles)


@query
def detect_by_profiles(spark, sf):
    return _by_profiles(spark, sf)[1].select("doc_id", "detected", "score")


@query
def profile_accuracy(spark, sf):
    """Texts that no profile was learned from."""
    texts, found = _by_profiles(spark, sf)
    return pf.accuracy(found, texts.where("doc_id % 4 = 2"))


# --- scalar expressions -------------------------------------------------------------------


@query
def file_extensions(spark, sf):
    ext = fx.file_extension("file_type", "file_name")
    return b.files(spark, sf).groupBy(ext.alias("extension")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fx.counts_as_content("file_type", "file_name")).alias("content")
    )


@query
def file_stem_tokens(spark, sf):
    return b.files(spark, sf).select("id", F.array_join(fx.stem_tokens("file_name"), "|").alias("tokens"))


@query
def text_expressions(spark, sf):
    docs = b.texts(spark, sf)
    name = fx.safe_file_name(F.col("text"))
    return docs.select(
        "doc_id", tx.slug("text").alias("slug"), tx.shorten("text").alias("short"),
        name.alias("file_name"), fx.type_of_label("text").alias("label_type"),
    )
