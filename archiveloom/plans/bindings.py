"""The entities of an archive, read out of the driver's test tables.

Each function gives one entity as a DataFrame over whole tables. ``oracle.py`` states the
same bindings in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators.harmonise import LOCAL_BITS, Source
from archiveloom.operators.taxonomy import division_corpus
from archiveloom.staging import StagingArea

LANGUAGES = ("de", "en", "es", "fr")
# classes used by the bindings: 0 is none, n is the n-th division counted from 0
CLASSES, SECONDARY_CLASSES, REPOSITORIES = 45, 30, 22
EXTENSIONS = ("pdf", "DOCX", "csv", "qdpx", "nvp", "tmp", "log", "xlsx", "sav", "txt", "mp3", "")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# A task takes so much of a table of texts at most, as far as row groups allow: what a text is split
# into takes many times its compressed size, and must fit the memory that a task has for sorting.
SPLIT_SETTING, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 16 << 20
DEFAULT_SPLIT = "134217728b"


def small_splits(spark: SparkSession) -> None:
    """Bound what a task reads, unless the session does."""
    if spark.conf.get(SPLIT_SETTING) == DEFAULT_SPLIT:
        spark.conf.set(SPLIT_SETTING, f"{SPLIT_BYTES}b")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for work that is heavy per row, spread over all cores.

    The test table is one file with one row group, which a scan reads in a single task.
    """
    small_splits(spark)
    docs = table(spark, sf, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def corpus(spark: SparkSession) -> DataFrame:
    return division_corpus(dim.divisions_table(spark), dim.sections_table(spark))


def repositories(spark: SparkSession) -> DataFrame:
    return dim.repositories_table(spark)


def pick(key: Column, values: tuple) -> Column:
    """``values[key]`` with a literal array; key counts from 0."""
    return F.array(*[F.lit(v) for v in values])[key.cast("int")]


def title_line() -> Column:
    """The first line of a text stands in for a title; the whole text is the description."""
    return F.split_part("text", F.lit("\n"), F.lit(1))


# --- classified archive: orders as projects, lineitem as files --------------------------

TYPES = (None, "", "QDA_PROJECT", "QD_PROJECT", "OTHER_PROJECT", "NOT_A_PROJECT", "LEGACY")


def projects(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as projects: repository ids 21 and 22 are unknown, some types and classes missing."""
    labels = corpus(spark).select("idx", "label")
    named = lambda alias: F.broadcast(labels.select(F.col("idx").alias(f"_{alias}"), F.col("label").alias(alias)))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % REPOSITORIES + 1).alias("repository_id"),
        F.concat_ws(" ", "o_orderpriority", "o_orderkey").alias("title"),
        pick(F.col("o_orderkey") % len(TYPES), TYPES).alias("type"),
        F.nullif(F.col("o_custkey") % CLASSES, F.lit(0)).alias("_primary_class"),
        F.nullif(F.col("o_custkey") % SECONDARY_CLASSES, F.lit(0)).alias("_secondary_class"),
    )
    return (
        orders.join(named("primary_class"), "_primary_class", "left")
        .join(named("secondary_class"), "_secondary_class", "left")
        .drop("_primary_class", "_secondary_class")
    )


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem as files: names from parts, twelve extensions, missing types, a bad status."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    ext = pick(F.col("l_partkey") % len(EXTENSIONS), EXTENSIONS)
    stem = F.when(F.col("l_linenumber") % 4 == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(
        F.replace("p_name", F.lit(" "), F.lit("_"))
    )
    return (
        table(spark, sf, "lineitem")
        .join(parts, "l_partkey")
        .select(
            (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 10000
             + F.col("l_suppkey")).alias("id"),
            F.col("l_orderkey").alias("project_id"),
            F.when(ext == "", stem).otherwise(F.concat(stem, F.lit("."), ext)).alias("file_name"),
            F.when(F.col("l_suppkey") % 3 == 1, F.lit(""))
            .when(F.col("l_suppkey") % 3 == 2, F.concat(F.lit("."), ext))
            .alias("file_type"),
            F.when(F.col("l_returnflag") == "A", "SUCCEEDED")
            .when(F.col("l_returnflag") == "N", "FAILED_LOGIN_REQUIRED")
            .otherwise("ERROR 500")
            .alias("status"),
            F.when(F.col("l_partkey") % 7 > 0, F.col("l_partkey") % CLASSES).alias("_class"),
        )
    )


def classified_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files with a primary class, missing for every seventh part."""
    labels = corpus(spark).select(F.col("idx").alias("_class"), F.col("label").alias("primary_class"))
    return files(spark, sf).join(F.broadcast(labels), "_class", "left").drop("_class")


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of conversations as people; an unclean role and a missing one."""
    return table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("conv_id").alias("project_id"),
        F.concat("role", (F.col("turn") % 3).cast("string")).alias("name"),
        F.when(F.col("role") == "user", "uploader").when(F.col("role") == "assistant", "AUTHOR").alias("role"),
    )


def licenses(spark: SparkSession, sf: str) -> DataFrame:
    """Order priorities as licenses, eight orders to a project, in two spellings."""
    odd = F.col("o_orderkey") % 2 == 1
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.floor(F.col("o_orderkey") / 8).alias("project_id"),
        F.when(odd, F.concat(F.col("o_orderpriority"), F.lit(" ")))
        .otherwise(F.lower("o_orderpriority"))
        .alias("license"),
    )


# --- harvested catalogues: documents as projects ---------------------------------------


def harvested(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the URL of the page of the same number, where there is one.

    What is cut out of a text is cut before the join, which then moves texts only where they are read.
    """
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url")
    doc = F.col("doc_id")
    text_id = F.md5("text")
    records = table(spark, sf, "documents").select(
        "doc_id", "lang", "text",
        (F.substring("source", 4, 10).cast("bigint") + 1).alias("repository_id"),
        F.when(doc % 5 != 0, F.concat(F.lit("10.5072/"), text_id)).alias("doi"),
        title_line().alias("title"),
    )
    return records.join(pages, "doc_id", "left").select(
        "doc_id", "lang", "text", "url", "repository_id", "doi", "title",
        pick(doc % 6, ("API", "api", "SCRAPING", "API-CALL", "x", None)).alias("method"),
        F.when(doc % 11 != 0, F.lit("2024-05-01T00:00:00")).alias("download_date"),
    )


def originals(records: DataFrame, lang: str) -> DataFrame:
    """The catalogue of a language; column names differ in case, some are extra."""
    return records.where(F.col("lang") == lang).select(
        F.col("doc_id").alias("ID"), F.col("title").alias("Title"), F.col("text").alias("description"),
        F.col("url").alias("PROJECT_URL"), F.col("doi").alias("Doi"), "repository_id",
        F.col("method").alias("download_method"), "download_date", F.lit("unused").alias("remark"),
    )


def mirrored(records: DataFrame, lang: str) -> DataFrame:
    """A second catalogue of the same projects: other spellings, more gaps, fewer columns."""
    doc = F.col("doc_id")
    url = F.when(F.col("url").isNotNull(), F.concat(F.lit(" "), F.upper("url"), F.lit("/"))).when(
        doc % 4 == 0, F.lit("")
    )
    return records.where(F.col("lang") == lang).select(
        F.col("doc_id").alias("id"),
        F.concat(F.translate("title", "abcdefghijklm", "ABCDEFGHIJKLM"), F.lit("  ")).alias("title"),
        url.alias("project_url"),
        F.when(doc % 4 == 1, F.upper("doi")).alias("doi"),
        F.when(doc % 2 == 1, F.col("repository_id").cast("string")).alias("repository_id"),
    )


def keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of every document as a keyword, in original case."""
    return (
        texts(spark, sf)
        .select("doc_id", "lang", F.posexplode(F.split("text", r"\s+")).alias("pos", "keyword"))
        .select(
            (F.col("doc_id") * 1_000_000 + F.col("pos")).alias("id"), F.col("doc_id").alias("project_id"),
            "keyword", "lang",
        )
    )


def sources(spark: SparkSession, sf: str) -> list[Source]:
    """Eight catalogues, handed over out of order.

    Table names differ in case; one catalogue has no projects table and is skipped, and one
    keyword table lacks its parent column.
    """
    records, words = harvested(spark, sf), keywords(spark, sf)
    found = []
    for lang in reversed(LANGUAGES):
        own = words.where(F.col("lang") == lang).drop("lang")
        if lang == "fr":
            own = own.drop("project_id")
        found.append(Source(lang, {"PROJECTS": originals(records, lang), "Keywords": own}))
        found.append(Source(f"mirror_{lang}", {"projects": mirrored(records, lang), "keywords": own}))
    found.append(Source("a_list", {"project_list": originals(records, "en"), "keywords": words}))
    return found


def order_of(rank: Column, local_id: Column) -> Column:
    return F.shiftleft(rank.cast("bigint"), LOCAL_BITS) + local_id


# --- landed responses -------------------------------------------------------------------


def _json(c: Column) -> Column:
    return F.to_json(c)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'{{"typeName":"{name}","value":'), value, F.lit("}"))


def landed_dataverse(spark: SparkSession, sf: str) -> DataFrame:
    """One landed record per document; every tenth is cut off and every tenth lacks its description."""
    doc = F.col("doc_id")
    key = F.md5("text")
    item = F.struct(
        F.concat(F.lit("doi:10.5072/FK2/"), key).alias("global_id"),
        title_line().alias("name"),
        F.when(doc % 10 != 5, F.col("text")).alias("description"),
        F.when(F.col("source") == "src3", F.lit("Henry A. MURRAY Archive")).otherwise(F.col("source")).alias("publisher"),
        F.lit("2024-02-03T10:00:00Z").alias("published_at"),
    )
    keyword = F.transform(F.split("text", r"\s+"), lambda w: F.struct(F.struct(w.alias("value")).alias("keywordValue")))
    author = F.array(F.struct(F.struct(F.concat(F.lit("Author "), "lang").alias("value")).alias("authorName")))
    contact = F.array(F.struct(F.struct(F.nullif("source", F.lit("src1")).alias("value")).alias("datasetContactName")))
    fields = F.concat_ws(
        ",",
        _field("keyword", _json(keyword)),
        _field("author", _json(author)),
        _field("datasetContact", _json(contact)),
        F.when(doc % 3 == 0, _field("depositor", F.concat(F.lit('"Depositor '), (doc % 7).cast("string"), F.lit('"')))),
        F.when(doc % 2 == 0, _field("language", F.concat(F.lit('["'), "lang", F.lit('"]')))),
        _field("keyword", F.lit('[{"keywordValue":{"value":"second entry, never read"}}]')),
    )
    label = lambda c: F.struct(c.alias("label"), F.struct(doc.cast("string").alias("id")).alias("dataFile"))
    files_ = F.array(
        label(F.concat(F.lit("Interview "), doc.cast("string"), F.lit(".v1.PDF"))),
        label(F.when(doc % 9 != 0, F.lit("readme"))),
    )
    version = F.concat(
        F.lit('{"versionNumber":'), (doc % 5 + 1).cast("string"),
        F.lit(',"versionMinorNumber":'), (doc % 3).cast("string"),
        F.when(doc % 4 != 0, F.lit(',"releaseTime":"2023-06-07T08:09:10Z"')).otherwise(F.lit("")),
        F.lit(',"license":'), _json(F.struct(F.when(doc % 6 != 0, F.col("source")).alias("name"))),
        F.lit(',"files":'), _json(files_),
        F.lit(',"metadataBlocks":{"citation":{"fields":['), fields, F.lit("]}}}"),
    )
    whole = F.concat(F.lit('{"query":"'), "lang", F.lit('","item":'), _json(item), F.lit(',"version":'), version, F.lit("}"))
    json = F.when(doc % 10 == 3, F.substring(whole, 1, 30)).otherwise(whole)
    return texts(spark, sf).select(doc.alias("record_id"), json.alias("json"))


def landed_nada(spark: SparkSession, sf: str) -> DataFrame:
    """One landed study per document."""
    doc = F.col("doc_id")
    names = lambda *cs: F.array(*[F.struct(c.alias("name")) for c in cs])
    body = F.struct(
        F.col("lang").alias("query"),
        doc.cast("string").alias("id"),
        F.struct(
            F.struct(
                pick(doc % 4, ("Version 03", "v2 (public)", "final", None)).alias("version")
            ).alias("version_statement"),
            F.lit("2020-01-02").alias("prod_date"),
            names(F.col("source"), F.lit("")).alias("producers"),
        ).alias("doc_desc"),
        F.struct(
            F.struct(
                F.when(doc % 3 != 0, F.concat(F.lit("DDI/"), doc.cast("string"), F.lit("/x"))).alias("idno"),
                title_line().alias("title"),
            ).alias("title_statement"),
            F.struct(
                F.col("text").alias("abstract"),
                F.when(doc % 2 == 0, F.concat("source", F.lit(" field notes "))).alias("notes"),
                F.when(doc % 5 != 0, F.concat(F.lit("Kind "), "lang")).alias("data_kind"),
            ).alias("study_info"),
            F.struct(
                F.struct(
                    F.concat(
                        F.lit("Cite as "),
                        F.when(doc % 7 != 0, F.concat(F.lit("https://doi.org/10.5072/"), doc.cast("string"))).otherwise(""),
                        F.lit(" please"),
                    ).alias("cit_req"),
                    F.when(doc % 8 != 0, F.lit("Licensed")).alias("conditions"),
                ).alias("dataset_use")
            ).alias("data_access"),
            names(F.concat(F.lit("Author "), "lang")).alias("authoring_entity"),
            F.struct(names(F.lit("Fund")).alias("funding_agencies")).alias("production_statement"),
            F.struct(names(F.nullif("source", F.lit("src2"))).alias("contact")).alias("distribution_statement"),
        ).alias("study_desc"),
        F.array(
            F.struct(
                F.concat(F.lit("https://site/catalog/"), doc.cast("string"), F.lit("/download/1")).alias("download_url"),
                F.concat(F.lit("Report: "), "lang", F.lit(" (é) #"), doc.cast("string")).alias("name"),
            ),
            F.struct(
                F.concat(F.lit("https://site/catalog/"), doc.cast("string"), F.lit("/download/2")).alias("download_url"),
                F.lit("data*set.CSV ").alias("name"),
            ),
        ).alias("scraped_files_list"),
    )
    return texts(spark, sf).select(doc.alias("record_id"), _json(body).alias("json"))


def landed_resources(spark: SparkSession, sf: str) -> DataFrame:
    """One resource list per document, of a named or titled resource and one with an id alone."""
    doc = F.col("doc_id")
    number = doc.cast("string")
    titled = F.struct(
        (doc * 10).cast("string").alias("resource_id"), F.lit("9").alias("id"),
        F.when(doc % 3 == 0, F.concat(F.lit("data "), number, F.lit(".csv"))).otherwise("").alias("filename"),
        F.concat(F.lit("Codebook (A): "), number).alias("title"),
    )
    bare = F.struct(
        F.lit("").alias("resource_id"), (doc * 10 + 1).cast("string").alias("id"), F.lit("").alias("filename"), F.lit("").alias("title")
    )
    body = F.struct(F.array(titled, bare).alias("resources"))
    return texts(spark, sf).select(doc.alias("record_id"), _json(body).alias("json"))


def folders(spark: SparkSession, sf: str, staging: StagingArea) -> dict[str, dict[str, str]]:
    """The tables of :func:`sources` written as folders: {source: {table: path}}."""
    found: dict[str, dict[str, str]] = {}
    for source in sources(spark, sf):
        for name, df in source.tables.items():
            path = f"{staging.path}/{source.name}/{name}"
            df.write.parquet(path)
            found.setdefault(source.name, {})[name] = path
    return found


def landed_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Search responses, two hits per document, in two envelopes; some without hits."""
    doc = F.col("doc_id")
    hit = lambda i: F.struct(
        F.when((doc + i) % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(f"ID{i}-"), doc.cast("string"))).alias("idno"),
        F.concat(F.lit(f"doi:{i}/"), doc.cast("string")).alias("global_id"),
        (doc * 10 + i).alias("id"),
        pick((doc + i) % 3, (9, 10, None)).cast("bigint").alias("repository_id"),
        F.col("text").alias("name"),
    )
    hits = F.array(hit(0), hit(1))
    json = (
        F.when(doc % 7 == 0, F.lit("{}"))
        .when(doc % 2 == 0, _json(F.struct(F.struct(hits.alias("items")).alias("data"))))
        .otherwise(_json(F.struct(F.struct(hits.alias("rows")).alias("result"))))
    )
    return texts(spark, sf).select("doc_id", json.alias("json"))
