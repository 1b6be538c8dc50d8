import json
import os

import pytest
from pyspark.sql import functions as F

from archiveloom import dimensions as dim
from archiveloom.operators import harmonise as hz
from archiveloom.plans.archive import merge_sources, rebuild
from archiveloom.sources import landing as ld
from archiveloom.sources.catalogues import from_databases, from_paths
from archiveloom.sources.links import harvest_links
from archiveloom.sources.worklist import Repository, first_hits, worklist
from archiveloom.staging import StagingArea, released
from archiveloom.streaming.landing import append_batch, append_new, landed_stream
from conftest import rows


def test_resolution_and_harmonised_schema(spark):
    a = spark.createDataFrame([(1, "T", "x")], "ID long, TITLE string, extra string")
    kids = spark.createDataFrame([(1, 1, "k"), (2, 9, "orphan")], "id long, Project_ID long, KEYWORD string")
    lame = spark.createDataFrame([(1, "k")], "id long, keyword string")
    sources = [
        hz.Source("b", {"projects": a, "Keywords": lame}),
        hz.Source("a", {"PROJECTS": a, "KEYWORDS": kids}),
        hz.Source("c", {"keywords": kids}),
    ]
    report = {(s, e): used for s, _, e, used in hz.resolution_report(sources)}
    assert report[("a", "projects")] and report[("a", "keywords")]
    assert not report[("b", "keywords")] and not report[("c", "keywords")] and not report[("c", "projects")]
    found = hz.harmonise(sources)
    assert rows(found["projects"].select("source_name", "source_rank", "title", "doi")) == [("a", 0, "T", None), ("b", 1, "T", None)]
    assert found["keywords"].count() == 2
    merged = merge_sources(sources)
    assert rows(merged.keywords.select("id", "project_id", "keyword")) == [(1, 1, "k")]


def test_repository_id_text_is_cast_or_null(spark):
    df = spark.createDataFrame([(1, "7"), (2, "seven")], "id long, repository_id string")
    got = hz.harmonise([hz.Source("s", {"projects": df})])["projects"]
    assert rows(got.select("local_id", "repository_id")) == [(1, 7), (2, None)]


def test_ids_of_any_value(spark):
    """Text, negative, very large and repeated ids are projects like any other; only a missing id is listed."""
    good = spark.createDataFrame(
        [("1", "One"), ("x9", "Text"), (None, "None"), ("-4", "Minus"), ("1", "Again"), (str(2**62), "Large"), ("x9", "Text too")], "ID string, title string"
    )
    kids = spark.createDataFrame(
        [("a", "1", "k1"), (None, "1", "k2"), (None, "1", "k2"), ("-1", "x9", "of text"), ("-1", "x8", "lost"), ("5", "-4", "of minus"), ("6", str(2**62), "of large"), ("7", None, "lost")],
        "id string, project_id string, keyword string",
    )
    archive = merge_sources([hz.Source("s", {"projects": good, "keywords": kids}), hz.Source("t", {"projects": good.where("ID = 'x9'")})])
    assert rows(archive.extras["rejects"]) == [("s", None, "no id")]
    assert rows(archive.projects.select("title")) == sorted([("Again",), ("One",), ("Text",), ("Minus",), ("Large",), ("Text too",)] + [("Text",), ("Text too",)])
    assert rows(archive.extras["stats"].select("sources", "records", "clusters")) == [(2, 8, 8)]
    titles = archive.projects.select(F.col("id").alias("project_id"), "title")
    found = rows(archive.keywords.join(titles, "project_id").select("keyword", "title"))
    assert [f for f in found if f[0][0] == "o"] == [("of large", "Large"), ("of minus", "Minus"), ("of text", dict(found)["of text"])]
    assert dict(found)["of text"] in ("Text", "Text too") and [f[0] for f in found if f[0][0] != "o"] == ["k1", "k2"]


def test_a_third_of_all_rows_repeats_one_id(spark):
    many = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 else id end as id", "concat('t', id) as title")
    archive = merge_sources([hz.Source("s", {"projects": many})])
    assert archive.projects.count() == 3000 and archive.extras["assignment"].select("ord").distinct().count() == 3000


def test_places_of_very_many_sources(spark):
    assert [hz.local_bits(n) for n in (1, 2, 2048, 2049, 5000, 1 << 20)] == [52, 52, 52, 51, 50, 43]
    bits = hz.local_bits(5000)
    top = spark.range(1).select(hz.row_order(4999, F.lit(hz.local_ids(bits) - 1), bits), hz.row_order(4999, F.lit(hz.local_ids(bits)), bits)).first()
    assert top[0] < 2**63 and top[0] >> bits == 4999 and top[1] is None


def test_children_without_ids_do_not_depend_on_the_split(spark):
    good = spark.createDataFrame([("1", "One")], "ID string, title string")
    kids = spark.createDataFrame([("a", "1", "k1"), (None, "1", "k2"), (None, "1", "k2")], "id string, project_id string, keyword string")
    # ids of children that have none do not depend on how the input is split
    ids = lambda n: rows(hz.harmonise([hz.Source("s", {"projects": good, "keywords": kids.repartition(n)})])["keywords"].select("keyword", "ord"))
    assert ids(1) == ids(5)


def test_merge_sources_end_to_end(spark):
    first = spark.createDataFrame(
        [(1, "http://a/1/", None, "One", 1), (2, None, "10.1/b", "Two", 1)],
        "id long, project_url string, doi string, title string, repository_id long",
    )
    second = spark.createDataFrame(
        [(1, "HTTP://A/1", "10.1/a", "uno", 2), (7, "http://new", None, "Three", 2)],
        "id long, project_url string, doi string, title string, repository_id long",
    )
    files1 = spark.createDataFrame([(1, 1, "a.pdf", None, None)], "id long, project_id long, file_name string, file_type string, status string")
    files2 = spark.createDataFrame([(1, 1, "A.PDF", "pdf", "SUCCEEDED"), (2, 7, "b", "", "")], files1.schema)
    archive = merge_sources([
        hz.Source("2", {"projects": second, "files": files2}), hz.Source("1", {"projects": first, "files": files1}),
    ])
    assert rows(archive.projects.select("id", "project_url", "doi", "title", "members")) == [
        (1, "http://a/1/", "10.1/a", "One", 2), (2, None, "10.1/b", "Two", 1), (3, "http://new", None, "Three", 1)]
    assert rows(archive.files) == [(1, 1, "a.pdf", "pdf", "SUCCEEDED"), (2, 3, "b", "", "")]
    assert tuple(archive.extras["stats"].first()) == (2, 4, 3)
    assert "tags" in rebuild(archive).projects.columns
    with pytest.raises(ValueError):
        merge_sources([hz.Source("1", {"projects": first})], mode="loose")
    closed = merge_sources([hz.Source("1", {"projects": first}), hz.Source("2", {"projects": second})], mode="closure")
    assert closed.projects.count() == 3


def test_databases_and_paths(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, title string")
    df.write.parquet(f"{tmp_path}/p")
    (by_path,) = from_paths(spark, {"s": {"projects": f"{tmp_path}/p"}})
    assert rows(by_path.tables["projects"]) == [(1, "a")]
    spark.sql("create database one_catalogue")
    df.write.saveAsTable("one_catalogue.projects")
    (by_name,) = from_databases(spark, ["one_catalogue"])
    assert by_name.name == "one_catalogue" and rows(by_name.tables["projects"]) == [(1, "a")]


def dataverse(**over):
    doc = {
        "query": "q",
        "item": {"global_id": "doi:10.7/AB/cd", "name": "N", "description": "the and of", "publisher": "X", "published_at": "2024-01-02T03"},
        "version": {
            "versionNumber": 2, "versionMinorNumber": 1, "releaseTime": "2023-05-06T07:08:09Z",
            "license": {"name": "CC0"},
            "files": [{"label": "a.b.PDF", "dataFile": {"id": 5}}, {"dataFile": {"id": 6}}],
            "metadataBlocks": {"citation": {"fields": [
                {"typeName": "author", "value": [{"authorName": {"value": "Ann"}}, {"authorName": {"value": ""}}, {}]},
                {"typeName": "depositor", "value": "Dee"},
                {"typeName": "keyword", "value": [{"keywordValue": {"value": "k1"}}]},
                {"typeName": "keyword", "value": [{"keywordValue": {"value": "ignored"}}]},
            ]}},
        },
    }
    doc.update(over)
    return json.dumps(doc)


def test_dataverse_records(spark):
    murray = json.loads(dataverse())["item"] | {"publisher": "The Murray Center"}
    bare = {"global_id": "doi:10.7/z", "name": "M", "description": "d"}
    landed = spark.createDataFrame(
        [(1, dataverse()), (2, dataverse(item=murray)), (3, '{"query": "q", "item": {'), (4, dataverse(item={"global_id": "g", "name": "n"})),
         (5, json.dumps({"query": "q", "item": bare, "version": {}}))],
        "record_id long, json string",
    )
    out = ld.parse_dataverse(landed, "https://dv")
    p = {r.record_id: r for r in out["projects"].collect()}
    assert set(p) == {1, 2, 5}
    assert (p[1].project_url, p[1].doi) == ("https://dv/dataset.xhtml?persistentId=doi:10.7/AB/cd", "https://doi.org/10.7/AB/cd")
    assert (p[1].version, p[1].download_version_folder, p[1].download_project_folder) == ("2.1", "v2.1", "cd")
    assert (p[1].language, p[1].upload_date, p[1].repository_id) == ("en", "2023-05-06", 10)
    assert (p[2].repository_id, p[2].download_repository_folder) == (18, "harvard-murray")
    assert p[2].repository_url == "https://www.murray.harvard.edu/dataverse"
    assert rows(out["files"].where("record_id = 1").select("file_name", "file_type", "file_ref", "status")) == [
        ("a.b.PDF", "pdf", "5", "SUCCEEDED"), ("unknown", "unknown", "6", "SUCCEEDED")]
    assert rows(out["keywords"].where("record_id = 1").select("keyword")) == [("k1",)]
    assert rows(out["person_role"].where("record_id = 1").select("name", "role")) == [("Ann", "AUTHOR"), ("Dee", "UPLOADER")]
    assert rows(out["licenses"].select("record_id", "license")) == [(1, "CC0"), (2, "CC0")]
    assert rows(out["failures"]) == [(3, "malformed record"), (4, "missing description")]


def test_nada_records(spark):
    names = lambda *ns: [{"name": n} for n in ns]
    doc = {
        "query": "q", "id": 712,
        "doc_desc": {"version_statement": {"version": "Version 02"}, "prod_date": "2011-01", "producers": names("Pro", "")},
        "study_desc": {
            "title_statement": {"idno": "A/B/1", "title": "T"},
            "study_info": {"abstract": "coal coal mine", "notes": "coal notes ", "data_kind": "Survey"},
            "data_access": {"dataset_use": {"cit_req": "See https://doi.org/10.1/x now", "conditions": "Open"}},
            "authoring_entity": names("Auth"), "production_statement": {"funding_agencies": names("Fund")},
            "distribution_statement": {"contact": names("Con")},
        },
        "scraped_files_list": [{"download_url": "u1", "name": "My (file)"}],
    }
    bare = {"id": 1, "study_desc": {"title_statement": {"title": "B"}, "study_info": {"abstract": "x", "data_kind": None}}}
    landed = spark.createDataFrame([(1, json.dumps(doc)), (2, json.dumps(bare)), (3, "{}")], "record_id long, json string")
    out = ld.parse_nada(landed, "https://site")
    p = {r.record_id: r for r in out["projects"].collect()}
    assert (p[1].version, p[1].doi, p[1].download_project_folder) == ("2.0", "https://doi.org/10.1/x", "A_B_1")
    assert (p[2].version, p[2].download_version_folder, p[2].download_project_folder) == (None, None, "1")
    assert rows(out["person_role"].select("name", "role")) == [("Auth", "AUTHOR"), ("Con", "UPLOADER"), ("Fund", "OWNER"), ("Pro", "OWNER")]
    assert rows(out["files"].select("file_name", "file_type", "status")) == [("My file.pdf", "pdf", None)]
    assert {r.keyword for r in out["keywords"].collect()} == {"coal", "mine", "notes", "Survey"}
    assert rows(out["licenses"]) == [(1, "Open")]
    assert rows(out["failures"].select("record_id")) == [(3,)]


def test_landed_records_to_archive(spark, tmp_path):
    """From landed JSON through merge, cleaning, typing and reports in one run."""
    import archiveloom as al
    from archiveloom import dimensions as dim
    from archiveloom.operators.taxonomy import division_corpus

    landed = spark.createDataFrame([(1, dataverse()), (2, dataverse())], "record_id long, json string")
    parsed = al.parse_landed(landed, "dataverse", "https://dv")
    log = spark.createDataFrame([(1, "5", 403), (1, "6", None)], "record_id long, file_ref string, http_status int")
    parsed["files"] = ld.with_fetch_log(parsed["files"], log)
    assert rows(parsed["files"].select("record_id", "file_ref", "status")) == [
        (1, "5", "FAILED_LOGIN_REQUIRED"), (1, "6", "FAILED_SERVER_UNRESPONSIVE"), (2, "5", "SUCCEEDED"), (2, "6", "SUCCEEDED")]
    archive = al.rebuild(al.clean(al.merge_sources([al.as_source("dv", parsed)])))
    assert archive.projects.count() == 1 and archive.files.count() == 2 and archive.person_role.count() == 2
    typed = al.classify_project_type(archive.projects, archive.files)
    assert typed.first().type == "QD_PROJECT"
    corpus = division_corpus(dim.divisions_table(spark), dim.sections_table(spark))
    projects, files = al.classify(typed, archive.keywords, archive.files, corpus)
    done = archive.with_tables(projects=projects, files=files)
    assert al.publish(done, f"{tmp_path}/archive", apply=True) == []
    stored = al.read_tables(spark, f"{tmp_path}/archive")
    project = stored.projects.first()
    assert (project.id, project.type, str(project.upload_date)) == (1, "QD_PROJECT", "2023-05-06")
    assert project.primary_class and project.secondary_class and "k1" in project.tags
    # the one primary data file has a name of too few words and takes its project's class
    assert rows(stored.files.select("file_name", "primary_class")) == [("a.b.PDF", project.primary_class), ("unknown", None)]
    report = al.repo_report(stored.projects, stored.files, dim.repositories_table(spark))
    assert rows(report["rank_tables"].where("scope = 'qd'")) == [("harvard-dataverse", "qd", 1, project.primary_class, 1)]
    al.write_repo_report(report, f"{tmp_path}/report")
    text = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/report/findings").collect())
    assert "- QD: 1 (100.0%)" in text and project.primary_class in text
    with pytest.raises(ValueError):
        al.parse_landed(landed, "other", "")


def test_marker_per_project(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(7, '<a href="/catalog/7/download/1">a</a><a href="/catalog/8/download/1">b</a>')], "page_id long, html string")
    marker = F.concat(F.lit("/catalog/"), F.col("page_id").cast("string"), F.lit("/download/"))
    assert rows(harvest_links(pages, "s", marker)) == [(7, "s/catalog/7/download/1", "a")]


def test_envelopes(spark):
    responses = spark.createDataFrame(
        [(1, '{"data": {"items": [{"global_id": "g1"}, {"idno": "i", "global_id": "g2"}]}}'),
         (2, '{"result": {"rows": [{"idno": "r"}]}}'), (3, "{}"), (4, "<html>")],
        "page long, json string",
    )
    hits = ld.unwrap_hits(responses, "struct<idno: string, global_id: string>")
    got = hits.select("page", "hit_no", ld.lookup_id(hits["hit.idno"], hits["hit.global_id"]).alias("id"))
    assert rows(got) == [(1, 0, "g1"), (1, 1, "i"), (2, 0, "r")]


def test_links(spark):
    html = (
        '<a href="/catalog/1/download/9" title="Data &amp; more">x</a>'
        "<A class='b' HREF='http://other/download/2'> <b>Two</b>\n words </A>"
        '<a href="/catalog/1/download/9">again</a><a href="/elsewhere">no</a><a name="x">no href</a>'
        '<a href="/catalog/1/download/7"></a>'
        "<!-- <a href='/download/hidden'>no</a> --><script>x = \"<a href='/download/script'>\"</script>"
        "<a class=x href=/download/bare title='it is \"so\"'>t</a>"
        "<a href=\"/download/it's\">open one<a data-href='/download/data' href='/no'>n</a>"
    )
    pages = spark.createDataFrame([(1, html), (2, "")], "page_id long, html string")
    got = rows(harvest_links(pages, "https://site"))
    assert got == [
        (1, "http://other/download/2", "Two\n words"),
        (1, "https://site/catalog/1/download/7", "7"),
        (1, "https://site/catalog/1/download/9", "Data & more"),
        (1, "https://site/download/bare", 'it is "so"'),
        (1, "https://site/download/it's", "open one"),
    ]


def test_worklist_and_hits(spark):
    terms = spark.createDataFrame([("a",), ("b",)], "term string")
    repos = [Repository("x", "https://x", "t"), Repository("y", None, "t"), Repository("z", "https://z", "")]
    assert rows(worklist(terms, repos)) == [("a", "x", "https://x"), ("b", "x", "https://x")]
    assert worklist(terms, repos[1:]).count() == 0
    hits = spark.range(60).selectExpr("id % 2 as term", "id as place")
    kept = first_hits(hits, ["term"], ["place"])
    assert kept.count() == 50 and kept.agg({"hit_rank": "max"}).first()[0] == 25


def test_incremental_projects(spark):
    incoming = spark.createDataFrame([(1, "u"), (2, "v"), (3, "v"), (4, None)], "ord long, project_url string")
    known = spark.createDataFrame([("u",)], "project_url string")
    assert rows(ld.new_projects(incoming, known).select("ord", "project_url")) == [(2, "v")]


def test_a_batch_run_twice_stores_the_same(spark, tmp_path):
    landed = spark.createDataFrame([(1, dataverse())], "record_id long, json string")
    parse = lambda df: ld.parse_dataverse(df, "https://dv")
    empty = parse(landed.limit(0))["projects"].selectExpr("*", "record_id as ord")
    empty.write.parquet(f"{tmp_path}/s/projects/batch=-1")
    for _ in range(2):
        append_batch(landed, parse, f"{tmp_path}/s", 0)
    append_batch(landed, parse, f"{tmp_path}/s", 1)
    assert spark.read.parquet(f"{tmp_path}/s/projects").count() == 1
    assert spark.read.parquet(f"{tmp_path}/s/person_role").count() == 2


def test_landed_stream_appends_each_project_once(spark, tmp_path):
    landing, stored, state = (str(tmp_path / n) for n in ("landing", "stored", "state"))
    parse = lambda df: ld.parse_dataverse(df, "https://dv")
    item = lambda n: {"global_id": f"doi:10.7/{n}", "name": "N", "description": "d"}

    def land(first, ids):
        data = [(first + i, dataverse(item=item(n))) for i, n in enumerate(ids)]
        spark.createDataFrame(data, "record_id long, json string").coalesce(1).write.mode("append").parquet(landing)
        query = append_new(landed_stream(spark, landing), parse, stored).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination(120)

    land(1, ["a", "b", "a"])
    land(10, ["b", "c"])
    got = spark.read.parquet(f"{stored}/projects")
    assert rows(got.select("record_id", "doi")) == [
        (1, "https://doi.org/10.7/a"), (2, "https://doi.org/10.7/b"), (11, "https://doi.org/10.7/c")]
    assert rows(spark.read.parquet(f"{stored}/person_role").select("record_id", "name")) == [
        (n, name) for n in (1, 2, 11) for name in ("Ann", "Dee")]


def test_links_are_read_as_a_parser_does(spark):
    pages = spark.createDataFrame(
        [
            (1, '<a title="a > b" href="/download/2">x</a>'), (2, "<a href='/download/3'>R&eacute;sum&#233; &#x41;&amp;lt; &nope; &#0;</a>"),
            (3, '<a href=/download/4></a><a data-x="\'>" href="/download/5">two</a>'), (4, '<a href="/download/6" title="it\'s">one <b title=">">bold</b></a>'),
            (5, None), (6, ""), (7, '<a href="/download/7">open<a href="/download/8">next'),
        ],
        "page_id int, html string",
    )
    assert rows(harvest_links(pages, "s")) == [
        (1, "s/download/2", "a > b"), (2, "s/download/3", "Résumé A&lt; &nope; \ufffd"), (3, "s/download/4", "4"), (3, "s/download/5", "two"),
        (4, "s/download/6", "it's"), (7, "s/download/7", "open"), (7, "s/download/8", "next"),
    ]


def test_each_record_is_parsed_once_and_edges_of_nada(spark):
    import archiveloom as al

    study = lambda version, **more: json.dumps({
        "query": "q", "doc_desc": {"version_statement": {"version": version}},
        "study_desc": {"title_statement": {"idno": "A/1", "title": "t"}, "study_info": {"abstract": "the and of"}}, **more,
    })
    links = [{"download_url": "u/1", "name": "a.pdf"}, {"download_url": "u/2", "name": "film.mp4"}]
    landed = spark.createDataFrame(
        [(1, study("version 0", id="9", scraped_files_list=links)), (2, study("version 2")), (3, study("v3", id="7"))], "record_id long, json string"
    )
    log = spark.createDataFrame([(1, "u/1", 403)], "record_id long, file_ref string, http_status int")
    with released():
        out = al.parse_landed(landed, "nada", "https://site", fetch_log=log)
        assert "from_json" not in out["projects"]._jdf.queryExecution().optimizedPlan().toString()
        assert rows(out["projects"].select("record_id", "version", "download_version_folder")) == [(1, "0.0", None), (3, "3.0", "v3.0")]
        assert rows(out["failures"]) == [(2, "missing id")]
        assert rows(out["files"].select("file_ref", "status")) == [("u/1", "FAILED_LOGIN_REQUIRED")]
        staged = StagingArea(spark, "x").path.rsplit("/", 1)[0]
        assert any(f.startswith("landed-nada") for f in os.listdir(staged.removeprefix("file://")))
    assert not any(f.startswith("landed-nada") for f in os.listdir(staged.removeprefix("file://")))
    no_url = spark.createDataFrame([(1, 1, None), (2, 2, "u")], "record_id long, ord long, project_url string")
    assert rows(ld.without_url(no_url)) == [(1, "missing project_url")]


def test_worklist_of_the_acquisition_terms(spark):
    asked = worklist(dim.query_terms_table(spark).toDF("term"), [Repository("a", "http://a", "t"), Repository("b", None, "t")])
    assert asked.count() == len(dim.QUERY_TERMS) and {r.repository for r in asked.collect()} == {"a"}
