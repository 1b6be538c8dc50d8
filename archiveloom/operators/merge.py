"""Order-exact merge of project records, as rounds of joins and aggregates.

The rule, record by record in ``ord``: a record joins the cluster that owns its URL key,
else its DOI key, else its (title, repository) key, and otherwise opens a cluster. A cluster
keeps, per field, the first non-NULL value of its members, and owns the keys of *those*
values (first owner wins). A member's own URL is thus not a key of its cluster when the
cluster already had one, and two clusters never join: this is not transitive closure.

What a record joins depends only on earlier records. So the rule is a fixpoint: given any
assignment, the key owners follow by aggregation, and given the owners every record's
cluster follows by a join. Repeating the two steps settles records in order (once all
records a record depends on are settled, so is the record one round later), and an
assignment that reproduces itself is the sequential one, by induction over ``ord``. The
number of rounds depends on the chains of dependent decisions, not on the size of a cluster or
component, so a key shared by a third of all records costs no more rounds than any other
and never sits in one task.

Where decisions wait for each other in a row, a round would settle one of them at a time. So after
2, 4, 8, ... rounds the records that still move are *predicted* (:func:`_predicted`): whether a record opens
a cluster is written as a function of whether the record it waits for does, these functions
are composed along the row by pointer doubling, and the labels that follow are the next
assignment. A chain of n records takes about log2(n) doublings. The prediction may be wrong
where a decision depends on more than that; it never unsettles a settled record, and rounds go
on until one reproduces the assignment, which is the proof that it is right.

Rounds touch only 64-bit columns: each text key is replaced once by the smallest ``ord``
that carries it, and records that share no key leave before the first round. Records of
different linked components never meet, so a component in which no record moved is settled
and leaves too: a round carries only the components that still move. There is no other rule
for long chains or large components; the number of rounds is logged.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.functions.text import doi_key, strip, text_key, title_key, url_key, word_key
from archiveloom.operators.harmonise import LOCAL_BITS
from archiveloom.operators.skew import block_of, dense_numbers, dense_within
from archiveloom.schema import CHILD_COLUMNS, PROJECT_SOURCE_COLUMNS
from archiveloom.staging import StagingArea, shuffled_if_large, sized

URL, DOI, TITLE, SELF = 1, 2, 3, 9

log = logging.getLogger(__name__)

_TIERS = ((URL, "url"), (DOI, "doi"), (TITLE, "title"))
_STATE = ("url_set", "doi_set", "title_set", "url_k", "doi_k", "title_k", "repo")


def match_keys(projects: DataFrame) -> DataFrame:
    """(ord, url_key, doi_key, title_key, repository_id) and which raw fields are set.

    An empty string is a set field without a key: it blocks later values but matches none.
    ``filled`` has one bit per source column, set where the column is not NULL.
    """
    bits = [
        F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        for i, c in enumerate(PROJECT_SOURCE_COLUMNS)
        if c in projects.columns
    ]
    return projects.select(
        "ord",
        url_key("project_url").alias("url_key"),
        doi_key("doi").alias("doi_key"),
        title_key("title").alias("title_key"),
        F.col("repository_id").alias("repo"),
        F.col("project_url").isNotNull().alias("url_set"),
        F.col("doi").isNotNull().alias("doi_set"),
        F.col("title").isNotNull().alias("title_set"),
        reduce(Column.bitwiseOR, bits).alias("filled"),
    )


@sized
def stage_keys(projects: DataFrame, staging: StagingArea) -> DataFrame:
    """:func:`match_keys` as a staged table, so that the catalogues are scanned once for it."""
    keys, _ = staging.write(match_keys(projects), "keys")
    return keys


def _struct(tier: int, k1: Column, k2: Column, *more: Column) -> Column:
    return F.struct(F.lit(tier).alias("tier"), k1.alias("k1"), k2.alias("k2"), *more)


def shared_keys(staging: StagingArea, keys: DataFrame) -> tuple[DataFrame, int]:
    """Records that share a key with another, with keys coded as the smallest carrier.

    ``keys`` is :func:`match_keys`. Returns the coded records and their number. The title key
    ignores the repository on purpose: a cluster can pair the title of one member with the
    repository of another.
    """
    flags = ["url_set", "doi_set", "title_set", "repo"]
    tiers = F.array(
        F.struct(F.lit(URL).alias("tier"), F.col("url_key").alias("key")),
        F.struct(F.lit(DOI).alias("tier"), F.col("doi_key").alias("key")),
        F.struct(F.lit(TITLE).alias("tier"), F.col("title_key").alias("key")),
    )
    carried = keys.select("ord", *flags, F.inline(tiers)).where(F.col("key").isNotNull())
    codes = (
        carried.groupBy("tier", "key")
        .agg(F.min("ord").alias("k1"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    coded = carried.join(codes, ["tier", "key"])
    pick = lambda tier, name: F.max(F.when(F.col("tier") == tier, F.col("k1"))).alias(name)
    records = coded.groupBy("ord").agg(
        *[F.max(c).alias(c) for c in flags],
        pick(URL, "url_k"), pick(DOI, "doi_k"), pick(TITLE, "title_k"),
    )
    records, count = staging.write(records.select("ord", *_STATE), "records", n=F.count(F.lit(1)))
    return records, count["n"]


def _owners(state: DataFrame) -> DataFrame:
    """(tier, k1, k2) -> the first cluster to own the key, and when it came to own it."""
    first = lambda value, is_set: F.min_by(value, F.when(F.col(is_set), F.col("ord")))
    since = lambda is_set: F.min(F.when(F.col(is_set), F.col("ord")))
    clusters = state.withColumn("repo_set", F.col("repo").isNotNull()).groupBy("label").agg(
        since("url_set").alias("url_at"), first("url_k", "url_set").alias("url_k"),
        since("doi_set").alias("doi_at"), first("doi_k", "doi_set").alias("doi_k"),
        since("title_set").alias("title_at"), first("title_k", "title_set").alias("title_k"),
        since("repo_set").alias("repo_at"), first("repo", "repo_set").alias("repo"),
    )
    zero = F.lit(0).cast("bigint")
    owned = F.array(
        _struct(URL, F.col("url_k"), zero, F.col("url_at").alias("since")),
        _struct(DOI, F.col("doi_k"), zero, F.col("doi_at").alias("since")),
        _struct(TITLE, F.col("title_k"), F.col("repo"), F.greatest("title_at", "repo_at").alias("since")),
    )
    return (
        clusters.select("label", F.inline(owned))
        .where(F.col("k1").isNotNull() & F.col("k2").isNotNull())
        .groupBy("tier", "k1", "k2")
        .agg(F.min("since").alias("since"), F.min_by("label", "since").alias("owner"))
    )


def _asked(state: DataFrame) -> DataFrame:
    """(ord, tier, k1, k2): the keys a record looks up.

    The first record to carry a text finds no owner of it, so it need not ask.
    """
    zero = F.lit(0).cast("bigint")
    wanted = F.array(
        _struct(URL, F.col("url_k"), zero),
        _struct(DOI, F.col("doi_k"), zero),
        _struct(TITLE, F.col("title_k"), F.col("repo")),
    )
    return state.select("ord", F.inline(wanted)).where("k1 < ord and k2 is not null")


def _reassign(state: DataFrame) -> DataFrame:
    """One round: every record joins the owner of its best key, or itself."""
    hits = _asked(state).join(_owners(state), ["tier", "k1", "k2"])
    own = state.select(
        "ord", F.lit(SELF).alias("tier"), F.col("ord").alias("owner"), *_STATE, "component",
        F.col("label").alias("was"),
    )
    return (
        own.unionByName(
            hits.where("since < ord").select("ord", "tier", "owner"), allowMissingColumns=True
        )
        .groupBy("ord")
        .agg(
            F.min_by("owner", "tier").alias("label"),
            F.max("was").alias("was"),
            *[F.max(c).alias(c) for c in (*_STATE, "component")],
        )
    )


def _waiting(state: DataFrame) -> DataFrame:
    """``state`` with the records each one waits for, per tier and the last of them.

    Per tier that is the record that gave the key's owner the key (``<tier>_hit``), else the first
    carrier of the key, which may come to own it; ``on`` is the latest. ``opened`` says whether
    the record opens a cluster now.
    """
    asked = _asked(state).join(_owners(state).drop("owner"), ["tier", "k1", "k2"], "left")
    hit = F.coalesce(F.col("since") < F.col("ord"), F.lit(False))
    asked = asked.select("ord", "tier", F.when(hit, F.col("since")).otherwise(F.col("k1")).alias("on"), hit.alias("hit"))
    per_tier = lambda tier, c: F.max(F.when(F.col("tier") == tier, F.col(c)))
    waits = asked.groupBy("ord").agg(
        F.max("on").alias("on"),
        *[per_tier(t, "on").alias(f"{n}_on") for t, n in _TIERS],
        *[per_tier(t, "hit").alias(f"{n}_hit") for t, n in _TIERS],
    )
    return state.withColumn("opened", F.col("label") == F.col("ord")).join(waits, "ord", "left")


def _answers(waiting: DataFrame) -> DataFrame:
    """Per record and tier: does it hit if the record it waits for opens a cluster, or if that joins one.

    A record that opens a cluster gives it all its keys. One that joins gives it, if it joins now,
    what it gives it now, and else the fields that the record it would join for lacks.
    """
    flags = ("url_set", "doi_set", "title_set")
    before = waiting.select(F.col("ord").alias("on"), *[F.col(c).alias(f"before_{c}") for c in flags])
    one = waiting.join(before, "on", "left").select(
        F.col("ord").alias("on"), F.col("opened").alias("on_opened"), F.col("repo").alias("on_repo"),
        *[F.coalesce(~F.col(f"before_{c}"), F.lit(True)).alias(f"new_{c}") for c in flags],
    )
    rows = waiting.join(one, "on", "left")
    answers = []
    for _, name in _TIERS:
        hit, here = F.col(f"{name}_hit"), F.col(f"{name}_on") == F.col("on")
        gives = F.lit(True) if name != "title" else F.coalesce(F.col("on_repo") == F.col("repo"), F.lit(False))
        if_open = F.when(here, hit | gives).otherwise(hit)
        if_joined = F.when(here, F.when(F.col("on_opened"), gives & F.col(f"new_{name}_set")).otherwise(hit)).otherwise(hit)
        for column, suffix in ((if_open, "open"), (if_joined, "joined")):
            answers.append(F.coalesce(column, F.lit(False)).alias(f"{name}_if_{suffix}"))
    return rows.select("ord", "on", *[f"{n}_on" for _, n in _TIERS], *answers)


def _predicted(state: DataFrame, staging: StagingArea, turn: int) -> tuple[DataFrame, int]:
    """``state`` with predicted labels, and the number of doublings it took.

    It starts from the current labels, but the first time takes a component in which most records
    moved, where they say little, for one cluster.
    """
    start = F.col("label")
    if not turn:
        seen = state.groupBy("component").agg(
            F.min("ord").alias("_first"), (2 * F.count_if(F.col("label") != F.col("was")) > F.count(F.lit(1))).alias("_most")
        )
        state = state.join(seen, "component").withColumn("label", F.when(F.col("_most"), F.col("_first")).otherwise(start))
    for _ in range(2):  # the label of the label, so that clusters hang together
        above = state.select(F.col("ord").alias("label"), F.col("label").alias("_above"))
        state = state.join(above, "label", "left").withColumn("label", F.coalesce("_above", "label")).drop("_above")
    state, _ = staging.write(state.select("ord", "label", "component", *_STATE), f"guess-{turn % 2}")
    waiting, _ = staging.write(_waiting(state), "waiting")
    answers, _ = staging.write(_answers(waiting), "answers")
    opens = lambda suffix: ~reduce(Column.__or__, [F.col(f"{n}_if_{suffix}") for _, n in _TIERS])
    step = answers.select("ord", "on", opens("open").alias("if_open"), opens("joined").alias("if_joined"))
    # a step says whether a record opens a cluster, given whether record ``on`` does
    unknown, doublings = F.count_if(F.col("if_open") != F.col("if_joined")), 0
    step, seen = staging.write(step, "step-0", n=unknown)
    while seen["n"]:
        doublings += 1
        other = step.select(
            F.col("ord").alias("on"), F.col("on").alias("_on"), F.col("if_open").alias("_if_open"), F.col("if_joined").alias("_if_joined")
        )
        after = lambda c: F.when(F.col(c).isNull(), F.col("if_open")).when(F.col(c), F.col("if_open")).otherwise(F.col("if_joined"))
        known = step.where("if_open = if_joined")
        longer = step.where("if_open <> if_joined").join(other, "on", "left").select(
            "ord", F.col("_on").alias("on"), after("_if_open").alias("if_open"), after("_if_joined").alias("if_joined")
        )
        step, seen = staging.write(known.union(longer), f"step-{doublings % 2}", n=unknown)
        log.info("merge doubling %d: %d records wait", doublings, seen["n"])
    opened = step.select(F.col("ord").alias("on"), F.col("if_open").alias("_opened"))
    answer = lambda n: F.when(F.col("_opened"), F.col(f"{n}_if_open")).otherwise(F.col(f"{n}_if_joined"))
    joins = F.coalesce(*[F.when(answer(n), F.col(f"{n}_on")) for _, n in _TIERS], F.col("ord"))
    parents, _ = staging.write(answers.join(opened, "on", "left").select("ord", joins.alias("label")), "parents")
    # who gives a key to a cluster joined it for another: at most one step per field
    for _ in range(2):
        above = parents.select(F.col("ord").alias("label"), F.col("label").alias("_above"))
        parents = parents.join(above, "label", "left").select("ord", F.coalesce("_above", "label").alias("label"))
    return state.drop("label").join(parents, "ord"), doublings


def _linked(state: DataFrame, staging: StagingArea) -> DataFrame:
    """``state`` with the component of each record, over URL, DOI and title codes alone.

    Repositories are left out, as a cluster may take one over.
    """
    from archiveloom.operators.components import components

    links = F.array(*[F.struct(F.col("ord").alias("hi"), F.col(k).alias("lo")) for k in ("url_k", "doi_k", "title_k")])
    edges = state.select(F.inline(links)).where("hi > lo").distinct()
    member = components(edges, staging).withColumnRenamed("node", "ord")
    return state.join(member, "ord", "left").withColumn("component", F.coalesce("component", "ord"))


def assign_clusters(projects: DataFrame, staging: StagingArea | None = None) -> DataFrame:
    """(ord, label) for every record; ``label`` is the ``ord`` of the cluster's first record."""
    staging = staging or StagingArea(projects.sparkSession, "merge")
    return assign_by_keys(stage_keys(projects, staging), staging)


def assign_by_keys(keys: DataFrame, staging: StagingArea) -> DataFrame:
    """:func:`assign_clusters` from staged keys."""
    return assign_linked(keys, staging).select("ord", "label")


@sized
def assign_linked(keys: DataFrame, staging: StagingArea) -> DataFrame:
    """(ord, label, component): clusters, and the records that could ever have met.

    Records of different components share no URL, DOI or title text, so what happens in one
    changes nothing in another.
    """
    state, n = shared_keys(staging, keys)
    if not n:
        return keys.select("ord", F.col("ord").alias("label"), F.col("ord").alias("component"))
    # first guess: the smallest carrier of the URL, else of the DOI, else alone
    guess = F.coalesce(
        F.when(F.col("url_k") < F.col("ord"), F.col("url_k")),
        F.when(F.col("doi_k") < F.col("ord"), F.col("doi_k")),
        F.col("ord"),
    )
    state = _linked(state, staging).withColumn("label", guess)
    settled = f"{staging.path}/settled"
    rounds, predictions = 0, 0
    while True:
        if rounds == 2 ** (predictions + 1):
            state, _ = _predicted(state, staging, predictions)
            predictions += 1
        # two folders take turns: a round reads the one and replaces the other
        state, seen = staging.write(
            _reassign(state), f"round-{rounds % 2}",
            n=F.count(F.lit(1)), moved=F.count_if(F.col("label") != F.col("was")),
        )
        log.info("merge round %d: %d records, %d moved", rounds, seen["n"], seen["moved"])
        rounds += 1
        if not seen["moved"]:
            state.select("ord", "label", "component").write.mode("append").parquet(settled)
            break
        moving = state.where("label <> was").select("component").distinct()
        state.join(moving, "component", "left_anti").select("ord", "label", "component").write.mode("append").parquet(settled)
        state = state.join(moving, "component", "left_semi")
    # records that share no key are clusters of their own
    linked = keys.sparkSession.read.schema("ord long, label long, component long").parquet(settled)
    linked = linked.where("label <> ord or component <> ord")
    return keys.select("ord").join(shuffled_if_large(linked, n), "ord", "left").select(
        "ord", F.coalesce("label", "ord").alias("label"), F.coalesce("component", "ord").alias("component")
    )


def first_non_null(columns: list[str], order: str = "ord") -> list[Column]:
    """Per column the first non-NULL value in ``order``; an empty string counts as a value."""
    return [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns
    ]


def contributing_records(keys: DataFrame, assignment: DataFrame, by: str = "label") -> DataFrame:
    """(ord, by, members, alone): the records that give their cluster at least one value.

    Which record wins a field follows from what is set where, so it is found on 64-bit
    columns alone: one minimum per field. A cluster keeps its first record and at most one
    more per field it lacks, however many copies it has; ``alone`` marks clusters whose
    first record has all there is.
    """
    columns = list(PROJECT_SOURCE_COLUMNS)
    has = lambda i: F.col("filled").bitwiseAND(F.lit(1 << i)) != 0
    winners = keys.select("ord", "filled").join(assignment.select("ord", by), "ord").groupBy(by).agg(
        F.count(F.lit(1)).alias("members"),
        F.min("ord").alias("_first"),
        *[F.min(F.when(has(i), F.col("ord"))).alias(c) for i, c in enumerate(columns)],
    )
    records = F.array_distinct(F.array_compact(F.array("_first", *columns)))
    return winners.select(by, "members", records.alias("_records")).select(
        by, "members", (F.size("_records") == 1).alias("alone"), F.explode("_records").alias("ord")
    )


def coalesce_clusters(
    projects: DataFrame, assignment: DataFrame, by: str = "label", keys: DataFrame | None = None
) -> DataFrame:
    """One row per cluster: per field the first non-NULL value of its members.

    Only contributing records leave the join with the wide rows, and only those of clusters
    put together from several records are shuffled again.
    """
    columns = list(PROJECT_SOURCE_COLUMNS)
    keys = match_keys(projects) if keys is None else keys
    rows = projects.join(contributing_records(keys, assignment, by), "ord")
    whole = rows.where("alone").select(by, *columns, "members")
    pieced = (
        rows.where("not alone").groupBy(by).agg(*first_non_null(columns), F.max("members").alias("members"))
    )
    return whole.unionByName(pieced)


def attach_children(children: DataFrame, assignment: DataFrame, by: str = "label") -> DataFrame:
    """Children with the cluster of their parent; orphans are dropped."""
    parents = assignment.select(F.col("ord").alias("parent_ord"), F.col(by))
    known = children.where(F.col("parent_ord").isNotNull())
    return known.drop(by).join(parents, "parent_ord")


def dedupe_files(files: DataFrame, parent: str = "label") -> DataFrame:
    """One row per parent and file name; NULL fields are filled from later rows."""
    return (
        files.withColumn("name_key", text_key("file_name"))
        .where(F.col("name_key").isNotNull())
        .groupBy(parent, "name_key")
        .agg(*first_non_null(list(CHILD_COLUMNS["files"])), F.min("ord").alias("ord"))
        .drop("name_key")
    )


def dedupe_values(rows: DataFrame, value: str, parent: str = "label") -> DataFrame:
    """One row per parent and normalised value, in its first spelling.

    A spelling that is the normalised value itself is not carried beside it, and one minimum
    holds place and spelling. What has no key is told by its ends, without a regular expression.
    """
    first = F.struct("ord", F.nullif(F.col(value), F.col("value_key")).alias("spelling"))
    return (
        rows.where(strip(F.col(value).cast("string")) != "")
        .withColumn("value_key", text_key(value))
        .groupBy(parent, "value_key")
        .agg(F.min(F.when(F.col("ord").isNotNull(), first)).alias("_first"))
        .select(
            parent,
            F.when(F.col("_first").isNotNull(), F.coalesce("_first.spelling", "value_key")).alias(value),
            F.col("_first.ord").alias("ord"),
        )
    )


def numbered_values(
    rows: DataFrame, value: str, staging: StagingArea, name: str, parents: int, parent: str = "project_id"
) -> DataFrame:
    """:func:`dedupe_values` with an ``id`` from 1 in the order of ``parent`` and ``ord``.

    ``parent`` is a number from 1 to ``parents``. Rows are first reduced to the first place of each
    spelling, by hashing, before and after they are moved; only these spellings are normalised. All of a
    parent and its neighbours then meet in one task, sorted by parent, which settles and numbers them.
    """
    rows = rows.where(strip(F.col(value).cast("string")) != "")
    spellings = rows.groupBy(parent, value).agg(F.min("ord").alias("ord"))
    blocks = spellings.withColumn("_block", block_of(parent, parents)).repartition("_block")
    keyed = blocks.withColumn("value_key", word_key(value))
    first = F.struct("ord", F.nullif(F.col(value), F.col("value_key")).alias("spelling"))
    settled = (
        keyed.groupBy(parent, "_block", "value_key")
        .agg(F.min(F.when(F.col("ord").isNotNull(), first)).alias("_first"))
        .select(
            "_block", parent,
            F.when(F.col("_first").isNotNull(), F.coalesce("_first.spelling", "value_key")).alias(value),
            F.col("_first.ord").alias("ord"),
        )
    )
    return dense_within(staging, settled, [parent, "ord"], name, "_block")


def dedupe_person_role(people: DataFrame, parent: str = "label") -> DataFrame:
    """One row per parent, name and role; dropped only when name and role are both empty."""
    return (
        people.withColumn("name_key", text_key("name"))
        .withColumn("role_key", text_key("role"))
        .where(F.col("name_key").isNotNull() | F.col("role_key").isNotNull())
        .groupBy(parent, "name_key", "role_key")
        .agg(
            F.min_by("name", "ord").alias("name"),
            F.min_by("role", "ord").alias("role"),
            F.min("ord").alias("ord"),
        )
        .drop("name_key", "role_key")
    )


def dedupe_children(entity: str, rows: DataFrame, parent: str = "label") -> DataFrame:
    if entity == "files":
        return dedupe_files(rows, parent)
    if entity == "person_role":
        return dedupe_person_role(rows, parent)
    return dedupe_values(rows, next(iter(CHILD_COLUMNS[entity])), parent)


def surrogate_ids(assignment: DataFrame, staging: StagingArea) -> DataFrame:
    """(label, id): clusters numbered 1..n in the order they were opened."""
    founders = assignment.where("ord = label").select("label")
    return dense_numbers(staging, founders, ["label"], "ids")


def with_ids(assignment: DataFrame, ids: DataFrame) -> DataFrame:
    """(ord, label, project_id): the id of every record's cluster."""
    numbered = ids.select("label", F.col("id").alias("project_id"))
    return assignment.join(numbered, "label")


def merge_stats(assignment: DataFrame, sources: int | None = None) -> DataFrame:
    """Per run: sources (those with records, unless given), records read, clusters."""
    with_records = F.count_distinct(F.shiftright("ord", LOCAL_BITS))
    return assignment.agg(
        (with_records if sources is None else F.lit(sources).cast("bigint")).alias("sources"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("ord") == F.col("label")).alias("clusters"),
    )
