"""Many catalogues, one schema: table and column resolution, casting, row order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.operators.skew import dense_numbers
from archiveloom.schema import CHILD_COLUMNS, ENTITIES, PROJECT_SOURCE_COLUMNS
from archiveloom.staging import StagingArea

# Bits of the row order below the source rank, unless there are so many sources that their ranks need
# more than the rest of a signed 64-bit number. Local ids take the lower half of their range; the
# upper one is for rows whose id gives them no place: ids out of that range, ids that are no
# number, and rows that repeat an id.
LOCAL_BITS = 52


def local_bits(n_sources: int) -> int:
    return min(LOCAL_BITS, 63 - max(1, n_sources - 1).bit_length())


def local_ids(bits: int = LOCAL_BITS) -> int:
    """Local ids below this number are places of their own."""
    return 1 << (bits - 1)


@dataclass(frozen=True)
class Source:
    """A catalogue: its name (which fixes its place in the merge) and its raw tables."""

    name: str
    tables: Mapping[str, DataFrame]


def resolve_table(tables: Mapping[str, DataFrame], entity: str) -> DataFrame | None:
    """The table whose name is ``entity`` in any case; the first one when several are."""
    return next((df for name, df in tables.items() if name.lower() == entity), None)


def ranked(sources: list[Source], ranks: Mapping[str, int] | None = None) -> list[tuple[int, Source]]:
    """Sources in merge order: sorted by name, so the order never depends on the listing.

    ``ranks`` gives the places of sources that are part of a longer list, of which others come
    at another time.
    """
    if ranks is not None:
        return sorted(((ranks[s.name], s) for s in sources), key=lambda r: r[0])
    return list(enumerate(sorted(sources, key=lambda s: s.name)))


def resolution_report(sources: list[Source]) -> list[tuple[str, int, str, bool]]:
    """(source, rank, entity, used) per source and entity.

    A source without a projects table is skipped whole; a child table without its parent
    column is skipped alone.
    """
    report = []
    for rank, source in ranked(sources):
        has_projects = resolve_table(source.tables, "projects") is not None
        for entity in ENTITIES:
            table = resolve_table(source.tables, entity)
            used = has_projects and table is not None
            if used and entity != "projects":
                used = "project_id" in {c.lower() for c in table.columns}
            report.append((source.name, rank, entity, used))
    return report


def row_order(rank: int | Column, local_id: Column, bits: int = LOCAL_BITS) -> Column:
    """One bigint that sorts by source, then by local id; NULL for an id without a place."""
    rank = F.lit(rank) if isinstance(rank, int) else rank
    high = F.shiftleft(rank.cast("bigint"), bits)
    return F.when((local_id >= 0) & (local_id < F.lit(local_ids(bits))), high + local_id)


def project_to(df: DataFrame, columns: Mapping[str, str]) -> list[Column]:
    """Select list that maps ``columns`` onto whatever ``df`` has, in any case.

    Missing columns become typed NULLs and extra ones are left out, so only mapped columns
    are read from a columnar scan.
    """
    found: dict[str, str] = {}
    for name in df.columns:
        found.setdefault(name.lower(), name)
    return [
        (F.expr(f"try_cast(`{found[c]}` AS {t})") if c in found else F.lit(None).cast(t)).alias(c)
        for c, t in columns.items()
    ]


def _child_id(columns: list[str], bits: int) -> Column:
    """A child's own id, or a number hashed from its values when it has no usable one.

    Unlike a place in the scan it is the same on every run and in any split of the input. It only
    says which of equal children comes first.
    """
    own, most = F.col("id"), F.lit(local_ids(bits))
    return F.when((own >= 0) & (own < most), own).otherwise(F.pmod(F.xxhash64(*columns), most))


def _column(table: DataFrame, name: str) -> str | None:
    return next((c for c in table.columns if c.lower() == name), None)


def rejected_projects(source: Source) -> DataFrame | None:
    """(source_name, local_id, reason) of projects without an id, to which no child can belong."""
    table = resolve_table(source.tables, "projects")
    if table is None or _column(table, "id") is None:
        return None
    return rejected_rows(table, F.lit(source.name))


def rejected_rows(table: DataFrame, source: Column) -> DataFrame:
    """:func:`rejected_projects` of a table, whose rows belong to ``source``."""
    raw = F.col(f"`{_column(table, 'id')}`")
    rows = table.select(source.alias("source_name"), raw.cast("string").alias("local_id"), F.lit("no id").alias("reason"))
    return rows.where(F.col("local_id").isNull())


def canonical_columns(entity: str) -> dict[str, str]:
    """What is read of an entity, besides ids."""
    return PROJECT_SOURCE_COLUMNS if entity == "projects" else CHILD_COLUMNS[entity]


def harmonise_entity(source: Source, rank: int, entity: str, bits: int = LOCAL_BITS) -> DataFrame | None:
    """One entity of one source in the canonical schema plus lineage columns.

    ``source_name``, ``source_rank`` and ``local_id`` say where a row came from; ``ord`` is
    its place in the merge, and ``parent_ord`` (children) the place of its parent. Where an id gives
    no place they are NULL and ``id_text`` or ``parent_text`` holds the id (see :func:`with_own_places`).
    """
    if resolve_table(source.tables, "projects") is None:
        return None
    table = resolve_table(source.tables, entity)
    if table is None:
        return None
    if entity == "projects" and _column(table, "id") is None:
        raise ValueError(f"source {source.name}: the projects table has no id column")
    if entity != "projects" and _column(table, "project_id") is None:
        return None
    return harmonised_rows(table, entity, F.lit(source.name), F.lit(rank), bits)


def harmonised_rows(table: DataFrame, entity: str, source: Column, rank: Column, bits: int = LOCAL_BITS) -> DataFrame:
    """:func:`harmonise_entity` of a table, whose rows belong to ``source`` at ``rank``."""
    if entity == "projects":
        columns, key, text = {"id": "bigint", **canonical_columns(entity)}, "id", "id_text"
    else:
        columns, key, text = {"id": "bigint", "project_id": "bigint", **canonical_columns(entity)}, "project_id", "parent_text"
    raw = F.col(f"`{_column(table, key)}`").cast("string").alias(text)
    rows = table.select(*project_to(table, columns), raw, source.alias("source_name"), rank.cast("int").alias("source_rank"))
    rank = F.col("source_rank")
    rows = rows.withColumn("local_id", F.col("id") if entity == "projects" else _child_id(list(columns), bits)).withColumn(
        "ord", row_order(rank, F.col("local_id"), bits)
    )
    place = "ord"
    if entity != "projects":
        place, rows = "parent_ord", rows.withColumn("parent_ord", row_order(rank, F.col("project_id"), bits))
    rows = rows.withColumn(text, F.when(F.col(place).isNull(), F.col(text))).drop("id")
    return rows.where(F.coalesce(F.col(place).cast("string"), F.col(text)).isNotNull()) if entity == "projects" else rows


def with_own_places(
    projects: DataFrame, strays: DataFrame, staging: StagingArea, bits: int = LOCAL_BITS
) -> tuple[DataFrame, DataFrame | None]:
    """``projects`` and ``strays`` with an ``ord`` of its own for every row, and places of strays.

    ``strays`` are the projects whose id gives no place. They, and all rows but the first (by a hash of
    their values) of an id that a source repeats, are numbered densely and come after all other ids
    of their source. The second result is (source_rank, parent_text, parent_ord), the first
    row of each such id, or None. Only ids are read to find repeated ones, and no group of rows
    of one id is gathered.
    """
    repeated = projects.groupBy("ord").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("ord")
    repeated, seen = staging.write(repeated, "repeated", n=F.count(F.lit(1)))
    strays, odd = staging.write(strays, "strays", n=F.count(F.lit(1)))
    if not seen["n"] and not odd["n"]:
        return projects, None
    columns = projects.columns
    values = F.xxhash64(*[c for c in columns if c != "ord"])
    rows = projects.join(repeated, "ord", "left_semi").select(*columns).unionByName(strays.select(*columns))
    order = [F.asc("source_rank"), F.asc("ord"), F.asc("id_text"), F.asc("_values")]
    numbered = dense_numbers(staging, rows.withColumn("_values", values), order, "odd-rows", "_number")
    spare = F.shiftleft(F.col("source_rank").cast("bigint"), bits) + F.lit(local_ids(bits)) + F.col("_number")
    keeps = numbered.where("ord is not null").groupBy("ord").agg(F.min("_number").alias("_number")).select("_number", F.lit(True).alias("_keeps"))
    placed = numbered.join(keeps, "_number", "left").withColumn("ord", F.when(F.col("_keeps"), F.col("ord")).otherwise(spare))
    placed, _ = staging.write(placed.select(*columns), "placed")
    parents = placed.where("id_text is not null").groupBy("source_rank", F.col("id_text").alias("parent_text")).agg(F.min("ord").alias("parent_ord"))
    rest = projects.join(repeated, "ord", "left_anti").select(*columns)
    return rest.union(placed), parents if odd["n"] else None


def with_stray_parents(children: DataFrame, parents: DataFrame | None) -> DataFrame:
    """Children with the places of their strayed parents (see :func:`with_own_places`)."""
    if parents is None:
        return children
    lost = F.col("parent_ord").isNull()
    found = children.where(lost & F.col("parent_text").isNotNull()).drop("parent_ord").join(parents, ["source_rank", "parent_text"])
    return children.where(~lost).unionByName(found)


def harmonise(sources: list[Source], ranks: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """Bag union of every source, per entity, in the canonical schema.

    Besides the entities there are ``strays``, projects whose id gives them no place (any text or
    number the merge still takes in), and ``rejects``, projects without an id.
    """
    placed = ranked(sources, ranks)
    bits = local_bits(max((rank for rank, _ in placed), default=0) + 1)
    parts: dict[str, list[DataFrame]] = {e: [] for e in (*ENTITIES, "strays")}
    for rank, source in placed:
        for entity in ENTITIES:
            rows = harmonise_entity(source, rank, entity, bits)
            if rows is None:
                continue
            if entity == "projects":
                parts["strays"].append(rows.where(F.col("ord").isNull()))
                rows = rows.where(F.col("ord").isNotNull())
            parts[entity].append(rows)
    parts["rejects"] = [r for r in map(rejected_projects, sources) if r is not None]
    return {e: reduce(DataFrame.unionByName, dfs) for e, dfs in parts.items() if dfs}
