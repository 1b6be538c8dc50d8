"""N-gram Jaccard join (5): T-occurrence search over inverted lists of word shingles.

Two documents link if the Jaccard similarity of their sets of shingles is at least a percentage.
Sets of equal content are one class, so copies are never compared. For the rest:

1. Shingles are dealt into buckets and each learns in how many classes it occurs. Only those of
   two classes or more can be shared; a class with fewer of them than its smallest admissible
   overlap T links with nothing and leaves.
2. DivideSkip: a class's T - 1 most frequent shingles are its long lists, the rest, its rarest,
   the short ones. Partners with overlap T must meet in a short list. The short lists are
   merged by a join on the shingle that adds up the occurrences of each candidate; the
   candidate's remaining, long lists are then probed by binary search until T is reached.
3. Before that, groups are contracted: classes that share a minimum hash are probed against one
   leader of the group, and linked ones become one component. The merge skips lists and
   candidates within a component, since a link there would change nothing. A group of near
   copies of any size thus costs as many probes as it has members, not pairs.

Class identity is a 64-bit sum of mixed shingle hashes with a second, independent sum beside it;
if classes are ever found to collide, the join is run again with other keys.

Defined results: a NULL or wordless text has no shingles, links with nothing and is its own
component; a text of fewer words than a shingle is one shingle; rows of one id and content are
one document; a row with a NULL id comes after all others; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd
from archiveloom.operators.components import components
from archiveloom.staging import StagingArea

LAST_ID = np.iinfo(np.int64).max
MISSING = "_id_is_missing"
HASH_BYTES = 7  # of a shingle's hash, sent besides its bucket
BUCKET_BYTES = 8 << 20  # text whose shingles meet in one bucket; a worker takes some ten times that
LEADER_SEEDS = (11, 12, 13)  # minimum hashes that look for a group's leader

_BINARY = lambda *names: [(n, pa.binary()) for n in names]
_SENT = pa.schema([("bucket", pa.int32()), *_BINARY("hashes", "classes", "sizes", "counts", "docs")])
_COUNTED = pa.schema([("bucket", pa.int32()), *_BINARY("hashes", "dfs", "classes", "sizes", "counts", "docs")])
_SENT_DDL = "bucket int, hashes binary, classes binary, sizes binary, counts binary, docs binary"
_COUNTED_DDL = "bucket int, hashes binary, dfs binary, classes binary, sizes binary, counts binary, docs binary"


def _found(keep: tuple[str, ...]) -> tuple[str, pa.Schema]:
    """DDL and schema of what a bucket of classes gives: documents with columns ``keep``, and sets."""
    longs, lists = ["id", *keep, "class", "check"], ["tokens", "short"]
    ddl = [*(f"`{c}` long" for c in longs), "n int", *(f"{c} array<long>" for c in lists)]
    fields = [*((c, pa.int64()) for c in longs), ("n", pa.int32()), *((c, pa.list_(pa.int64())) for c in lists)]
    return ", ".join(ddl), pa.schema(fields)


def _rows(bucket: np.ndarray, n_buckets: int, spread: int, docs: bytes, entry_class: np.ndarray, classes: np.ndarray, sizes: np.ndarray, columns: dict) -> list[dict]:
    """Entries, sorted by class, packed by bucket; ``docs`` travels with bucket ``spread``."""
    order, begins = pk.split_by(bucket, n_buckets)
    out = []
    for b in range(n_buckets):
        mine = order[begins[b] : begins[b + 1]]
        if not len(mine) and (b != spread or not docs):
            continue
        starts = pk.runs((entry_class[mine], 0)) if len(mine) else mine
        own = entry_class[mine[starts]]
        row = {"bucket": b, "classes": classes[own].tobytes(), "sizes": sizes[own].astype(np.int32).tobytes(),
               "counts": pk.run_lengths(starts, len(mine)).astype(np.int32).tobytes(), "docs": docs if b == spread else b""}
        out.append(row | {name: pack(mine) for name, pack in columns.items()})
    return out


def _sender(k: int, bits: int, seed: int, keep: tuple[str, ...]):
    keys = wd.mix(np.array([2 * seed + 1, 2 * seed + 2], np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pk.blocks(batches, "text"):
            text = wd.split(table["text"], lower=True)
            hashes, at = wd.windows(text, k, short=True)
            doc = text.texts()[at].astype(np.int32)
            order = np.argsort(hashes, kind="stable")
            order = order[np.argsort(doc[order], kind="stable")]
            hashes, doc = hashes[order], doc[order]
            once = np.ones(len(hashes), bool)
            once[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            hashes, doc = hashes[once], doc[once]
            sizes = np.bincount(doc, minlength=table.num_rows)
            sums = np.zeros((2, table.num_rows), np.uint64)
            if len(hashes):
                starts = pk.runs((doc, 0))
                for i in range(2):
                    sums[i, doc[starts]] = np.add.reduceat(wd.mix(hashes * keys[i]), starts)
            sums = wd.mix(sums + sizes.astype(np.uint64)).view(np.int64)
            ids = [table[c].to_numpy() for c in ("id", *keep)]
            docs = np.stack([*ids, sums[0], sums[1], sizes]).astype(np.int64).tobytes()
            classes, first = np.unique(sums[0], return_index=True)
            sends = np.zeros(table.num_rows, bool)
            sends[first] = True  # one document of each class in the block
            entry = np.flatnonzero(sends[doc])
            bucket = (hashes[entry] >> np.uint64(64 - bits)).astype(np.int64)
            spread = int(sums[0][0] % (1 << bits)) if table.num_rows else 0
            pack = {"hashes": lambda mine: pk.low_bytes(hashes[entry[mine]], HASH_BYTES)}
            rows = _rows(bucket, 1 << bits, spread, docs, doc[entry], sums[0], sizes, pack)
            yield pa.RecordBatch.from_pylist(rows, _SENT)

    return pk.trimming(send)


def _unpacked(table: pa.Table, columns: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """Classes and sizes of a bucket, the class of each entry, and its columns."""
    # values are read where they lie: as Python objects they would be held twice
    joined = lambda name, read: np.concatenate([read(v.as_buffer()) for v in table[name]])
    classes = joined("classes", lambda b: np.frombuffer(b, np.int64))
    sizes = joined("sizes", lambda b: np.frombuffer(b, np.int32))
    counts = joined("counts", lambda b: np.frombuffer(b, np.int32))
    entry = np.repeat(np.arange(len(classes)), counts)
    return classes, sizes, entry, {n: joined(n, read) for n, read in columns.items()}


def _counter(bits: int, keep: tuple[str, ...]):
    def count(key: tuple, table: pa.Table) -> pa.Table:
        """One bucket of shingles: those of several classes, with how many, packed by class."""
        bucket = key[0].as_py()
        classes, sizes, entry, found = _unpacked(table, {"hashes": lambda b: pk.from_low_bytes(b, HASH_BYTES)})
        # blocks send a class each: one of them counts
        _, first = np.unique(classes, return_index=True)
        counts = np.zeros(len(classes), bool)
        counts[first] = True
        mine = np.flatnonzero(counts[entry])
        hashes, entry = found["hashes"][mine], entry[mine]
        order = np.argsort(hashes, kind="stable")
        starts = pk.runs((hashes[order], 0)) if len(order) else order
        lengths = pk.run_lengths(starts, len(order))
        df = np.empty(len(order), np.int64)
        df[order] = np.repeat(lengths, lengths)
        shared = np.flatnonzero(df > 1)
        shared = shared[np.argsort(entry[shared], kind="stable")]
        tokens = wd.mix(hashes[shared] ^ np.uint64(bucket * 0x9E3779B97F4A7C15 % (1 << 64)))
        dfs, entry = df[shared], entry[shared]
        to = (wd.mix(classes.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)[entry]
        pack = {"hashes": lambda m: tokens[m].tobytes(), "dfs": lambda m: dfs[m].astype(np.int32).tobytes()}
        docs = b"".join(_flat_docs(table, 4 + len(keep)))
        return pa.Table.from_pylist(_rows(to, 1 << bits, bucket, docs, entry, classes, sizes, pack), _COUNTED)

    return lambda key, table: pk.trimmed(count(key, table))


def _flat_docs(table: pa.Table, width: int) -> Iterator[bytes]:
    """Document rows of all blocks, row by row instead of column by column."""
    for part in table["docs"].to_pylist():
        if part:
            yield np.ascontiguousarray(np.frombuffer(part, np.int64).reshape(width, -1).T).tobytes()


def _gatherer(percent: int, keep: tuple[str, ...]):
    schema = _found(keep)[1]

    def gather(table: pa.Table) -> pa.Table:
        """One bucket of classes: those that can link, with their shared shingles and short lists."""
        docs = np.frombuffer(b"".join(d for d in table["docs"].to_pylist() if d), np.int64).reshape(-1, 4 + len(keep))
        out = [pa.Table.from_arrays([
            *(pa.array(docs[:, i]) for i in range(docs.shape[1] - 1)), pa.array(docs[:, -1].astype(np.int32)),
            pa.nulls(len(docs), pa.list_(pa.int64())), pa.nulls(len(docs), pa.list_(pa.int64())),
        ], schema=schema)]
        classes, sizes, entry, found = _unpacked(table, {"hashes": lambda b: np.frombuffer(b, np.int64), "dfs": lambda b: np.frombuffer(b, np.int32)})
        order = np.lexsort((found["hashes"], found["dfs"], classes[entry]))
        entry, tokens = entry[order], found["hashes"][order]
        starts = pk.runs((classes[entry], 0)) if len(entry) else entry
        lengths = pk.run_lengths(starts, len(entry))
        n = sizes[entry[starts]].astype(np.int64)
        least = (percent * n + 99) // 100
        rows = []
        for i in np.flatnonzero(lengths >= least):
            own = tokens[starts[i] : starts[i] + lengths[i]]
            short = own[: lengths[i] - least[i] + 1]
            rows.append({"class": int(classes[entry[starts[i]]]), "n": int(n[i]), "tokens": np.sort(own), "short": short})
        out.append(pa.Table.from_pylist(rows, schema))
        return pa.concat_tables(out)

    return lambda table: pk.trimmed(gather(table))


def _prober(percent: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose overlap reaches T, by binary search of one set's shingles in the other."""
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            n = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
            enough = np.zeros(len(a), bool)
            ta, tb = batch.column("ta"), batch.column("tb")
            for i in range(len(a)):
                x, y = ta[i].values.to_numpy(zero_copy_only=False), tb[i].values.to_numpy(zero_copy_only=False)
                x, y = (x, y) if len(x) < len(y) else (y, x)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                overlap = int((y[at] == x).sum())
                enough[i] = 100 * overlap >= percent * (n[i] - overlap)
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)[enough]), pa.array(np.minimum(a, b)[enough])], ["hi", "lo"])

    return pk.trimming(probe)


def probed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(hi, lo) of the pairs (a, b) of classes that link."""
    side = lambda c: sets.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), F.col("tokens").alias(f"t{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_prober(percent), "hi long, lo long")


def leader_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): each class with the leader of its minimum hash, for each seed.

    The leader is the class with the largest share of shingles that others have too: of near
    copies, the text they were made from, which is nearer to all of them than they are to each
    other.
    """
    least = lambda s: F.array_min(F.transform("tokens", lambda t: F.xxhash64(F.lit(s), t)))
    keys = F.array(*[F.struct(F.lit(s).alias("seed"), least(s).alias("key")) for s in LEADER_SEEDS])
    shared = F.struct((F.size("tokens") / F.col("n")).alias("share"), (-F.col("n")).alias("small"), F.col("class").alias("b"))
    keyed = sets.select("class", shared.alias("rank"), F.inline(keys))
    leaders = keyed.groupBy("seed", "key").agg(F.max("rank").alias("_best"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    leaders = leaders.select("seed", "key", F.col("_best.b").alias("b"))
    return keyed.join(leaders, ["seed", "key"]).where("class <> b").select(F.col("class").alias("a"), "b").distinct()


def merged_pairs(sets: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """(a, b): candidates of different components from the short lists, with occurrences."""
    entries = (
        sets.join(grouped.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
        .select("class", "n", F.size("tokens").alias("m"), "component", F.posexplode("short").alias("place", "token"))
        # shingles that no other class has come before all others in the order
        .select("class", "n", "component", "token", (F.col("m") - F.col("place")).alias("left"))
    )
    mixed = entries.groupBy("token").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo <> _hi")
    entries = entries.join(mixed.select("token"), "token", "left_semi")
    a, b = entries.alias("a"), entries.alias("b")
    # T of a pair is percent * (na + nb) / (100 + percent). All they share lies at or behind the
    # first shingle they share, so there each must have T shingles left.
    able = F.expr(
        f"a.token = b.token and a.class < b.class and a.component <> b.component "
        f"and {100 + percent} * least(a.left, b.left) >= {percent} * (a.n + b.n)"
    )
    return a.join(b, able).groupBy(F.col("a.class").alias("a"), F.col("b.class").alias("b")).agg(F.count(F.lit(1)).alias("met"))


def placed(docs: DataFrame, k: int, percent: int, id: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ..., n, component) of every row: a NULL id as ``LAST_ID``, long columns ``keep`` that
    are not NULL, the number of shingles, and a number of its own for each component; wordless
    rows share one."""
    staging = StagingArea(docs.sparkSession, "jaccard")
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(int(LAST_ID))).alias("id"), *keep, F.col(text).alias("text"))
    pk.small_batches(docs.sparkSession)
    bits = pk.bucket_bits(rows, bucket_bytes=BUCKET_BYTES)
    seed = 0
    while True:
        sent = rows.mapInArrow(_sender(k, bits, seed, keep), _SENT_DDL)
        counted = sent.groupBy("bucket").applyInArrow(_counter(bits, keep), _COUNTED_DDL)
        found, _ = staging.write(counted.groupBy("bucket").applyInArrow(_gatherer(percent, keep), _found(keep)[0]), f"found-{seed}")
        members, sets = found.where("id is not null").select("id", *keep, "class", "check", "n"), found.where("id is null").select("class", "n", "tokens", "short")
        collided = members.groupBy("class").agg((F.min("check") != F.max("check")).alias("differ")).where("differ")
        if collided.isEmpty():
            break
        seed += 1
    leading, _ = staging.write(probed(leader_pairs(sets), sets, percent), "leading")
    grouped, _ = staging.write(components(leading, StagingArea(docs.sparkSession, "jaccard-groups")), "grouped")
    merged = probed(merged_pairs(sets, grouped, percent).select("a", "b"), sets, percent)
    links, _ = staging.write(leading.union(merged), "links")
    linked = components(links, StagingArea(docs.sparkSession, "jaccard-links")).withColumnRenamed("node", "class")
    return members.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class"))


def join(docs: DataFrame, k: int = 4, percent: int = 85, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    # one more bit tells a missing id from the largest one
    rows = placed(docs.withColumn(MISSING, F.col(id).isNull().cast("long")), k, percent, id, text, (MISSING,))
    largest = F.struct("id", MISSING)
    smallest = rows.groupBy("component").agg(F.min(largest).alias("_smallest"))
    own = lambda place: F.when(F.col(f"{place}{MISSING}") == 0, F.col(f"{place}id"))
    return rows.join(smallest, "component").select(
        own("").alias(id), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, own("")).otherwise(own("_smallest.")).alias("component_id"),
    )
