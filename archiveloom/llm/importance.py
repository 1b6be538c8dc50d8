"""Target-distribution importance resampling (11): hashed n-grams, length-bucketed CRC matrices.

Features of a text are its runs of 1 to ``max_words`` words; a feature's bucket is the CRC-32 of
its bytes modulo ``n_buckets``. A task takes a block of texts, finds the distinct features of the
block, groups their bytes by equal length into two-dimensional byte arrays, carries the CRCs of a
whole group on by one column at a time, and scatters the buckets back to all occurrences.

Bucket counts of the corpus and of the target are summed by Spark over all rows; a task sends at
most one row per bucket. Each bucket's gain is the log ratio of its smoothed shares in thousandths.
A document's weight is the floored mean gain of its features; adding seeded Gumbel noise and taking
the highest sums draws without replacement in proportion to the exponentiated weights. Ranks come
from a range partitioning of one small row per document, so no task sees all rows.

Bounded on the driver: ``n_buckets`` counts of either side, and one number per partition.

Defined results: a NULL or wordless text has no features, weight 0, and is not eligible unless
``min_words`` is 0; a NULL id draws its noise as the empty string and comes last among ties; rows
equal in score and id get neighbouring ranks in no certain order; repeated rows are judged one by
one; a text of any length is taken whole, and a feature over ``LONG`` bytes has its CRC
taken by itself, as no other shares its matrix; empty tables give no rows, and an empty target leaves
only the smoothing; other columns of the input, whatever their names, are never looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd
from archiveloom.operators.skew import dense_numbers
from archiveloom.staging import StagingArea

N_BUCKETS = 10_000
LONG = 512  # bytes of a feature from which on it is not put into a matrix
MATRIX_BYTES = 1 << 20


def _crc_steps() -> np.ndarray:
    """What the reflected CRC-32 polynomial makes of each byte."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


_STEPS = _crc_steps()


def crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of ``data``, all slices of one length at a time."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    bounds = np.append(np.flatnonzero(np.diff(lengths[order], prepend=-1)), len(order))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        size = int(lengths[order[lo]])
        if size > LONG:
            for i in order[lo:hi]:
                out[i] = zlib.crc32(data[starts[i] : starts[i] + size])
            continue
        step = max(1, MATRIX_BYTES // max(1, size))
        for at in range(lo, hi, step):
            rows = order[at : min(at + step, hi)]
            matrix = data[np.arange(size)[:, None] + starts[rows]]  # one row per column of bytes
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = _STEPS[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[rows] = ~crc
    return out


def _joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words one after another with one space after each, and where each begins."""
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    out[pk.expand(begins, lengths)] = data[pk.expand(starts, lengths)]
    return out, begins


def features(column: pa.Array, max_words: int = 1, n_buckets: int = N_BUCKETS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words per text, and per run length (text, bucket) of every feature, in text order."""
    data, offsets = wd.utf8(column)
    data = wd.LOWER[data]
    starts, ends = wd.spans(data, offsets, wd.NON_WORD)
    lengths = ends - starts
    counts = np.diff(np.searchsorted(starts, offsets))
    text = np.repeat(np.arange(len(counts)), counts)
    found = []
    if not len(starts):
        return counts, [(text, text)] * max_words
    joined, begins = _joined(data, starts, lengths)
    upto = np.append(begins[1:], len(joined)).astype(np.int64)  # with the space, which keeps words whole
    packed = pa.Array.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, upto[-1]).astype(np.int64)), pa.py_buffer(joined)]
    )
    word = packed.dictionary_encode().indices.to_numpy().astype(np.int64)
    kinds, code = int(word.max()) + 1, word
    for n in range(1, max_words + 1):
        at = np.arange(len(word) - n + 1)
        if n > 1:  # a run is known by the run without its last word, and that word
            code = code[: len(at)] * kinds + word[n - 1 :]
        same = text[at] == text[at + n - 1]
        at = at[same]
        _, first, code_of = np.unique(code[: len(same)][same], return_index=True, return_inverse=True)
        last = at[first] + n - 1
        sizes = begins[last] + lengths[last] - begins[at[first]]
        buckets = crc32(joined, begins[at[first]], sizes) % np.uint32(n_buckets)
        found.append((text[at], buckets[code_of].astype(np.int64)))
        dense = np.zeros(len(word), np.int64)
        dense[at] = code_of
        code = dense
    return counts, found


def _counter(text: str, max_words: int, n_buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for table in pk.blocks(batches, text):
            for _, buckets in features(table[text], max_words, n_buckets)[1]:
                total += np.bincount(buckets, minlength=n_buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return count


def bucket_counts(docs: DataFrame, max_words: int = 1, n_buckets: int = N_BUCKETS, text: str = "text") -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""
    pk.small_batches(docs.sparkSession)
    parts = docs.select(text).mapInArrow(_counter(text, max_words, n_buckets), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, n_buckets: int = N_BUCKETS) -> list[int]:
    """Per bucket the log of its target share over its raw share, in thousandths, rounded down."""
    found = raw.withColumn("side", F.lit(0)).unionByName(target.withColumn("side", F.lit(1)))
    counts = np.zeros((2, n_buckets))
    for row in found.collect():  # at most two rows a bucket
        counts[row["side"], row["bucket"]] = row["n"]
    (s, t), (s_all, t_all) = counts, counts.sum(axis=1)
    odds = (t + 1) * (s_all + n_buckets) / ((s + 1) * (t_all + n_buckets))
    return [math.floor(1000 * math.log(x)) for x in odds.tolist()]


def _weigher(text: str, gain, max_words: int, n_buckets: int, schema: pa.Schema):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = np.array(gain.value, np.int64)
        for table in pk.blocks(batches, text):
            n_words, found = features(table[text], max_words, n_buckets)
            n, total = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
            for owner, buckets in found:
                n += np.bincount(owner, minlength=len(n))
                upto = np.append(0, np.cumsum(gain_of[buckets]))
                first = np.searchsorted(owner, np.arange(len(n) + 1))
                total += upto[first[1:]] - upto[first[:-1]]
            own = {"n_words": n_words, "n_features": n, "weight": total // np.maximum(n, 1)}
            columns = [pa.array(own[c], pa.int64()) if c in own else table[c] for c in schema.names]
            yield from pa.table(columns, schema=schema).to_batches(max_chunksize=10_000)

    return weigh


def weighed(
    docs: DataFrame, gain: list[int], max_words: int = 1, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``n_words``, ``n_features`` and ``weight``.

    Columns of these names in the input are replaced.
    """
    pk.small_batches(docs.sparkSession)
    own = ("n_words", "n_features", "weight")
    keep = [c for c in (keep or docs.columns) if c not in own]
    rows = docs.select(*dict.fromkeys([*keep, text]))
    schema = T.StructType([*rows.select(*keep).schema.fields, *[T.StructField(c, T.LongType()) for c in own]])
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    return rows.mapInArrow(_weigher(text, shared, max_words, len(gain), to_arrow_schema(schema)), schema)


def noise(id: str = "doc_id", seed: int = 2024) -> Column:
    """Standard Gumbel noise in thousandths, rounded down, from a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def learned(docs: DataFrame, target: DataFrame, max_words: int = 1, n_buckets: int = N_BUCKETS, text: str = "text", target_text: str = "text") -> list[int]:
    """Gains of all buckets from whole tables."""
    sides = bucket_counts(docs, max_words, n_buckets, text), bucket_counts(target, max_words, n_buckets, target_text)
    return gains(*sides, n_buckets)


def ranked(
    docs: DataFrame, gain: list[int], percent: int = 10, min_words: int = 20, max_words: int = 1, seed: int = 2024, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; rank is NULL where it is not drawn.

    ``percent`` of the rows with at least ``min_words`` words are drawn, rounded down.
    """
    staging = StagingArea(docs.sparkSession, "resampling")
    rows = weighed(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), gain, max_words, ["id"])
    rows = rows.withColumn("score", (F.col("weight") + noise("id", seed)).cast("long"))
    rows = rows.withColumn("eligible", F.col("n_words") >= min_words)
    rows, seen = staging.write(rows, "scores", n=F.count_if("eligible"))
    drawn = percent * (seen["n"] or 0) // 100
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")]
    placed = dense_numbers(staging, rows, order, "ranks", "place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    return placed.select(F.col("id").alias(id), "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, gain: list[int], percent: int = 10, min_words: int = 20, max_words: int = 1, seed: int = 2024, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The drawn rows of ``docs``, whole; texts are read again and not shuffled.

    Rows that share score and id with the last one drawn are all kept.
    """
    ranks = ranked(docs, gain, percent, min_words, max_words, seed, id, text)
    last = ranks.where("rank is not null").orderBy(F.desc("rank")).select("score", F.col(id).alias("id")).first()
    if last is None:
        return docs.where("false")
    hidden = "_drawn_row"  # the row as it is, whatever its columns are called
    rows = weighed(docs.select(F.struct(*docs.columns).alias(hidden), F.col(id).alias("id"), F.col(text).alias("text")), gain, max_words, [hidden, "id"])
    score = F.col("weight") + noise("id", seed)
    before = F.lit(True) if last["id"] is None else F.col("id") <= F.lit(last["id"])
    ahead = (score > last["score"]) | ((score == last["score"]) & F.coalesce(before, F.lit(False)))
    return rows.where((F.col("n_words") >= min_words) & ahead).select(f"{hidden}.*")
