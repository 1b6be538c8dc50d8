"""Language ID (3): nearest centroid among several clusters per language.

A text is lower-cased, everything but letters becomes one space, and its byte 3-grams are hashed
into ``FEATURES`` counts. Counts are damped, weighted by inverse document frequency and
normalised. Each language has several centroids, found by spherical k-means over its sample, so
that styles of one language need not share one mean. A text belongs to the language of the
centroid with the largest cosine.

Rejection is by distance: a short text lies further from any centroid than a long one because it
has few 3-grams, so a text's cosine is divided by the share sqrt(g / (g + HALF)) that g 3-grams
can reach. Texts below ``STRICTNESS`` times what the sample's worst texts have are rejected.

Learning takes a bounded sample: at most ``sample`` texts, evenly over languages, chosen by a
hash of the id. Everything else, the prediction, covers whole texts of all rows.

Defined results: a NULL text or one without a letter is ``und`` with score 0 and is rejected;
without any labelled row every text is; repeated rows are judged alike; an empty table gives no
rows; the columns ``lang_pred``, ``score`` and ``rejected`` of the input, if any, are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd
from archiveloom.llm.ranking import unit

FEATURES = 4096
CENTROIDS = 3
HALF = 150.0
STRICTNESS = 0.4
UNDETERMINED = "und"
ROWS_AT_A_TIME = 128  # texts whose dense counts are held

_LETTER = np.zeros(256, np.uint8)  # letters in lower case, 32 for the rest
_LETTER[:] = 32
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Model:
    idf: np.ndarray  # per feature
    centroids: np.ndarray  # a row per centroid
    language: np.ndarray  # of each centroid
    floor: float  # least adjusted cosine that is accepted


def counted(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, 3-gram counts) of consecutive texts, ``ROWS_AT_A_TIME`` at most."""
    data, offsets = wd.utf8(column)
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + wd.STEP_BYTES, "right")) - 1
        stop = min(n, start + ROWS_AT_A_TIME, max(stop, start + 1))
        part = _LETTER[data[offsets[start] : offsets[stop]]]
        after = np.concatenate(([0], part[:-1]))
        part = np.where((after == 0xC3) & (part >= 0x80) & (part < 0x9F), part + 32, part)  # À to Þ
        text = np.repeat(np.arange(stop - start, dtype=np.int64), np.diff(offsets[start : stop + 1]))
        keep = np.ones(len(part), bool)
        keep[1:] = (part[1:] != 32) | (part[:-1] != 32) | (text[1:] != text[:-1])
        part, text = part[keep].astype(np.uint32), text[keep]
        if len(part) > 2:
            grams = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
            feature = ((grams * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
            cells = (text[:-2] * FEATURES + feature)[text[:-2] == text[2:]]
        else:
            cells = np.zeros(0, np.int64)
        yield start, np.bincount(cells, minlength=(stop - start) * FEATURES).reshape(-1, FEATURES)
        start = stop


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts.astype(np.float32)) * idf
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.maximum(norms, 1e-12)


def reach(grams: np.ndarray) -> np.ndarray:
    """Share of its cosine that a text of so many 3-grams can reach."""
    return np.sqrt(np.maximum(grams, 1) / (np.maximum(grams, 1) + HALF))


def clustered(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean and then the texts furthest from all centres."""
    mean = vectors.mean(axis=0)
    centres = [vectors[int(np.argmax(vectors @ mean))]]
    while len(centres) < min(k, len(vectors)):
        centres.append(vectors[int(np.argmin((vectors @ np.stack(centres).T).max(axis=1)))])
    centres = np.stack(centres)
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else c for i, c in enumerate(centres)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(labelled: DataFrame, sample: int = 1200, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model from rows with text and language. ``sample`` bounds the vectors on the driver."""
    rows = labelled.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(sample).collect()}
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    chance = unit(F.xxhash64(F.lit(3), "id"))
    share = F.create_map(*[F.lit(x) for l, n in sizes.items() for x in (l, min(1.0, 2.0 * each / n))])
    first = Window.partitionBy("lang").orderBy("h", "id")
    taken = (
        rows.withColumn("h", chance).where(F.col("h") <= share[F.col("lang")])
        .withColumn("r", F.row_number().over(first)).where(F.col("r") <= each)
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, counts in counted(batch.column("text")):
                values = [np.minimum(row, 65535).astype(np.uint16).tobytes() for row in counts]
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(at, len(values)), pa.array(values, pa.binary())], ["lang", "counts"])

    table = taken.select("lang", "text").mapInArrow(pk.trimming(vectors), "lang string, counts binary").toArrow()
    langs = np.array(table["lang"].to_pylist())
    counts = np.stack([np.frombuffer(b, np.uint16) for b in table["counts"].to_pylist()]).astype(np.float32)
    langs, counts = langs[counts.sum(axis=1) > 0], counts[counts.sum(axis=1) > 0]
    if not len(langs):
        return None
    order = np.lexsort((*counts.T[:8], counts.sum(axis=1), langs))
    langs, counts = langs[order], counts[order]
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    points = weighted(counts, idf)
    centroids, owners, worst = [], [], []
    for language in sorted(set(langs)):
        own = points[langs == language]
        found = clustered(own, CENTROIDS)
        centroids.append(found)
        owners += [language] * len(found)
        worst.append(((own @ found.T).max(axis=1) / reach(counts[langs == language].sum(axis=1))).min())
    return Model(idf, np.concatenate(centroids).astype(np.float32), np.array(owners), float(STRICTNESS * min(worst)))


def identified(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``lang_pred``, ``score``, ``rejected``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score", "rejected")]
    pk.small_batches(docs.sparkSession)
    # only whether a letter occurs is asked of the JVM, which stops at the first
    rows = docs.select(*dict.fromkeys([*keep, text])).withColumn("_letters", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    out = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    schema = to_arrow_schema(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for table in pk.blocks(batches, text):
            best, score, floor = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows), np.zeros(table.num_rows)
            for at, counts in counted(table[text]) if m is not None else ():
                cosines = weighted(counts, m.idf) @ m.centroids.T
                rows_ = slice(at, at + len(counts))
                best[rows_], score[rows_] = np.argmax(cosines, axis=1), cosines.max(axis=1)
                floor[rows_] = m.floor * reach(counts.sum(axis=1))
            has = table["_letters"].to_numpy(zero_copy_only=False).astype(bool) & (m is not None)
            score = np.where(has, np.clip(score, 0, 1), 0.0)
            lang = np.where(has, m.language[best] if m is not None else UNDETERMINED, UNDETERMINED)
            extra = {"lang_pred": pa.array(lang.tolist(), pa.string()), "score": pa.array(score), "rejected": pa.array(~has | (score < floor))}
            for part in pa.table([extra.get(n, table[n] if n in table.column_names else None) for n in schema.names], schema=schema).to_batches(max_chunksize=10_000):
                yield part

    return rows.mapInArrow(pk.trimming(identify), out).select(*keep, "lang_pred", "score", "rejected")
