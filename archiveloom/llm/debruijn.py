"""Substring dedup (6): de Bruijn graph of repeated token windows, compacted to spans.

Every window of k words is an edge between its first and its last k - 1 words. Edges are dealt
into buckets by their minimizer, the smallest hash among their 4-word shingles, so that most
edges that follow each other meet in one bucket. There, an edge found in several documents gets
the coordinates of its first occurrence (smallest document), and edges that follow each other
both in a document and at the coordinates are compacted into one piece of a path. Pieces of
different buckets are joined where the next begins at the end of the last, again on both sides:
what is left are the maximal nonbranching paths a document shares with its source. Last, the
words of each span are compared, by a 160-bit digest, with the words at its coordinates; a span
that differs (a collision of window hashes) is dropped and the rest applied again.

A window's first occurrence is the row with the smallest id; only larger ids lose words. Windows
are judged on the input. Of each window, a block of documents sends the occurrences in its
smallest document only, whatever the window's frequency; the others are settled there.

Defined results: a NULL or short text has no windows and keeps its words; a row with a NULL id
comes after all others, with the largest id if that occurs; rows of one id are one document to each other (they take nothing from
each other), each row is returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd
from archiveloom.staging import StagingArea

MINIMIZER = 4  # words of the shingle that chooses a window's bucket
# Bytes of a window's hash that are sent, besides the bucket it is sent to. A collision costs a
# round of verification, not a wrong result; beyond some 10^10 words take 8.
HASH_BYTES = 7
LAST_ID = np.iinfo(np.int64).max

_PIECES = "id long, key long, twin long, pos int, length int, source_id long, source_key long, source_twin long, source_pos int"
_SENT = "bucket int, hashes binary, run_doc binary, run_pos binary, run_length binary, ids binary, keys binary, pieces binary"


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive numbers."""
    span, out = 1, x
    while 2 * span <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _pieces(id_, key, pos, source_id, source_key, source_pos) -> np.ndarray:
    """Occurrences in order of (key, pos) as rows of ``_PIECES``: consecutive ones are one row."""
    same = [(key[:, 0], 0), (key[:, 1], 0), (id_, 0), (source_key[:, 0], 0), (source_key[:, 1], 0), (source_id, 0)]
    starts = pk.runs(*same, (pos, 1), (source_pos, 1))
    take = lambda x: x[starts].astype(np.int64)
    return np.stack([
        take(id_), *take(key).T, take(pos), pk.run_lengths(starts, len(pos)), take(source_id), *take(source_key).T, take(source_pos),
    ])


def _sender(k: int, bits: int, hash_bytes: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pk.blocks(batches, "text"):
            order = np.argsort(table["id"].to_numpy(), kind="stable")
            table = table.take(pa.array(order))
            ids = table["id"].to_numpy()
            keys = np.stack([table["key"].to_numpy(), table["twin"].to_numpy()], axis=1)
            text = wd.split(table["text"])
            hashes, at = wd.windows(text, k)
            if not len(hashes):
                continue
            least = _least(wd.rolling(text.hashes, MINIMIZER), k - MINIMIZER + 1)[at]
            doc = text.texts()[at].astype(np.int32)
            pos = (at - text.first[doc]).astype(np.int32)
            order = np.argsort(hashes, kind="stable")  # within a hash: by id
            same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]]) + 1
            first = np.ones(len(order), bool)
            first[same] = False
            owner = np.empty(len(order), np.int64)
            owner[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            later = np.flatnonzero(ids[doc] > ids[doc[owner]])
            local = owner[later]
            settled = _pieces(ids[doc[later]], keys[doc[later]], pos[later], ids[doc[local]], keys[doc[local]], pos[local])
            sent = np.flatnonzero(ids[doc] == ids[doc[owner]])
            bucket = (wd.mix(least[sent]) >> np.uint64(64 - bits)).astype(np.int64)
            order, begins = pk.split_by(bucket, 1 << bits)
            sent = sent[order]
            spread = int(keys[0, 0]) % (1 << bits)  # settled pieces travel with any bucket
            rows = []
            for b in range(1 << bits):
                mine = sent[begins[b] : begins[b + 1]]
                if not len(mine) and b != spread:
                    continue
                starts = pk.runs((doc[mine], 0), (pos[mine], 1))
                docs, run_doc = np.unique(doc[mine[starts]], return_inverse=True)
                rows.append({
                    "bucket": b,
                    "hashes": pk.low_bytes(hashes[mine], hash_bytes),
                    "run_doc": run_doc.astype(np.int32).tobytes(),
                    "run_pos": pos[mine[starts]].tobytes(),
                    "run_length": pk.run_lengths(starts, len(mine)).astype(np.int32).tobytes(),
                    "ids": ids[docs].tobytes(),
                    "keys": keys[docs].tobytes(),
                    "pieces": settled.tobytes() if b == spread else b"",
                })
            yield pa.RecordBatch.from_pylist(rows, _SENT_ARROW)

    return send


_SENT_ARROW = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("hashes", "run_doc", "run_pos", "run_length", "ids", "keys", "pieces")])
_PLACES = ("pos", "length", "source_pos")
_PIECE_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


def _meeter(hash_bytes: int):
    def meet(table: pa.Table) -> pa.Table:
        """One bucket: path pieces of its repeated edges, besides those settled by the senders."""
        hashes, id_, key, pos, found = [], [], [], [], []
        for row in table.to_pylist():
            lengths = np.frombuffer(row["run_length"], np.int32)
            doc = np.repeat(np.frombuffer(row["run_doc"], np.int32), lengths)
            hashes.append(pk.from_low_bytes(row["hashes"], hash_bytes))
            id_.append(np.frombuffer(row["ids"], np.int64)[doc])
            key.append(np.frombuffer(row["keys"], np.int64).reshape(-1, 2)[doc])
            pos.append(pk.expand(np.frombuffer(row["run_pos"], np.int32), lengths))
            found.append(np.frombuffer(row["pieces"], np.int64).reshape(len(_PIECE_NAMES), -1))
        hashes, id_, key, pos = map(np.concatenate, (hashes, id_, key, pos))
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        repeated = order[np.append(same, False) | np.insert(same, 0, False)] if len(order) else order
        # by edge, then id: the first of each edge is its source
        order = repeated[np.lexsort((key[repeated, 1], key[repeated, 0], id_[repeated], hashes[repeated]))]
        starts = pk.runs((hashes[order], 0)) if len(order) else order
        source = np.repeat(order[starts], pk.run_lengths(starts, len(order))) if len(order) else order
        later = id_[order] > id_[source]
        order, source = order[later], source[later]
        by_place = np.lexsort((pos[order], key[order, 1], key[order, 0], id_[order]))
        order, source = order[by_place], source[by_place]
        if len(order):
            found.append(_pieces(id_[order], key[order], pos[order], id_[source], key[source], pos[source]))
        found = np.concatenate(found, axis=1)
        return pa.table(dict(zip(_PIECE_NAMES, [found[i].astype(np.int32) if n in _PLACES else found[i] for i, n in enumerate(_PIECE_NAMES)])))

    return meet


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, twin, missing, text): 128 bits of key tell rows of one id with different texts apart."""
    id_ = F.coalesce(F.col(id).cast("long"), F.lit(int(LAST_ID)))
    return docs.select(
        id_.alias("id"), F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("twin"),
        F.col(id).isNull().alias("missing"), F.col(text).alias("text"),
    )


def path_pieces(rows: DataFrame, k: int) -> DataFrame:
    """``_PIECES`` of all documents, compacted within buckets."""
    pk.small_batches(rows.sparkSession)
    bits = pk.bucket_bits(rows)
    sent = rows.mapInArrow(_sender(k, bits, HASH_BYTES), _SENT)
    return sent.groupBy("bucket").applyInArrow(_meeter(HASH_BYTES), _PIECES)


def joined_paths(pieces: DataFrame) -> DataFrame:
    """Pieces joined where one follows the other in the document and at the source.

    The successor of a piece is the next piece of its document, so the joins are one window.
    """
    own = Window.partitionBy("id", "key", "twin").orderBy("pos", "source_id", "source_key", "source_twin", "source_pos")
    last = lambda c: F.lag(c).over(own)
    follows = (
        (last("pos") + last("length") == F.col("pos"))
        & (last("source_id") == F.col("source_id"))
        & (last("source_key") == F.col("source_key"))
        & (last("source_twin") == F.col("source_twin"))
        & (last("source_pos") + last("length") == F.col("source_pos"))
    )
    path = F.sum(F.when(follows, 0).otherwise(1)).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return (
        pieces.withColumn("path", path)
        .groupBy("id", "key", "twin", "path", "source_id", "source_key", "source_twin")
        .agg(F.min("pos").alias("pos"), F.sum("length").cast("int").alias("length"), F.min("source_pos").alias("source_pos"))
        .select(*_PIECE_NAMES)
    )


def _applier(k: int):
    """Takes the spans' words out of each text and digests spans and sources."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield pa.RecordBatch.from_pylist([one(r) for r in batch.slice(at, 500).to_pylist()], _APPLIED_ARROW)

    def one(row: dict) -> dict:
        words = (row["text"] or "").encode().split()
        gone = np.zeros(len(words) + 1, np.int32)
        digests = []
        digest = lambda pos, n: hashlib.sha1(b" ".join(words[pos : pos + n + k - 1])).digest()
        for s in row["copies"] or []:
            gone[s["pos"]] += 1
            gone[min(len(words), s["pos"] + s["length"] + k - 1)] -= 1
            digests.append({"id": s["source_id"], "key": s["source_key"], "twin": s["source_twin"], "pos": s["source_pos"], "length": s["length"], "digest": digest(s["pos"], s["length"])})
        for s in row["sources"] or []:
            digests.append({"id": row["id"], "key": row["key"], "twin": row["twin"], "pos": s["pos"], "length": s["length"], "digest": digest(s["pos"], s["length"])})
        if digests and row["copies"]:
            keep = np.cumsum(gone[:-1]) == 0
            kept = [words[i] for i in np.flatnonzero(keep)]
        else:
            kept = words
        return {"id": row["id"], "missing": row["missing"], "n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(), "digests": digests}

    return apply


_DIGEST = [("id", pa.int64()), ("key", pa.int64()), ("twin", pa.int64()), ("pos", pa.int32()), ("length", pa.int32()), ("digest", pa.binary())]
_APPLIED_ARROW = pa.schema([
    ("id", pa.int64()), ("missing", pa.bool_()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("digests", pa.list_(pa.struct(_DIGEST))),
])
_APPLIED = "id long, missing boolean, n_words long, n_removed long, kept_sha256 string, digests array<struct<id:long,key:long,twin:long,pos:int,length:int,digest:binary>>"


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with ``copies`` (their spans) and ``sources`` (places other spans point to)."""
    copies = spans.select(
        "id", "key", "twin", F.struct("pos", "length", "source_id", "source_key", "source_twin", "source_pos").alias("copy"),
        F.lit(None).cast("struct<pos:int,length:int>").alias("source"),
    )
    sources = spans.select("source_id", "source_key", "source_twin", "source_pos", "length").distinct().select(
        F.col("source_id").alias("id"), F.col("source_key").alias("key"), F.col("source_twin").alias("twin"),
        F.lit(None).cast(copies.schema["copy"].dataType).alias("copy"),
        F.struct(F.col("source_pos").alias("pos"), "length").alias("source"),
    )
    both = copies.union(sources).groupBy("id", "key", "twin").agg(F.collect_list("copy").alias("copies"), F.collect_list("source").alias("sources"))
    return rows.join(both, ["id", "key", "twin"], "left")


def repeated_spans(docs: DataFrame, k: int = 13, id: str = "doc_id", text: str = "text", staging: StagingArea | None = None) -> DataFrame:
    """Spans (document, first window, number of windows, and the same of the source), staged."""
    staging = staging or StagingArea(docs.sparkSession, "debruijn")
    spans, _ = staging.write(joined_paths(path_pieces(keyed(docs, id, text), k)), "spans")
    return spans


def remove_repeats(docs: DataFrame, k: int = 13, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row, from verified spans."""
    staging = StagingArea(docs.sparkSession, "debruijn")
    rows = keyed(docs, id, text)
    spans = repeated_spans(docs, k, id, text, staging)
    place = ["source_id", "source_key", "source_twin", "source_pos", "length"]
    attempt = 0
    while True:
        applied, _ = staging.write(with_spans(rows, spans).mapInArrow(_applier(k), _APPLIED), f"applied-{attempt}")
        differing = (
            applied.select(F.inline("digests"))
            .groupBy("id", "key", "twin", "pos", "length")
            .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
            .where("low <> high")
            .toDF(*place, "low", "high")
        )
        if differing.isEmpty():
            break
        spans, _ = staging.write(spans.join(differing.select(*place), place, "left_anti"), f"spans-{attempt}")
        attempt += 1
    own = F.when(~F.col("missing"), F.col("id"))
    return applied.select(own.alias(id), "n_words", "n_removed", "kept_sha256")
