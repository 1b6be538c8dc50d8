"""Word vectors learned from the archive itself: co-occurrence, mutual information, randomised SVD.

Words that stand near each other in many texts get vectors that point the same way. Pairs of
frequent words within ``WINDOW`` places are counted in the tasks and added up by a shuffle; the pointwise
mutual information of each pair, where positive, is an entry of a symmetric matrix that stays a
table. Its leading eigenvectors come from a randomised range finder: the table is multiplied with a
thin matrix a few times, a job each, and only thin matrices, one row per word of the vocabulary, are on
the driver. The size of the vocabulary and the number of dimensions are parameters of the model;
every text counts, whole.

Words are split as everywhere (:func:`archiveloom.functions.text.words`). Ties in frequency go to the
smaller word. The same texts give the same vectors, to rounding, in any partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiveloom.functions.text import words
from archiveloom.operators.batches import small_batches
from archiveloom.operators.vectors import Embedder
from archiveloom.staging import StagingArea

VOCABULARY = 4096  # words with a vector
DIMENSIONS = 64
WINDOW = 4  # places between two words that are near
SPARE = 16  # further columns of the thin matrices, for accuracy
PIECE_WORDS = 1 << 18  # words that are counted at a time, unless one text has more
ROUNDS = 3  # multiplications before the eigenvectors are read off


def frequent_words(texts: DataFrame, text: str = "text", size: int = VOCABULARY) -> list[str]:
    """The most frequent words, the most frequent first."""
    counted = texts.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(size).collect()]


def near_pairs(texts: DataFrame, text: str, vocabulary: list[str], window: int = WINDOW) -> DataFrame:
    """(i, j, n): how often words ``i`` and ``j`` of the vocabulary are near, in either order.

    Other words keep their places. Counts are combined per piece of a batch before the shuffle; a
    piece is whole texts of about ``PIECE_WORDS`` words, so what a task holds does not grow with
    the number of texts.
    """
    known, size = pa.array(vocabulary, pa.string()), max(1, len(vocabulary))
    small_batches(texts.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        for batch in batches:
            lists = batch.column(0)
            words_upto = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(lists):
                done = words_upto[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(words_upto, done + PIECE_WORDS, "right")))
                yield lists.slice(at, stop - at)
                at = stop

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in pieces(batches):
            number = pc.fill_null(pc.index_in(lists.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            pairs = []
            for reach in range(1, window + 1):
                a, b = number[:-reach], number[reach:]
                near = (row[:-reach] == row[reach:]) & (a >= 0) & (b >= 0)
                pairs += [a[near] * size + b[near], b[near] * size + a[near]]
            pair, n = np.unique(np.concatenate(pairs), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair // size), pa.array(pair % size), pa.array(n.astype(np.int64))], ["i", "j", "n"])

    split = texts.select(words(F.col(text)).alias("words")).where(F.size("words") > 1)
    return split.mapInArrow(count, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))


def associations(pairs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(i, j, word, near, n, pmi) of every pair: the log of its share over the share by chance.

    ``pairs`` is read several times and should be a written table.
    """
    name = pairs.sparkSession.createDataFrame(list(enumerate(vocabulary)), "i long, word string")
    # one row per word of the vocabulary
    sums = pairs.groupBy("i").agg(F.sum("n").alias("r"))
    total = F.lit(pairs.agg(F.sum("n")).first()[0]).cast("double")
    first = sums.join(F.broadcast(name), "i")
    second = first.select(F.col("i").alias("j"), F.col("word").alias("near"), F.col("r").alias("s"))
    shares = pairs.join(F.broadcast(first), "i").join(F.broadcast(second), "j")
    pmi = F.log(F.col("n").cast("double") * total / (F.col("r").cast("double") * F.col("s")))
    return shares.select("i", "j", "word", "near", "n", pmi.alias("pmi"))


def _times(entries: DataFrame, thin: np.ndarray) -> np.ndarray:
    """The matrix of (i, j, value) times a thin one; entries are sorted by ``i`` and ``j``."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            i, j, value = (batch.column(c).to_numpy() for c in range(3))
            starts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
            sums = np.add.reduceat(thin[j] * value[:, None], starts)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1) * thin.shape[1], pa.int32()), pa.array(sums.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(i[starts]), pa.array(j[starts]), vectors], ["i", "j", "part"])

    out = np.zeros_like(thin)
    # a row of the vocabulary each, and one more for every batch that begins within a row
    for r in sorted(entries.mapInArrow(multiply, "i long, j long, part array<double>").collect()):
        out[r["i"]] += r["part"]
    return out


def learned_vectors(
    texts: DataFrame, text: str = "text", size: int = VOCABULARY, dimensions: int = DIMENSIONS, seed: int = 1
) -> tuple[list[str], np.ndarray]:
    """The vocabulary, and a row per word of it: leading eigenvectors times roots of their values.

    Dimensions beyond the positive eigenvalues are zero, as is the vector of a word that is near
    none. The largest entry of each eigenvector is positive.
    """
    vocabulary = frequent_words(texts, text, size)
    found = np.zeros((len(vocabulary), dimensions))
    if not vocabulary:
        return vocabulary, found
    staging = StagingArea(texts.sparkSession, "cooccurrence")
    pairs, _ = staging.write(near_pairs(texts, text, vocabulary), "pairs")
    positive = associations(pairs, vocabulary).where("pmi > 0").select("i", "j", "pmi")
    entries, _ = staging.write(positive.repartition("i").sortWithinPartitions("i", "j"), "entries")
    width = min(len(vocabulary), dimensions + SPARE)
    basis = np.random.default_rng(seed).standard_normal((len(vocabulary), width))
    for _ in range(ROUNDS):
        basis = np.linalg.qr(_times(entries, basis))[0]
    small = basis.T @ _times(entries, basis)
    values, turned = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:dimensions]
    values, axes = np.maximum(values[order], 0), basis @ turned[:, order]
    largest = np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], axis=0)
    found[:, : len(order)] = axes * np.where(largest < 0, -1.0, 1.0) * np.sqrt(values)
    staging.release()
    return vocabulary, found


def learned_embedder(vocabulary: list[str], vectors: np.ndarray) -> Embedder:
    """A text's vector is the sum of its words' vectors; it fits wherever an embedder does."""
    known = pa.array(vocabulary, pa.string())
    table = np.vstack([vectors, np.zeros(vectors.shape[1])])  # the last row is for other words

    @F.pandas_udf("array<double>")
    def add_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                number = pc.index_in(pa.array(text if text is not None else [], pa.string()), value_set=known)
                found, times = np.unique(pc.fill_null(number, -1).to_numpy(zero_copy_only=False), return_counts=True)
                out.append(times.astype(float) @ table[found.astype(np.int64)])
            yield pd.Series(out)

    return lambda text: add_up(words(text))
