"""Benchmark decontamination (1): training suffix arrays searched with every test suffix.

A task takes its documents block by block; each block is a shard with its own suffix array: the
positions whose next words all belong to the benchmark's vocabulary, sorted by those words.
Every suffix of every test item is looked up by binary search, which gives all places in the
shard with the same ``k`` words (or the same whole item, if it has fewer); each match is
extended word by word to the longest verbatim one and reported with its place. Other positions
cannot start a match, so leaving them out of the array loses nothing.

Test items reach the tasks in blocks of at most ``TEST_BYTES`` of text, read one after the
other; a benchmark of any size takes as many passes over the words as it has blocks, all in one
scan without a shuffle.

Defined results: a NULL text, of a document or an item, has no words and matches nothing; an
item's name is its id as text (NULL: empty), and rows with one name are one item; repeated
documents are judged alike; empty tables give no matches; the columns ``n_words`` and
``matches`` of the input, if any, are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd

TEST_BYTES = 4 << 20

MATCH = T.StructType([
    T.StructField("item", T.StringType()), T.StructField("item_pos", T.IntegerType()),
    T.StructField("pos", T.IntegerType()), T.StructField("length", T.IntegerType()),
])
_MATCH = pa.struct([("item", pa.string()), ("item_pos", pa.int32()), ("pos", pa.int32()), ("length", pa.int32())])


class TestSuffixes:
    """The suffixes of a block of items: word numbers, and the window each suffix looks for."""

    def __init__(self, names: list[str], texts: list[str], k: int):
        text = wd.split(pa.array(texts, pa.string()), wd.NON_WORD, lower=True)
        self.k, self.names, self.first = k, names, text.first
        self.vocabulary, numbers = np.unique(text.hashes, return_inverse=True)
        self.numbers = np.append(numbers.astype(np.int32) + 1, np.zeros(k, np.int32))
        self.item = text.texts()
        counts = text.counts
        left = text.first[1:][self.item] - np.arange(len(self.item))  # words to the item's end
        whole = np.arange(len(self.item)) == text.first[:-1][self.item]
        self.at = np.flatnonzero((left >= k) | (whole & (counts[self.item] < k)))
        self.width = np.minimum(k, counts[self.item[self.at]]).astype(np.int32)
        words = self.numbers[self.at[:, None] + np.arange(k)]
        asked = np.arange(k) < self.width[:, None]
        self.low = as_keys(np.where(asked, words, 0))
        self.high = as_keys(np.where(asked, words, -1))  # sorts after every word number

    @property
    def shortest(self) -> int:
        return int(self.width.min()) if len(self.width) else 0


def as_keys(numbers: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings that sort like the rows."""
    return np.ascontiguousarray(numbers.astype(">u4")).view(f"S{4 * numbers.shape[1]}").reshape(-1)


def _matches(text: wd.Words, tests: TestSuffixes) -> list[np.ndarray]:
    """Longest matches of one shard: document, item, place in the item, place, length."""
    k = tests.k
    empty = [np.zeros(0, np.int64)] * 5
    if not len(text.hashes) or not len(tests.at):
        return empty
    found = np.minimum(np.searchsorted(tests.vocabulary, text.hashes), len(tests.vocabulary) - 1)
    known = tests.vocabulary[found] == text.hashes
    # one 0 after each document and k at the end, so that no match runs into the next document
    place = np.arange(len(text.hashes)) + text.texts()
    numbers = np.zeros(len(text.hashes) + len(text.first) + k, np.int32)
    numbers[place] = np.where(known, found + 1, 0)
    stop = np.flatnonzero(numbers == 0)
    at = place[known]
    room = stop[np.searchsorted(stop, at)] - at  # known words from here on
    at = at[room >= tests.shortest]
    keys = as_keys(numbers[at[:, None] + np.arange(k)])
    suffixes = np.argsort(keys, kind="stable")
    keys = keys[suffixes]
    low, high = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    counts = high - low
    mine = np.repeat(tests.at, counts)  # the test suffix of each match
    theirs = at[suffixes[pk.expand(low, counts)]]
    length = np.repeat(tests.width, counts).astype(np.int64)
    item = tests.item[mine]
    # a match that only continues one begun a word earlier is part of that one
    begins = tests.first[:-1][item] == mine
    continued = ~begins & (theirs > 0) & (length == k)
    continued &= numbers[np.maximum(theirs - 1, 0)] == tests.numbers[np.maximum(mine - 1, 0)]
    mine, theirs, length, item = (x[~continued] for x in (mine, theirs, length, item))
    ends = tests.first[1:][item]
    growing = np.arange(len(mine))
    while len(growing):
        m, t = mine[growing] + length[growing], theirs[growing] + length[growing]
        inside = m < ends[growing]
        same = inside & (numbers[t] == tests.numbers[np.minimum(m, len(tests.numbers) - 1)])
        growing = growing[same]
        length[growing] += 1
    doc = np.searchsorted(text.first + np.arange(len(text.first)), theirs, "right") - 1
    pos = theirs - text.first[doc] - doc
    order = np.lexsort((item, pos, doc))
    return [x[order] for x in (doc, item, mine - tests.first[:-1][item], pos, length)]


def _searcher(tests, text: str, first: bool, schema: pa.Schema):
    """``tests`` is a broadcast :class:`TestSuffixes`; earlier passes' matches are kept."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tests.value
        for table in pk.blocks(batches, text):
            words = wd.split(table[text], wd.NON_WORD, lower=True)
            doc, item, item_pos, pos, length = _matches(words, own)
            offsets = np.searchsorted(doc, np.arange(table.num_rows + 1))
            columns = [pa.array(own.names, pa.string()).take(pa.array(item))] + [pa.array(x, pa.int32()) for x in (item_pos, pos, length)]
            values = pa.StructArray.from_arrays(columns, fields=list(_MATCH))
            matches = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            if not first:
                before = table["matches"].to_pylist()
                matches = pa.array([b + m for b, m in zip(before, matches.to_pylist())], pa.list_(_MATCH))
            out = {n: table[n] for n in table.column_names} | {"n_words": pa.array(words.counts, pa.int64()), "matches": matches}
            for part in pa.table([out[n] for n in schema.names], schema=schema).to_batches(max_chunksize=10_000):
                yield part

    return pk.trimming(search)


def matched(docs: DataFrame, tests: DataFrame, k: int = 10, keep: list[str] | None = None, id: str = "item_id", test_text: str = "text", text: str = "text") -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``n_words`` and ``matches``.

    ``matches`` are (item, item_pos, pos, length) in words, each as long as it gets; a window
    of ``k`` words lies in a document exactly where a match covers it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    pk.small_batches(spark)
    keep = [c for c in (keep or docs.columns) if c not in ("n_words", "matches")]
    items = tests.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("name"), F.coalesce(test_text, F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-total // TEST_BYTES))
    out = docs.select(*dict.fromkeys([*keep, text]))
    fields = [f for f in out.schema.fields]
    result = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("matches", T.ArrayType(MATCH))])
    for block in range(n_blocks):
        # 1/n_blocks of the items: about TEST_BYTES, whatever the benchmark's size
        part = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks)) == block).toArrow()
        suffixes = TestSuffixes(part["name"].to_pylist(), part["text"].to_pylist(), k)
        out = out.mapInArrow(_searcher(spark.sparkContext.broadcast(suffixes), text, block == 0, to_arrow_schema(result)), result)
    return out.select(*keep, "n_words", "matches")


def items_hit(matches: str = "matches") -> Column:
    """Names of the items with a match, once each, sorted as strings."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item"])))


def words_hit(matches: str = "matches") -> Column:
    """Number of a document's words that lie in a match."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["pos"].alias("lo"), (m["pos"] + m["length"]).alias("hi"))))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def step(a: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0), s["hi"] - F.greatest(s["lo"], a["upto"]))
        return F.struct(F.greatest(a["upto"], s["hi"]).alias("upto"), (a["n"] + new).alias("n"))

    return F.aggregate(spans, zero, step, lambda a: a["n"]).cast("long")


def decontaminated(docs: DataFrame, tests: DataFrame, k: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a test window; nothing is shuffled."""
    return matched(docs, tests, k).where(F.size("matches") == 0).drop("n_words", "matches")
