"""An index of the URLs that are stored, so that new records meet few of them.

Every batch of URLs leaves two tables. ``urls`` holds them in folders by bucket, a hash of the URL.
``words`` is a Bloom filter of 64-bit words: a URL sets four bits of one word, a word takes about
``PER_WORD`` URLs, and a batch has as many words as its URLs fill, rounded to a power of two. A
lookup joins its URLs with the words, about two bytes per stored URL; what the filters cannot
exclude, the URLs that are stored and about one in twenty of those that are not, decides which buckets
are read, and these are compared URL by URL. Nothing of a lookup reaches the driver but the
numbers of buckets and sizes, both bounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.staging import StagingArea

BUCKETS = 256
PER_WORD = 8  # URLs a word holds on average
_BITS = " | ".join(f"shiftleft(1L, cast(pmod(shiftright(_bits, {6 * i}), 64) as int))" for i in range(4))
_WORD = "pmod(shiftright(_hash, 16), size)"


class KnownUrls:
    """The index at ``path``; a batch that is added again replaces what it had."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _hashed(self, urls: DataFrame) -> DataFrame:
        """(project_url, bucket, _hash, mask) of the distinct URLs; NULL is none."""
        own = urls.select("project_url").where("project_url is not null").distinct()
        hashed = own.withColumns({"_hash": F.xxhash64("project_url"), "_bits": F.xxhash64(F.lit(1), "project_url")})
        return hashed.select(
            "project_url", F.pmod("_hash", F.lit(self.buckets)).cast("int").alias("bucket"), "_hash", F.expr(_BITS).alias("mask")
        )

    def _folder(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> set[int]:
        """The batches that are in the index; one whose writing was broken off is not."""
        path, files = self._folder("words")
        if not files.exists(path):
            return set()
        found = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("batch=")]
        done = lambda p: files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return {int(p.getName().removeprefix("batch=")) for p in found if done(p)}

    def add(self, urls: DataFrame, batch: int) -> None:
        staging = StagingArea(self.spark, "known-urls")
        own, seen = staging.write(self._hashed(urls), "urls", n=F.count(F.lit(1)))
        size = 1 << (seen["n"] // (PER_WORD * self.buckets)).bit_length()
        by_bucket = own.select("project_url", "bucket").repartition("bucket").sortWithinPartitions("bucket")
        by_bucket.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/urls/batch={batch}")
        words = own.withColumn("size", F.lit(size).cast("bigint")).withColumn("word", F.expr(_WORD))
        # the words come last: a batch is in the index when they are whole
        words.groupBy("bucket", "size", "word").agg(F.bit_or("mask").alias("bits")).write.mode("overwrite").parquet(
            f"{self.path}/words/batch={batch}"
        )
        staging.release()

    def catch_up(self, stored: dict[int, Callable[[], DataFrame]]) -> None:
        """Adds the stored batches that the index lacks."""
        for batch in sorted(stored.keys() - self.batches()):
            self.add(stored[batch](), batch)

    def possible(self, urls: DataFrame, before: int) -> DataFrame:
        """(project_url, bucket): those of ``urls`` that the filters before ``before`` cannot exclude."""
        nothing = self.spark.createDataFrame([], "project_url string, bucket int")
        if not self.batches():
            return nothing
        words = self.spark.read.schema("bucket int, size bigint, word bigint, bits bigint, batch int").parquet(f"{self.path}/words")
        words = words.where(F.col("batch") < before)
        sizes = sorted(r["size"] for r in words.select("size").distinct().collect())  # powers of two, so few
        if not sizes:
            return nothing
        probes = self._hashed(urls).withColumn("size", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
        return (
            probes.withColumn("word", F.expr(_WORD)).join(words, ["bucket", "size", "word"])
            .where("bits & mask = mask").select("project_url", "bucket").distinct()
        )

    def among(self, urls: DataFrame, before: int) -> DataFrame:
        """(project_url): those of ``urls`` that batches before ``before`` hold, once each."""
        passed, seen = StagingArea(self.spark, "known-urls").write(self.possible(urls, before), "passed", n=F.count(F.lit(1)))
        if not seen["n"]:
            return passed.select("project_url")
        hit = [r["bucket"] for r in passed.select("bucket").distinct().collect()]  # at most ``buckets``
        stored = self.spark.read.schema("project_url string, batch int, bucket int").parquet(f"{self.path}/urls")
        stored = stored.where((F.col("batch") < before) & F.col("bucket").isin(hit)).select("project_url")
        return stored.join(passed.select("project_url"), "project_url", "left_semi").distinct()
