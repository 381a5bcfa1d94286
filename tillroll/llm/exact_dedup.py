"""Exact dedup with a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 digest of the text. A batch of new
rows is reduced to one row per digest (partial counts before the shuffle, so a text that a
third of all rows share is one row per task), set against the index by a sort-merge
anti-join that reads the index bucket by bucket without shuffling it, and what is new is
appended. For digests that the index has already, the batch's count and largest id are
appended as an addition; readers add additions up within their bucket, so the row that
stays is the one with the largest id of all batches.

Everything is DataFrame functions. Defined results: a null text counts as empty; a
null id never stays while its group has another; repeated rows are rows of their own
and all count (rows with the same id and text are kept or dropped together); an empty
batch adds nothing; other columns are not read. Ids are whole numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import written
from tillroll.session import remove_path, scratch_path

SCHEMA = "digest binary, keep_id bigint, group_size bigint, is_new boolean, batch string"
#: Rows of a new index that a bucket is made for, and its least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1 << 20, 64


def digest_of(text: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """A digest index stored at ``path``; the table is made when the path has none."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64) -> None:
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_path(spark, "digest-index")
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"create table {self.table} ({SCHEMA}) using parquet "
            f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{self.path}'"
        )

    def drop(self) -> None:
        """Take the table out of the catalogue; what is stored stays for the next one."""
        self.spark.sql(f"drop table if exists {self.table}")

    def stored(self) -> DataFrame:
        return self.spark.table(self.table)

    def rows(self) -> DataFrame:
        """(digest, keep_id, group_size) of every distinct text of all batches."""
        return self.stored().groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )

    def add(self, docs: DataFrame, batch: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append ``docs`` to the index; returns the index rows of the texts that it lacked."""
        batch = batch or uuid.uuid4().hex
        groups = written(
            docs.select(digest_of(text_col).alias("digest"), F.col(id_col).cast("bigint").alias("keep_id")).groupBy("digest").agg(
                F.max("keep_id").alias("keep_id"), F.count("*").alias("group_size")
            ),
            "batch-digests",
        )
        known = self.stored().where("is_new").select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti").withColumn("is_new", F.lit(True))
        again = groups.join(known, "digest", "left_semi").withColumn("is_new", F.lit(False))
        both = fresh.unionByName(again).withColumn("batch", F.lit(batch))
        # Dealt by Spark's own bucket number, so that a bucket is one file of the batch whatever the
        # number of tasks; written in one go, so that a failed batch leaves nothing behind.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        both.repartition(self.buckets, bucket).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        return self.stored().where((F.col("batch") == batch) & F.col("is_new"))

    def lookup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: int = 256) -> DataFrame:
        """(id, digest, keep_id, group_size) for each row of ``docs``, whose texts the index
        must have. Texts that hold more than 1/``hot_share`` of the indexed rows are at most
        ``hot_share`` rows and are joined by broadcast, so that none fills a bucket's
        task; the rest joins the index bucket by bucket."""
        keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest_of(text_col).alias("digest"))
        index = self.rows()
        total = self.stored().agg(F.sum("group_size")).first()[0] or 0
        is_hot = F.col("group_size") * hot_share > total
        hot = F.broadcast(index.where(is_hot))
        often = keyed.join(hot, "digest")
        seldom = keyed.join(hot.select("digest"), "digest", "left_anti").join(
            index.where(~is_hot).hint("merge"), "digest"
        )
        columns = ("doc_id", "digest", "keep_id", "group_size")
        return often.select(*columns).unionByName(seldom.select(*columns))


def exact_dedup(
    docs: DataFrame, index: DigestIndex | None = None, batches: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Add ``docs`` to the index, in so many batches by a hash of the id, and return every row's
    decision: doc_id, keep_id, group_size, kept, text_sha256. If no index is given, one is
    made for these rows and goes with the call."""
    own = index is None
    if own:
        n = docs.count()
        index = DigestIndex(docs.sparkSession, buckets=max(LEAST_BUCKETS, 1 << (n // BUCKET_ROWS).bit_length()))
    part = F.pmod(F.xxhash64(id_col), F.lit(batches))
    for i in range(batches):
        index.add(docs.where(part == i) if batches > 1 else docs, id_col=id_col, text_col=text_col)
    decided = index.lookup(docs, id_col, text_col).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    if own:
        decided = written(decided, "decisions")
        index.drop()
        remove_path(docs.sparkSession, index.path)
    return decided
