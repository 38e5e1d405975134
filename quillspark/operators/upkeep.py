"""Reports that are kept up instead of computed anew: listings by digest, frequencies by deltas, quality by sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.joins import diff_snapshots
from quillspark.sources.keyed import KeyedTable
from quillspark.sources.store import stage

#: Rows of a listing that a bucket holds on average, if the number of buckets is not given.
BUCKET_ROWS = 64


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("page_id"), F.lit(buckets)).cast("long")


def listing_digests(listing: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest): what a listing holds in each hash bucket, as a count and two sums of 64-bit hashes of its rows."""
    row = F.struct("page_id", "version_number", "last_modified_at")
    sums = [F.sum(F.xxhash64(row, F.lit(k)).cast("decimal(20,0)")).alias(f"s{k}") for k in (0, 1)]
    return listing.groupBy(_bucket(buckets).alias("bucket")).agg(F.struct(F.count("*").alias("n"), *sums).alias("digest"))


def diff_by_digest(previous: DataFrame, current: DataFrame, *, buckets: int | None = None, known: DataFrame | None = None) -> DataFrame:
    """The rows of ``joins.diff_snapshots``, by joining only buckets whose digests differ.

    Both listings (page_id, version_number, last_modified_at; page ids are not
    null) are digested in one grouped pass each, combined before the shuffle.
    Rows of equal buckets are unchanged and never shuffled; of the others both
    sides meet. So what is joined grows with the changes. ``known`` are the
    digests of ``previous`` as ``listing_digests`` gave them when it was
    written, for the same number of buckets: then it is read only where pages
    may have changed.
    """
    if buckets is None:
        buckets = max(1, current.count() // BUCKET_ROWS)
    was = listing_digests(previous, buckets) if known is None else known
    was, now = was.select("bucket", F.col("digest").alias("was")), listing_digests(current, buckets).select("bucket", F.col("digest").alias("now"))
    both = was.join(now, "bucket", "full_outer")
    touched = stage(both.where(~F.coalesce(F.col("was") == F.col("now"), F.lit(False))).select(F.col("bucket").alias("_bucket")), "touched")
    kept = lambda frame, how: frame.join(touched, _bucket(buckets) == F.col("_bucket"), how)
    same = kept(current, "left_anti").select("page_id", F.lit("unchanged").alias("change"))
    return same.unionByName(diff_snapshots(kept(previous, "left_semi"), kept(current, "left_semi")))


class Frequencies:
    """Document frequencies under upserts and deletions of texts, by signed deltas instead of a recount.

    Two keyed tables: the terms of each text (id, idx, tf), placed by id, and
    the frequencies (idx, df). A batch reads the terms that its texts had, adds
    up what it takes away and what it brings per index, and rewrites only the
    buckets of those texts and indices.

    Batches are numbered upwards. An index remembers the last batch that
    changed it, and the terms are written after all frequencies, so a batch
    that broke off or is delivered again changes nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str, *, id_type: str = "long", buckets: int = 64):
        self.terms = KeyedTable(spark, f"{path}/terms", f"id {id_type}, idx int, tf long", ["id", "idx"], by=["id"], buckets=buckets)
        self.counts = KeyedTable(spark, f"{path}/counts", "idx int, df long, batch long", ["idx"], buckets=buckets)

    def apply(self, batch: int, terms: DataFrame, gone: DataFrame | None = None) -> None:
        """Put texts with these ``terms`` (id, idx, tf; one row each) in the place of their earlier ones; remove ``gone`` (id).

        A text without terms is given by ``gone``. An id in both is replaced.
        """
        fresh = stage(terms.select(*(F.col(x.name).cast(x.dataType) for x in self.terms.schema)), "fresh")
        ids = fresh.select("id") if gone is None else fresh.select("id").unionByName(gone.select(F.col("id").cast(self.terms.schema["id"].dataType)))
        ids = stage(ids.distinct(), "ids")
        before = self.terms.near(ids).join(ids, "id", "left_semi")
        one = lambda frame, sign: frame.select("idx", F.lit(sign).alias("delta"))
        deltas = one(fresh, 1).unionByName(one(before, -1)).groupBy("idx").agg(F.sum("delta").alias("delta")).where("delta <> 0")
        deltas = stage(deltas, "deltas")
        held = self.counts.near(deltas).select(F.col("idx").alias("_idx"), F.col("df").alias("_df"), F.col("batch").alias("_batch"))
        todo = deltas.join(held, F.col("idx") == F.col("_idx"), "left").where(F.coalesce(F.col("_batch") < batch, F.lit(True)))
        self.counts.upsert(todo.select("idx", (F.coalesce("_df", F.lit(0)) + F.col("delta")).alias("df"), F.lit(batch).cast("long").alias("batch")), distinct=True)
        self.terms.replace(ids, fresh)

    def read(self) -> DataFrame:
        """(idx, df) of the indices that some text holds."""
        return self.counts.read().where("df > 0").select("idx", "df")

    def total(self) -> int:
        """Texts that have a term."""
        return self.terms.read().select("id").distinct().count()


def quality_sketch(chunks: DataFrame, *, day: str = "day", k: int = 400) -> DataFrame:
    """Parts of the chunker's quality report by document type and day, which add up: counts, and a KLL sketch of token counts.

    A sketch holds some hundreds of numbers, however many chunks there are;
    ``k`` sets its rank error (``rank_error``). Chunks are read once, and
    combined before the shuffle.
    """
    missing = F.col("page_id").isNull() | (F.coalesce("section_header", F.lit("")) == "") | (F.coalesce("space_key", F.lit("")) == "")
    count = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    return chunks.groupBy("doc_type", day).agg(
        F.count("*").alias("chunks"), count(F.col("token_count").between(200, 800)).alias("in_range"), count(missing).alias("missing"),
        count(F.col("section_header") != "untitled").alias("headed"), F.kll_sketch_agg_bigint(F.col("token_count").cast("long"), F.lit(k)).alias("tokens"),
    )


def rank_error(k: int = 400) -> float:
    """Share of ranks by which a quantile of a sketch may be off (99 % of all cases; the published fit for this kind of sketch)."""
    return 2.446 / k**0.9433


def quality_from_sketches(parts: DataFrame, *keys: str) -> DataFrame:
    """The report over any days: parts of one or several runs merge without reading a chunk again.

    ``keys`` default to the document type. ``median_tokens`` is within
    ``rank_error`` of the median's rank.
    """
    share = lambda name: (F.sum(name) / F.sum("chunks")).alias(name)
    merged = F.kll_merge_agg_bigint("tokens")
    return parts.groupBy(*(keys or ("doc_type",))).agg(
        F.sum("chunks").alias("chunks"), share("in_range"), share("missing").alias("missing_metadata"), share("headed").alias("with_header"),
        F.kll_sketch_get_quantile_bigint(merged, F.lit(0.5)).alias("median_tokens"),
    )
