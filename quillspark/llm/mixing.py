"""Operator 10: mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import lookup, stash, unused

#: Largest mean of one draw; a larger rate is the sum of several draws.
PIECE = 16.0
#: Terms of a draw's distribution: P(N >= 96) at mean 16 is below 1e-40.
TERMS = 96


def draw(*parts: Column) -> Column:
    """A number in (0, 1) that the parts decide (52 bits of their MD5)."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**13))


def source_rates(
    docs: DataFrame,
    *,
    source_col: str = "source",
    size: Column | None = None,
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    budget: float | None = None,
    bare: float = 0.0,
) -> DataFrame:
    """Mean copies per document of each source, so that sources meet their target shares.

    A source's size is the sum of ``size`` over all its documents (their
    number by default). Its target share is its entry in ``weights`` (sources
    without one get 0) or, without weights, its size to the power
    ``temperature``; shares are scaled to sum 1. The mixture's expected size is
    ``budget`` (the corpus's own size by default), so
    ``rate = share * budget / size``. Returns ``source, size, share, rate``,
    one row per source, a null source being one of its own. Sizes of 0 give
    rate ``bare``: 0, or 1 to keep documents of a source that holds no text.
    """
    measure = F.lit(1) if size is None else size
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(measure).cast("double").alias("size"))
    sizes = sizes.withColumn("size", F.coalesce("size", F.lit(0.0)))
    if weights is None:
        want = F.when(F.col("size") > 0, F.pow("size", F.lit(float(temperature)))).otherwise(0.0)
    else:
        if any(w < 0 for w in weights.values()) or not sum(weights.values()):
            raise ValueError("weights must not be negative and must not all be 0")
        entries = [x for name, w in weights.items() for x in (F.lit(name), F.lit(float(w)))]
        want = F.coalesce(F.element_at(F.create_map(*entries), F.coalesce("source", F.lit("\0"))), F.lit(0.0))
    sizes = stash(sizes.withColumn("want", want), "sizes")
    all_want, all_size = sizes.agg(F.sum("want"), F.sum("size")).first()
    share = F.col("want") / F.lit(all_want) if all_want else F.lit(0.0)
    whole = F.lit(float(all_size or 0) if budget is None else float(budget))
    rate = F.when(F.col("size") > 0, F.col("share") * whole / F.col("size")).otherwise(float(bare))
    return sizes.withColumn("share", share).withColumn("rate", rate).select("source", "size", "share", "rate")


def _steps(rate: Column) -> tuple[Column, Column]:
    """How many draws make a rate up, and the distribution function of one draw."""
    pieces = F.greatest(F.lit(1), F.ceil(rate / F.lit(PIECE))).cast("int")
    mean = rate / pieces
    log_factorials = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(TERMS)])
    mass = F.transform(
        log_factorials,
        lambda lf, k: F.when(mean > 0, F.exp(k * F.log(mean) - mean - lf)).otherwise(F.when(k == 0, 1.0).otherwise(0.0)),
    )
    running = F.aggregate(
        mass,
        F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("steps")),
        lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["steps"], F.array(acc["sum"] + x)).alias("steps")
        ),
    )
    return pieces, running["steps"]


def replicate(
    docs: DataFrame,
    rates: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 17,
    copy_col: str = "copy",
    order_col: str = "shuffle_key",
) -> DataFrame:
    """Repeat each document by a Poisson draw with its source's rate, in global random order.

    The count is the inverse of the Poisson distribution function at a number
    drawn from a hash of seed and id: a rerun, a lost executor or another
    partitioning gives the same copies, and equal ids get equal counts. All
    columns are kept; ``copy`` numbers a document's copies from 0 and
    ``shuffle_key`` (a hash of seed, id and copy) is the order in which the
    rows are sorted over all partitions; as such keys are uniform, partitions
    take equal ranges of them, and no sample is drawn. Sources without a rate
    give no copy.

    Defined cases: a null id draws as the empty id; repeated rows are repeated
    alike; null sources are one source; columns of the input named like an
    output column are replaced; an empty table gives an empty result.
    """
    kept = docs.drop(copy_col, order_col)
    source, pieces, steps, number, part = unused(kept, "_source", "_pieces", "_steps", "_count", "_part")
    of_rate = _steps(F.col("rate"))
    named = lambda column: F.coalesce(F.col(column).cast("string"), F.lit("\0")).alias(source)
    steps_of = rates.select(named("source"), of_rate[0].alias(pieces), of_rate[1].alias(steps))
    drawn = lookup(kept.select("*", named(source_col)), stash(steps_of, "rates"), [source]).where(F.col(pieces).isNotNull())
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))

    def once(piece: Column) -> Column:
        u = draw(F.lit(str(seed)), ident, piece.cast("string"))
        return F.size(F.filter(steps, lambda step: step <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col(pieces)), F.lit(0), lambda acc, piece: acc + once(piece))
    copies = drawn.withColumn(number, count).where(F.col(number) > 0)
    copies = copies.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.col(number) - 1)))
    mixed = F.md5(F.concat_ws("|", F.lit(f"order{seed}"), ident, F.col(copy_col).cast("string")).cast("binary"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.conv(F.substring(order_col, 1, 8), 16, 10).cast("long") * parts / F.lit(2.0**32)).cast("int")
    dealt = copies.withColumn(order_col, mixed).withColumn(part, place).repartitionById(parts, F.col(part))
    return dealt.sortWithinPartitions(order_col).select(*kept.columns, copy_col, order_col)


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 17,
    copy_col: str = "copy",
    order_col: str = "shuffle_key",
    **targets,
) -> DataFrame:
    """``source_rates`` over all documents, then ``replicate``."""
    rates = source_rates(docs, source_col=source_col, **targets)
    return replicate(docs, rates, id_col=id_col, source_col=source_col, seed=seed, copy_col=copy_col, order_col=order_col)
