"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the output over its share of the rows. Every row draws its number of
copies by inverting the Poisson distribution of that mean at a number in [0, 1) made from a hash of the seed, the id and
the text, is exploded by it, and all copies are put in the order of a second hash.

Rates over 32 are drawn as a sum of equal parts of 32 at most, so no power of e underflows and no count is capped. A null
source is a source of its own. Null ids and null texts hash as empty. Equal rows draw equal numbers and each row is
replicated for itself. Very long texts are hashed whole. Without rows there is no result. The rates, a row for each source,
are written first and broadcast if they are at most SOURCES; the join with more is a plain one, in which Spark splits a hot
source. Input columns stay inside the column row, so their names can't clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored, wrapped

SEED, ALPHA, PART = "mix-1", 0.5, 32.0
#: Terms of the distribution that are summed for a part; beyond, its tail is below 1e-16.
TERMS = 120
#: Shuffle keys are below this; rates of up to so many sources are broadcast.
KEYS, SOURCES = 16**15, 100_000


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def target_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA) -> DataFrame:
    """source, n, rate. Without weights a source's target is its row count to the power alpha."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("source")), F.lit(0.0))
    counts = counts.withColumn("w", weight)
    total = counts.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))  # one row
    rate = F.when(F.col("all_w") > 0, F.col("w") / F.col("all_w") * F.col("all_n") / F.col("n")).otherwise(0.0)
    return counts.join(F.broadcast(total)).select("source", "n", rate.alias("rate"))


def poisson(rate: Column, *key: Column) -> Column:
    """The Poisson count of mean rate at the key's hash."""
    parts = F.greatest(F.ceil(rate / PART), F.lit(1))

    def drawn(i: Column) -> Column:
        return let(F.struct((rate / parts).alias("mean"), _unit(*key, i.cast("string")).alias("u")), lambda x: inverted(x["mean"], x["u"]))

    def inverted(mean: Column, u: Column) -> Column:
        step = lambda a, k: F.struct((a["p"] * mean / k).alias("p"), (a["c"] + a["p"] * mean / k).alias("c"), (a["n"] + (u >= a["c"]).cast("int")).alias("n"))
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda a: a["n"])

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts.cast("int")), drawn), F.lit(0), lambda a, n: a + n)


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, seed: str = SEED) -> DataFrame:
    """row (the whole input row), copy (from 1) and shuffle_key, in no order yet."""
    key = (F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5("text"), F.lit("")))
    rates = stored(target_rates(docs, weights, alpha).select(F.col("source").alias("rate_source"), "rate"), "mix-rates")
    if rates.limit(SOURCES + 1).count() <= SOURCES:
        rates = F.broadcast(rates)
    rows = wrapped(docs, "doc_id", "text", "source").join(rates, F.col("source").eqNullSafe(F.col("rate_source")))
    copies = rows.withColumn("n", poisson(F.col("rate"), *key)).where("n > 0").select("row", "doc_id", "text", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return copies.select("row", "copy", F.conv(F.substring(F.md5(F.concat_ws(":", *key, F.lit("order"), F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long").alias("shuffle_key"))


def shuffled(copies: DataFrame) -> DataFrame:
    """Globally in the order of the hash: equal ranges of the key, which is evenly spread, sorted inside. As the ranges are
    known, the copies are made and moved once."""
    parts = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.least(F.floor(F.col("shuffle_key") / F.lit(float(KEYS)) * parts).cast("int"), F.lit(parts - 1))
    return copies.repartitionById(parts, part).sortWithinPartitions("shuffle_key", "copy")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, seed: str = SEED) -> DataFrame:
    """The replicated rows with their own columns, globally shuffled."""
    return shuffled(replicate(docs, weights, alpha, seed)).select("row.*")


MIX_SQL = """
WITH counts AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5) AS w FROM {docs} GROUP BY source),
rates AS (SELECT source, w / sum(w) OVER () * sum(n) OVER () / n AS rate FROM counts),
keyed AS (SELECT d.doc_id, d.source, r.rate, greatest(ceil(r.rate / 32.0), 1)::BIGINT AS parts,
    'mix-1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || coalesce(md5(d.text), '') AS k
  FROM {docs} d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
means AS (SELECT DISTINCT rate, parts, rate / parts AS mean FROM keyed),
terms AS (SELECT rate, j, exp(-mean) * coalesce(list_product(list_transform(range(1, j + 1), lambda i: mean / i)), 1.0) AS p
  FROM means, (SELECT unnest(range(0, 120)) AS j)),
sums AS (SELECT rate, j, sum(p) OVER (PARTITION BY rate ORDER BY j ROWS UNBOUNDED PRECEDING) AS c FROM terms),
cdf AS (SELECT rate, array_agg(c ORDER BY j) AS c FROM sums GROUP BY rate),
drawn AS (SELECT doc_id, source, k, list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(cdf.c,
    lambda x: ('0x' || substr(md5(k || ':' || i), 1, 13))::BIGINT / 4503599627370496.0 >= x)))) AS n
  FROM keyed JOIN cdf USING (rate)),
copies AS (SELECT doc_id, source, k, unnest(range(1, n::BIGINT + 1)) AS copy FROM drawn)
SELECT doc_id, source, copy::INTEGER AS copy, ('0x' || substr(md5(k || ':order:' || copy), 1, 15))::BIGINT AS shuffle_key FROM copies
"""
