"""Mixing sources to target weights by Poisson replication.

Every source has a rate, the mean number of times its documents are to be seen. Each
document draws its number of copies by inverting the Poisson distribution at a uniform
number hashed from its id, so a rerun or a retried task draws the same. Copies then go to
places in hash order over all partitions, which is the global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm.common import stored, table

SEED = 17
TEMPERATURE = 0.5  # target share of a source: its size to this power
DRAW_MEAN = 16.0  # rates above are drawn as several independent parts
MOST = 96  # P(X >= 96) at mean 16 is below 2 ** -52, the step of the uniform numbers


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the given values."""
    digits = F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null"))
                                                  for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def target_rates(docs: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate) that keep the corpus's size in characters while each source's share
    becomes proportional to its size to the power ``temperature``. A null source is a
    source; one without characters keeps rate 1."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)))
                                       .alias("size"))
    total = sizes.agg(F.sum("size").alias("all"),
                      F.sum(F.pow("size", F.lit(temperature))).alias("parts"))
    share = F.pow("size", F.lit(temperature)) / F.col("parts")
    return sizes.join(F.broadcast(total)).select(  # one row
        "source", F.when(F.col("size") > 0, share * F.col("all") / F.col("size"))
        .otherwise(1.0).alias("rate"))


def copies(key: Column, rate: str = "rate", seed: int = SEED) -> Column:
    """Poisson(rate) number by inversion: the count of cumulative probabilities at or
    below a uniform number, added over the parts of a large rate. Expects a column
    ``cumulative`` for one part (see :func:`with_tables`)."""
    parts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col(rate) / DRAW_MEAN).cast("int")))
    draw = F.transform(parts, lambda j: uniform(F.lit(seed), key, j))
    return F.aggregate(draw, F.lit(0), lambda acc, u: acc + F.size(
        F.filter("cumulative", lambda c: c <= u)))


def with_tables(rates: DataFrame) -> DataFrame:
    """Adds ``cumulative``: P(X <= k), k = 0..MOST-1, for one part of the rate."""
    mean = F.col("rate") / F.greatest(F.lit(1.0), F.ceil(F.col("rate") / DRAW_MEAN))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("all"))

    def add(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["all"], F.array(
            F.element_at(acc["all"], -1) + p)).alias("all"))

    steps = F.transform(F.sequence(F.lit(1), F.lit(MOST - 1)), lambda k: k.cast("double"))
    return rates.withColumn("cumulative", F.aggregate(steps, start, add, lambda acc: acc["all"]))


def mix(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents, each row as often as drawn, in shuffled order.

    Adds ``copy`` (from 0), ``n_copies``, ``rate`` and ``order_key``. A source missing in
    ``rates`` has rate 1; rate 0 drops a source. Rows that repeat an id draw alike. The
    rates are a stored table, so whether they are broadcast is Spark's size check; a
    large source is split by adaptive execution where they are not.
    """
    held = stored(with_tables(rates.select("source", "rate")), "rates").select(
        F.col("source").alias("_source"), "rate", "cumulative")
    key = F.col("doc_id")
    drawn = (docs.join(held, docs.source.eqNullSafe(held["_source"]), "left").drop("_source")
             .withColumn("n_copies", F.when(F.col("rate").isNull(), 1)
                         .otherwise(copies(key, seed=seed)).cast("long"))
             .drop("cumulative").withColumn("rate", F.coalesce("rate", F.lit(1.0)))
             .where("n_copies > 0"))
    copied = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.col("n_copies") - 1)))
    order = F.md5(F.concat_ws(":", F.lit("order"), F.lit(str(seed)), F.coalesce(
        key.cast("string"), F.lit("null")), F.col("copy").cast("string")))
    return (copied.withColumn("order_key", order).repartition("order_key")
            .sortWithinPartitions("order_key"))


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated to square-root source shares and shuffled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mix(docs, target_rates(docs)).withColumn("rate", F.round("rate", 6))


SQL = f"""
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size
               FROM documents GROUP BY 1),
rates AS (SELECT source, CASE WHEN size > 0 THEN sqrt(size) / sum(sqrt(size)) OVER ()
                              * sum(size) OVER () / size ELSE 1.0 END AS rate FROM sizes),
split AS (SELECT *, greatest(1, ceil(rate / {DRAW_MEAN}))::BIGINT AS parts FROM rates),
tables AS (SELECT source, k, exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1) AS p
           FROM split, range(0, {MOST}) t(k)),
cumulative AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM tables),
draws AS (
  SELECT d.doc_id, d.source, d.lang, d.text, s.rate,
         ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || j), 1, 13)
         )::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source, range(1, parts + 1) r(j)),
counted AS (
  SELECT x.doc_id, x.source, x.lang, x.text, x.rate, sum((
    SELECT count(*) FROM cumulative c
    WHERE c.source IS NOT DISTINCT FROM x.source AND c.c <= x.u))::BIGINT AS n_copies
  FROM draws x GROUP BY ALL)
SELECT doc_id, source, lang, text, round(rate, 6) AS rate, n_copies, copy,
       md5('order:{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS order_key
FROM counted, range(0, n_copies) r(copy)
"""
