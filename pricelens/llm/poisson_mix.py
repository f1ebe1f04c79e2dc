"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Every source has a mean repetition rate: its target share of the output divided by its
share of the input. A document's number of copies is the inverse of the Poisson
distribution with that mean, taken at a uniform number hashed from (seed, doc_id, text):
the same document gets the same copies in every run and on every cluster, without any
coordination. Documents are exploded by their counts and the copies are shuffled globally
by a hashed key.

Scale: the only table that meets the documents is one row per source, with its cumulative
distribution; it is written once, so the documents are read twice, for the sources' sizes and
to be replicated. It is broadcast if it is checked to be small (``MAX_BROADCAST_SOURCES``);
beyond that the documents are salted before the join, so a source with a third of all rows
is spread over ``SALTS`` join keys. The global shuffle deals copies by a uniform hash and sorts
them by it inside each partition, so no source can make a hot partition.

Defined cases: a null source is a source of its own; a null doc_id or text hashes as the
empty string; repeated rows get equal counts, each replicated by itself; empty texts weigh
one character, so every document counts. Rates of 0 give no copies; if no source has a weight there is no output. Extra columns are
carried along; the columns ``copy`` and ``mix_key`` are added under the names given, and an input
column of such a name is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import free_name, written

MAX_BROADCAST_SOURCES = 20_000  # rows of about 1 KB each
SALTS = 64
HASH_DIGITS = 13  # 52 bits: every value is an exact double


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, joined by '|'."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("double") / F.lit(float(2 ** (4 * HASH_DIGITS)))


def source_rates(docs: DataFrame, temperature: float = 0.5, weights: dict[str, float] | None = None,
                 mean_rate: float = 1.0) -> DataFrame:
    """(source, n_docs, weight, rate): the mean repetition rate of every source.

    A source's target weight is ``weights[source]`` (0 if absent) or, without ``weights``,
    its characters to the power ``temperature``; rates are such that the expected output
    characters follow the weights and sum to ``mean_rate`` times the input's.
    """
    chars = F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1)).cast("long")
    stats = written(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(chars).alias("n_chars")), "sources")
    if weights is None:
        weight = F.pow(F.col("n_chars").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    stats = stats.withColumn("weight", weight)
    total = stats.agg(F.sum("weight").alias("weight"), F.sum("n_chars").alias("n_chars")).first()  # one row
    share = F.try_divide("weight", F.lit(float(total["weight"] or 0.0)))  # null if no source has a weight
    rate = F.round(F.lit(float(mean_rate)) * share * F.lit(total["n_chars"] or 0) / F.col("n_chars"), 6)
    return stats.select("source", "n_docs", share.alias("weight"), F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_cdf(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... as far as a 52-bit uniform number can reach.

    Terms are kept as logarithms, so a large rate does not underflow.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    log_rate = F.log(rate)
    start = F.struct(
        F.lit(0.0).alias("log_fact"), F.exp(-rate).alias("cum"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, j: Column) -> Column:
        log_fact = acc["log_fact"] + F.log(j.cast("double"))
        cum = acc["cum"] + F.exp(j * log_rate - rate - log_fact)
        return F.struct(log_fact.alias("log_fact"), cum.alias("cum"),
                        F.concat(acc["cdf"], F.array(cum)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), top), start, step, lambda acc: acc["cdf"])
    return F.when(rate > 0, cdf).otherwise(F.array(F.lit(1.0)))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 42, copy: str = "copy", key: str = "mix_key") -> DataFrame:
    """``docs`` with ``copy`` (1, 2, ...) and ``key``: every document as often as its count says."""
    docs = docs.drop(copy, key)
    text, source, cdf, salt, own_salt = (free_name(docs, x) for x in ("__text", "__source", "__cdf", "__salt", "__own_salt"))
    table = rates.select(F.col("source").alias(source), poisson_cdf(F.col("rate")).alias(cdf))
    left = docs.withColumn(text, F.md5(F.coalesce("text", F.lit(""))))
    same = F.col("source").eqNullSafe(F.col(source))
    if len(rates.select("source").take(MAX_BROADCAST_SOURCES + 1)) <= MAX_BROADCAST_SOURCES:
        joined = left.join(F.broadcast(table), same)
    else:
        salted = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = left.withColumn(own_salt, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        joined = left.join(salted, same & (F.col(own_salt) == F.col(salt)))
    u = uniform(F.lit(seed), F.lit("count"), F.col("doc_id"), F.col(text))
    count = F.size(F.filter(cdf, lambda c: c <= u))
    copies = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                               F.col(text), F.col(copy).cast("string")))
    return joined.withColumn(copy, F.explode(copies)).select(*docs.columns, copy, digest.alias(key))


def mix(docs: DataFrame, temperature: float = 0.5, weights: dict[str, float] | None = None,
        mean_rate: float = 1.0, seed: int = 42, copy: str = "copy", key: str = "mix_key") -> DataFrame:
    """The mixed corpus in a global random order: dealt to partitions by ``key``, sorted by it inside each."""
    rates = source_rates(docs, temperature, weights, mean_rate)
    return replicate(docs, rates, seed, copy, key).repartition(F.col(key)).sortWithinPartitions(key, "doc_id", copy)
