"""Agreement between repeated classifications of one observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the tiers
CONSISTENT, PARTIAL, INCONSISTENT = "CONSISTENTE", "PARCIAL", "INCONSISTENTE"
PERFECT, HIGH, MEDIUM, LOW = "PERFECTA", "ALTA", "MEDIA", "BAJA"


def _frequencies(attempts: DataFrame) -> DataFrame:
    """Attempts per (observation, code). The null code stands for the attempt itself and
    counts all attempts (``n``) and the readable ones (``readable``), so that totals and
    frequencies come out of one pass and one shuffle of pre-aggregated rows."""
    own = F.array(F.lit(None).cast("string"))
    codes = F.filter(F.array_distinct("codes"), lambda c: c.isNotNull())
    entries = F.when(F.col("codes").isNull(), own).otherwise(F.concat(own, codes))
    return (
        attempts.select("obs_id", F.col("codes").isNotNull().alias("__r"),
                        F.explode(entries).alias("code"))
        .groupBy("obs_id", "code")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("__r").alias("readable"))
    )


def _totals() -> list[Column]:
    own = F.col("code").isNull()
    return [
        F.max(F.when(own, F.col("n"))).alias("n_attempts"),
        F.max(F.when(own, F.col("readable"))).alias("n_readable"),
        F.array_sort(
            F.collect_list(F.when(~own, F.struct(F.col("code"), F.col("n").alias("freq"))))
        ).alias("freqs"),
    ]


def _per_observation(attempts: DataFrame) -> DataFrame:
    """One row per observation; the list has one entry per distinct code."""
    return _frequencies(attempts).groupBy("obs_id").agg(*_totals())


def attempt_similarity(attempts: DataFrame) -> DataFrame:
    """Codes of all readable attempts against codes of any, in percent, with a tier.
    ``attempts`` has ``obs_id``, ``attempt``, ``codes`` (null: unreadable)."""
    freqs = F.col("freqs")
    common = F.filter(freqs, lambda e: e["freq"] == F.col("n_readable"))
    share = F.size(common) / F.size(freqs) * 100
    similarity = (
        F.when(F.col("n_attempts") < 2, 100.0)
        .when(F.col("n_readable") == 0, 0.0)
        .when(F.size(freqs) == 0, 100.0)
        .otherwise(share)
    )
    s = F.col("similarity")
    tier = (
        F.when(s == 100, PERFECT).when(s >= 80, HIGH).when(s >= 50, MEDIUM).otherwise(LOW)
    )
    return (
        _per_observation(attempts)
        .withColumn("similarity", similarity)
        .select(
            "obs_id",
            "n_attempts",
            "n_readable",
            "similarity",
            tier.alias("tier"),
            F.transform(common, lambda e: e["code"]).alias("common_codes"),
            F.transform(freqs, lambda e: e["code"]).alias("all_codes"),
        )
    )


def attempt_codes(attempts: DataFrame) -> DataFrame:
    """Frequency of each code over all attempts of its observation, with a tier."""
    n, freq = F.col("n_attempts"), F.col("freq")
    tier = (
        F.when(freq == n, CONSISTENT).when(freq >= n * 0.5, PARTIAL).otherwise(INCONSISTENT)
    )
    return (
        _per_observation(attempts)
        .select("obs_id", "n_attempts", F.inline("freqs"))
        .select("obs_id", "code", "freq", (freq / n * 100).alias("pct"), tier.alias("tier"))
    )
