"""Statistics that Spark has in another form: adjusted moments and a guarded geometric mean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def adjusted_skewness(c: str) -> Column:
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(c: str) -> Column:
    n = F.count(c)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def geometric_mean(c: str) -> Column:
    """0 with a zero among the values, NULL with a negative one."""
    return (F.when(F.min(c) > 0, F.exp(F.avg(F.when(F.col(c) > 0, F.ln(F.when(F.col(c) > 0, F.col(c)))))))
            .when(F.min(c) == 0, F.lit(0.0)))


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def row_statistics(df: DataFrame, values: list[str], suffix: str, stats: list[str]) -> DataFrame:
    """Append ``{stat}_{suffix}`` over the given columns of each row (sample forms, adjusted moments).

    Plain arithmetic on columns, in two projections so that the mean is computed once; unlike
    lambdas over arrays, this is compiled.
    """
    n = len(values)
    mean, m2, m3, m4 = (f"__{m}_{suffix}" for m in ("mean", "m2", "m3", "m4"))
    centred = df.withColumn(mean, _sum([F.col(c) for c in values]) / n)
    gaps = [F.col(c) - F.col(mean) for c in values]
    powers = centred.select("*", _sum([g * g for g in gaps]).alias(m2), _sum([g * g * g for g in gaps]).alias(m3),
                            _sum([g * g * g * g for g in gaps]).alias(m4))
    ordered = F.sort_array(F.array(*values))
    lowest = F.least(*values) if n > 1 else F.col(values[0])
    flat, width = F.col(m2) == 0, F.when(F.col(m2) != 0, F.col(m2))
    nothing = F.lit(None).cast("double")
    variance = F.col(m2) / (n - 1) if n > 1 else nothing
    skew = F.when(flat, 0.0).otherwise(
        n * (n - 1) ** 0.5 / (n - 2) * F.col(m3) / (width * F.sqrt(width))) if n > 2 else nothing
    kurtosis = F.when(flat, 0.0).otherwise(
        n * (n + 1) * (n - 1) / ((n - 2) * (n - 3)) * F.col(m4) / (width * width)
        - 3 * (n - 1) ** 2 / ((n - 2) * (n - 3))) if n > 3 else nothing
    table = {
        "mean": F.col(mean), "median": (F.get(ordered, (n - 1) // 2) + F.get(ordered, n // 2)) / 2,
        "std": F.sqrt(variance), "variance": variance, "kurtosis": kurtosis, "skew": skew,
        "gmean": F.when(lowest > 0, F.exp(_sum([F.ln(F.when(F.col(c) > 0, F.col(c))) for c in values]) / n))
                  .when(lowest == 0, 0.0)}
    return powers.select("*", *[table[s].alias(f"{s}_{suffix}") for s in stats]).drop(mean, m2, m3, m4)
