"""Currency conversion (J6, J7, F21-F24) as joins with a rate dimension.

``rates(currency, day, rate)`` holds units per EUR; EUR itself is 1.0. The
rate table has one row per currency and rate day, so it is bounded by
currencies x days; whether it is broadcast is left to Spark, which sees its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_eur(rates: DataFrame) -> DataFrame:
    return rates.select("currency", "day", F.col("rate").cast("double").alias("rate"))


def rate_bounds(rates: DataFrame) -> DataFrame:
    """S14/F23 -- first and last rate day per currency."""
    return rates.groupBy("currency").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def latest_rates(rates: DataFrame) -> DataFrame:
    """J7 -- the rate on the last available day per currency (max_by, no window sort).

    Codes are three capital letters (others name no currency), so there are at most 26^3 rows.
    """
    return rates.where(F.col("currency").rlike("^[A-Z]{3}$")).groupBy("currency").agg(F.max_by("rate", "day").alias("rate"), F.max("day").alias("day"))


def convert(df: DataFrame, amount: str, currency: str, rates: DataFrame, out: str, to: str = "EUR",
            day: str | None = None, day_out: str | None = None) -> DataFrame:
    """F21/J6/J7 -- ``amount / rate(from) * rate(to)``.

    With ``day`` the rate of that exact day is used (a day without a rate, or
    an unknown currency, gives 0.0); without it the last available rate is
    used (F22; ``day_out`` then receives the rate day). The same currency
    passes through unchanged (a null amount then becomes 0.0, as the integer
    cast downstream needs).
    """
    r = _with_eur(rates)
    by_day = [] if day is None else ["_fd"]
    if day is None:
        r = latest_rates(r)
    table = r.select(F.col("currency").alias("_fc"), F.col("rate").alias("_fr"), F.col("day").alias("_fd"))
    if to == "EUR":  # rates are per euro: nothing to look up on that side
        table = table.withColumn("_tr", F.lit(1.0)).withColumn("_td", F.col("_fd"))
    else:  # the target's rate beside every source rate (of the same day): a join of small tables
        target = r.where(F.col("currency") == to).select(F.lit(to).alias("_tc"), F.col("rate").alias("_tr"),
                                                         F.col("day").alias("_td"))
        on = [F.col("_to") == F.col("_tc")] + ([F.col("_fd") == F.col("_td")] if by_day else [])
        from_eur = target.select(F.lit("EUR").alias("_fc"), F.lit(1.0).alias("_fr"), F.col("_td").alias("_fd"), "_tr", "_td")
        table = table.where(F.col("_fc") != "EUR").withColumn("_to", F.lit(to)).join(target, on, "left") \
            .drop("_to", "_tc").unionByName(from_eur)
    keys = [F.col(currency) == F.col("_fc")] + ([F.to_date(F.col(day)) == F.col("_fd")] if by_day else [])
    if day is None:
        table = F.broadcast(table)  # 26^3 rows at most; a shuffle by currency would put a hot one into one task
    j = df.join(table, keys, "left")
    rate_from = F.when(F.col(currency) == "EUR", F.lit(1.0)).otherwise(F.col("_fr"))
    rate_to = F.lit(1.0) if to == "EUR" else F.col("_tr")
    amt = F.col(amount).cast("double")
    value = (F.when(F.col(currency) == F.lit(to), F.coalesce(amt, F.lit(0.0)))
             .otherwise(F.coalesce(amt / rate_from * rate_to, F.lit(0.0))))
    j = j.withColumn(out, value)
    if day is None and day_out is not None:
        j = j.withColumn(day_out, F.col("_fd"))
    return j.drop("_fc", "_fd", "_fr", "_td", "_tr")
