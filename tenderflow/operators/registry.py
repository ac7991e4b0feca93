"""Notice registry: selections, status reset, best mapping package (R1-R9, P7, J10), run plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import semver
from ..vocab import TIER_LAG_DAYS

# ---- fixed values: status presets of the backlog selections ------------------
BACKLOG = {
    "unnormalised": ["RAW", "INDEXED"],
    "untransformed": ["NORMALISED_METADATA", "ELIGIBLE_FOR_TRANSFORMATION"],
    "unvalidated": ["DISTILLED"],
    "unpackaged": ["VALIDATED", "INELIGIBLE_FOR_PACKAGING", "ELIGIBLE_FOR_PACKAGING", "INELIGIBLE_FOR_PUBLISHING"],
    "unpublished": ["ELIGIBLE_FOR_PUBLISHING", "INELIGIBLE_FOR_PUBLISHING", "PACKAGED"],
}
DASHBOARD_STATUSES = ["DISTILLED", "VALIDATED", "PACKAGED", "PUBLISHED", "ELIGIBLE_FOR_PUBLISHING",
                      "ELIGIBLE_FOR_PACKAGING", "INELIGIBLE_FOR_PACKAGING", "INELIGIBLE_FOR_PUBLISHING"]
# Status of a registry row derived from the driver's event type.
EVENT_STATUS = {"signup": "RAW", "view": "NORMALISED_METADATA", "click": "DISTILLED", "purchase": "VALIDATED",
                "error": "PACKAGED"}


def registry_from_events(events: DataFrame) -> DataFrame:
    """Notice registry (notice_id, status, form_number, xsd_version, publication_date) from ``events``."""
    status = None
    for k, v in EVENT_STATUS.items():
        status = F.when(F.col("event_type") == k, v) if status is None else status.when(F.col("event_type") == k, v)
    return events.select(F.col("event_id").alias("notice_id"), status.alias("status"),
                         F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("form_number"),
                         F.when(F.col("value") < 100, "R2.0.8").otherwise("R2.0.9").alias("xsd_version"),
                         F.to_date("ts").alias("publication_date"))


def select_notices(reg: DataFrame, statuses: list[str] | None = None, form: str | None = None,
                   start: str | None = None, end: str | None = None, version: str | None = None) -> DataFrame:
    """R1/P7 -- ids by status IN, form =, publication date between (inclusive), schema version =."""
    cond = F.lit(True)
    if statuses:
        cond = cond & F.col("status").isin(statuses)
    if form is not None:
        cond = cond & (F.col("form_number") == form)
    if start is not None and end is not None:
        cond = cond & F.col("publication_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if version is not None:
        cond = cond & (F.col("xsd_version") == version)
    return reg.where(cond).select("notice_id")


def backlog(reg: DataFrame, name: str) -> DataFrame:
    """R3-R7 -- preset selections."""
    return select_notices(reg, BACKLOG[name])


def dashboard_selection(reg: DataFrame, start: str | None = None, end: str | None = None,
                        run_date: dt.date | None = None) -> DataFrame:
    """R8 -- dashboard statuses on a date window; default: the day before the run date."""
    if start is None:
        day = (run_date or dt.date.today()) - dt.timedelta(days=1)
        start = end = day.isoformat()
    return select_notices(reg, DASHBOARD_STATUSES, start=start, end=end)


def reset_status(reg: DataFrame, selected: DataFrame, source: str, target: str) -> DataFrame:
    """R2 -- move the selected ids from ``source`` to ``target`` status (a left join flag, no loop)."""
    sel = selected.select("notice_id").distinct().withColumn("_sel", F.lit(True))
    j = reg.join(sel, "notice_id", "left")
    return j.withColumn("status", F.when(F.col("_sel") & (F.col("status") == source), F.lit(target))
                        .otherwise(F.col("status"))).drop("_sel")


def best_version(notices: DataFrame, packages: DataFrame) -> DataFrame:
    """R9/J10 -- per notice the highest-version eligible package (equi part on form, theta on
    schema version and date); first-listed wins ties. Packages are joined on the form number, so a
    notice meets only its form's packages (no cross product)."""
    p = packages.withColumn("_v", semver("version"))
    j = notices.join(p, "form_number", "inner").where(
        (F.col("xsd_version") >= F.col("min_xsd")) & (F.col("xsd_version") <= F.col("max_xsd"))
        & F.col("publication_date").between(F.col("start_date"), F.col("end_date")))
    return j.groupBy("notice_id").agg(
        F.max_by("package_id", F.struct("_v", (-F.col("position")).alias("_p"))).alias("package_id"),
        F.lit(True).alias("eligible"))


def packages_from_registry(reg: DataFrame) -> DataFrame:
    """Mapping packages per form seen in the registry: three versions with different validity."""
    forms = reg.groupBy("form_number").agg(F.min("publication_date").alias("lo"), F.max("publication_date")
                                           .alias("hi"))
    v = F.explode(F.array(
        F.struct(F.lit(0).alias("position"), F.lit("1.0.0").alias("version"), F.lit("R2.0.8").alias("min_xsd"),
                 F.lit("R2.0.9").alias("max_xsd"), F.lit(0).alias("d0"), F.lit(30).alias("d1")),
        F.struct(F.lit(1).alias("position"), F.lit("1.2.0").alias("version"), F.lit("R2.0.9").alias("min_xsd"),
                 F.lit("R2.0.9").alias("max_xsd"), F.lit(0).alias("d0"), F.lit(14).alias("d1")),
        F.struct(F.lit(2).alias("position"), F.lit("1.10.0-rc1").alias("version"), F.lit("R2.0.8").alias("min_xsd"),
                 F.lit("R2.0.8").alias("max_xsd"), F.lit(10).alias("d0"), F.lit(30).alias("d1"))))
    return forms.select("form_number", "lo", v.alias("p")).select(
        F.concat("form_number", F.lit("-"), "p.version").alias("package_id"), "form_number", "p.position",
        "p.version", "p.min_xsd", "p.max_xsd", F.date_add("lo", F.col("p.d0")).alias("start_date"),
        F.date_add("lo", F.col("p.d1")).alias("end_date"))


def plan(spark: SparkSession, run_date: dt.date, tables: list[str]) -> DataFrame:
    """I2 -- per-target date windows for one run: the day before ``run_date`` for the tables, and for the tiers
    their lag before that day (the same meaning of the day as ``lots.publication_day``)."""
    day = run_date - dt.timedelta(days=1)
    rows = [(f"tier_{t}", day - dt.timedelta(days=lag), day - dt.timedelta(days=lag)) for t, lag in TIER_LAG_DAYS.items()]
    rows += [(t, day, day) for t in tables]
    return spark.createDataFrame(rows, "target string, start date, end date")


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """I1 -- every day of a range as one frame: one job over the range instead of a loop of runs."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))


DAY = "extract_day"


def run_days(df: DataFrame, day: str, start: dt.date, end: dt.date, path: str) -> DataFrame:
    """I1 -- the extracts of all days from ``start`` to ``end`` in one job; returns (day, rows), 0 for a day without any.

    Rows whose ``day`` column (date or timestamp, compared as it is, so that the scan prunes) lies in the range are written under one folder a day. Every day of the range gets its folder,
    held by a row that only marks it, so that days run again are replaced (dynamic partition overwrite) even where their
    rows have gone, and other days stay. ``read_days`` gives the rows without the marks.
    """
    spark = df.sparkSession
    within = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end + dt.timedelta(days=1)))
    rows = df.where(within).select(F.to_date(day).alias(DAY), F.struct(*df.columns).alias("row"))
    marks = days(spark, start, end).select(F.col("day").alias(DAY)) if start <= end else rows.select(DAY).limit(0)
    rows.unionByName(marks, allowMissingColumns=True).hint("rebalance", DAY) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    written = spark.read.schema(rows.select("row", DAY).schema).parquet(path).where(F.col(DAY).between(F.lit(start), F.lit(end)))
    return written.groupBy(F.col(DAY).alias("day")).agg(F.count("row").alias("rows"))


def read_days(spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The rows stored by ``run_days``; a window reads its folders only."""
    stored = spark.read.parquet(path).where(F.col("row").isNotNull())
    if start is not None:
        stored = stored.where(F.col(DAY) >= F.lit(start))
    if end is not None:
        stored = stored.where(F.col(DAY) <= F.lit(end))
    return stored.select("row.*")
