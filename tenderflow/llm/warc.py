"""Operator 3: resolution of not-modified revisit records.

A server-not-modified revisit (status 304) has no body: it stands for the latest earlier full response
of the same canonical URL. ``resolve`` finds that response by an as-of join, checks the validators and
merges the headers that a 304 may update into the stored ones.

**As-of join without hot groups.** Responses and revisits are dealt into ranges of (canonical URL,
time): a URL with a third of all captures is cut wherever a range ends. Inside a range the latest
response runs forward in a window; where a URL goes on from an earlier range, the last response of
those ranges is carried over, in a table of at most a few rows per range. Revisits at the very time
of a response do not count it as earlier; of responses at the same time the largest record_id counts.
Only record ids, times, validators and headers move, never bodies: ``with_body`` joins them on demand.

**Validators.** Entity tags compare weakly (W/ and quotes aside). Without a tag on both sides,
Last-Modified must be equal. Status of a revisit: ``resolved``, ``unchecked`` (no validator on both sides),
``mismatch`` (validators differ: the stored response is not the one meant, nothing is merged) or
``no_response`` (no earlier full response).

**Headers.** Names are compared without case. A 304 updates every stored field but those that
describe the stored body or the connection (``KEPT``).

Defined results: one row per revisit, also for repeated rows; a null URL or time has no earlier
response; null headers are empty; of header names that differ only in case the last counts. Records
that are neither full (2xx) nor revisits are ignored. Empty tables give an empty result. Other input
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: fields that a 304 does not update (HTTP caching rules) ------------------
KEPT = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
        "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding",
        "upgrade")
#: query parameters that do not name a resource
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"


def canonical_url(url: Column) -> Column:
    """Scheme, user info, www., default port, fragment, tracking parameters and closing slash go; host in lower
    case; parameters sorted."""
    rest = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    params = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    params = F.array_sort(F.filter(params, lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.concat(host, path, query)


def _fields(headers: Column) -> Column:
    """Header map with lower-case names; of names that differ only in case the last entry counts."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    low = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(low, lambda e, i: ~F.exists(F.slice(low, i + 2, F.size(low)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def merged(stored: Column, update: Column) -> Column:
    """Stored headers with the permitted fields of a 304 over them."""
    allowed = F.map_filter(_fields(update), lambda k, v: ~k.isin(*KEPT))
    own = F.map_filter(_fields(stored), lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(own, allowed)


def _tag(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_replace(F.trim(c), "^W/", ""), '"', ""), F.lit(""))


def asof(left: DataFrame, right: DataFrame, key: str, time: str, row_id: str, payload: list[str]) -> DataFrame:
    """``left`` plus ``match``: the payload struct of the latest strictly earlier ``right`` row of the same key."""
    spark = left.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lcols = [c for c in left.columns]
    a = left.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.lit(0).alias("side"), F.lit(None).cast(right.schema[row_id].dataType)
        .alias("rid"), F.struct(*lcols).alias("row"),
        F.lit(None).cast(right.select(F.struct(*payload).alias("p")).schema["p"].dataType).alias("p"))
    b = right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.lit(1).alias("side"), F.col(row_id).alias("rid"),
        F.lit(None).cast(a.schema["row"].dataType).alias("row"), F.struct(*payload).alias("p"))
    order = ["k", "t", "side", "rid"]
    ranged = a.unionByName(b).repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()).checkpoint()
    w = Window.partitionBy("part", "k").orderBy("t", "side", "rid").rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumn("last", F.last(F.when(F.col("side") == 1, F.col("p")), ignorenulls=True).over(w)) \
        .where("side = 0")
    # keys that stretch over several ranges: at most one begins and one ends in each range
    spans = ranged.groupBy("k", "part").agg(F.max_by("p", F.when(F.col("side") == 1, F.struct("t", "rid"))).alias("end"))
    many = spans.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.join(many, "k").withColumn("from", F.last("end", ignorenulls=True).over(before)) \
        .select("k", "part", "from")
    hit = inside.join(carried, ["k", "part"], "left").select("row.*", F.coalesce("last", "from").alias("match"))
    none = left.where(F.col(key).isNull() | F.col(time).isNull())
    return hit.unionByName(none.withColumn("match", F.lit(None).cast(hit.schema["match"].dataType)))


def resolve(records: DataFrame) -> DataFrame:
    """Revisits of ``records(record_id, url, time, status, etag, last_modified, headers)`` resolved.

    (record_id, canonical_url, time, response_id, response_time, status, headers): ``status`` as in the
    module's text, ``headers`` the merged map (the revisit's own permitted fields where nothing is resolved).
    """
    base = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "time", "status", "etag",
                          "last_modified", "headers")
    full = base.where(F.col("status").between(200, 299))
    revisit = base.where("status = 304").drop("status")
    j = asof(revisit, full, "canonical_url", "time", "record_id", ["record_id", "time", "etag", "last_modified", "headers"])
    tags = _tag(F.col("etag")).isNotNull() & _tag(F.col("match.etag")).isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("match.last_modified").isNotNull()
    status = (F.when(F.col("match").isNull(), "no_response")
              .when(tags, F.when(_tag(F.col("etag")) == _tag(F.col("match.etag")), "resolved").otherwise("mismatch"))
              .when(dates, F.when(F.col("last_modified") == F.col("match.last_modified"), "resolved").otherwise("mismatch"))
              .otherwise("unchecked"))
    stored = F.when(status.isin("resolved", "unchecked"), F.col("match.headers"))
    return j.select("record_id", "canonical_url", "time", F.col("match.record_id").alias("response_id"),
                    F.col("match.time").alias("response_time"), status.alias("status"),
                    merged(stored, F.col("headers")).alias("headers"))


def with_body(resolved: DataFrame, bodies: DataFrame, record_id: str = "record_id", body: str = "body") -> DataFrame:
    """``resolved`` plus the stored body of resolved and unchecked revisits."""
    use = F.when(F.col("status").isin("resolved", "unchecked"), F.col("response_id"))
    b = bodies.select(F.col(record_id).alias("_bid"), F.col(body).alias("body"))
    return resolved.withColumn("_use", use).join(b, F.col("_use") == F.col("_bid"), "left").drop("_use", "_bid")


def captures(pages: DataFrame) -> DataFrame:
    """The pages table as a crawl: every page is a full response, and is revisited once under another form of its URL.

    By page_id some revisits come before the response, carry a stale tag, only a date, or no validator.
    """
    p = F.col("page_id")
    t0 = p * 7919 % 1000003
    tag = F.md5("html")
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    full = pages.select(
        p.alias("page_id"), (p * 2).alias("record_id"), F.col("url"), t0.alias("time"), F.lit(200).alias("status"),
        F.concat(F.lit('"'), tag, F.lit('"')).alias("etag"), (t0 - p % 5000).alias("last_modified"),
        F.map_from_entries(F.array(entry("Content-Type", F.lit("text/html")), entry("Content-Length", F.length("html").cast("string")),
                                   entry("Cache-Control", F.concat(F.lit("max-age="), (p % 600).cast("string"))),
                                   entry("Date", t0.cast("string")))).alias("headers"))
    t1 = F.when(p % 19 == 0, t0 - 1).otherwise(t0 + 1 + p % 977)
    other = F.concat(F.lit("HTTPS://WWW."), F.regexp_replace(F.col("url"), r"^https?://(www\.)?|#.*$", ""),
                     F.when(p % 2 == 0, F.lit("#again")).otherwise(F.lit("")))
    again = pages.select(
        p.alias("page_id"), (p * 2 + 1).alias("record_id"), other.alias("url"), t1.alias("time"), F.lit(304).alias("status"),
        F.when(p % 11 == 0, F.lit('"stale"')).when((p % 13 == 0) | (p % 17 == 0), F.lit(None))
        .otherwise(F.concat(F.lit('W/"'), tag, F.lit('"'))).alias("etag"),
        F.when(p % 17 == 0, F.lit(None)).otherwise(t0 - p % 5000).alias("last_modified"),
        F.map_from_entries(F.array(entry("cache-control", F.concat(F.lit("max-age="), (p % 700).cast("string"))),
                                   entry("content-length", F.lit("0")), entry("date", t1.cast("string")),
                                   entry("X-Cache", F.lit("revalidated")))).alias("headers"))
    return full.unionByName(again)


def query(spark, sf_dir: str) -> DataFrame:
    r = resolve(captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return r.select("record_id", "canonical_url", "response_id", "status", F.array_join(fields, "\n").alias("headers"))


ORACLE_SQL = rf"""
with p as (select page_id as p, url, html, page_id * 7919 % 1000003 as t0, md5(html) as tag from pages),
c as (
  select p, p * 2 as record_id, url, t0 as t, 200 as status, tag as etag, t0 - p % 5000 as lm from p
  union all
  select p, p * 2 + 1, 'https://' || regexp_replace(url, '^https?://(www\.)?|#.*$', '', 'g')
           || case when p % 2 = 0 then '#again' else '' end,
         case when p % 19 = 0 then t0 - 1 else t0 + 1 + p % 977 end, 304,
         case when p % 11 = 0 then 'stale' when p % 13 = 0 or p % 17 = 0 then null else tag end,
         case when p % 17 = 0 then null else t0 - p % 5000 end from p),
u as (select *, regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://(www\.)?', '') as bare from c),
k as (select *, lower(regexp_extract(bare, '^([^/?]*)', 1))
                || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') as head,
             list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
                       lambda x: x <> '' and not regexp_matches(x, '^({TRACKING})(=|$)'))) as q from u),
n as (select *, head || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as canonical_url from k),
a as (select v.record_id, v.canonical_url, v.p as vp, v.t as vt, v.etag, v.lm,
             (select max(struct_pack(t := r.t, id := r.record_id)) from n r
              where r.status = 200 and r.canonical_url = v.canonical_url and r.t < v.t).id as response_id
      from n v where v.status = 304),
s as (select a.*, r.p as rp, length(w.html) as size,
             case when r.record_id is null then 'no_response'
                  when a.etag is not null then case when a.etag = r.etag then 'resolved' else 'mismatch' end
                  when a.lm is not null then case when a.lm = r.lm then 'resolved' else 'mismatch' end
                  else 'unchecked' end as status
      from a left join n r on a.response_id = r.record_id left join pages w on w.page_id = r.p)
select record_id, canonical_url, response_id, status,
       'cache-control: max-age=' || vp % 700 || chr(10)
       || case when status in ('resolved', 'unchecked')
               then 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) else '' end
       || 'date: ' || vt || chr(10) || 'x-cache: revalidated' as headers
from s
"""
