"""WARC not-modified revisits resolved by an as-of join on the canonical URL.

Every revisit record meets the latest earlier full response (status 200) of its canonical
URL.  Its validators are checked (entity tag by weak comparison, or else Last-Modified); if
they agree, the response's headers are updated with the permitted headers of the revisit
and its payload digest is taken over.

The as-of join has two levels, so a URL with any share of the records is cut over many
tasks: records are range-partitioned by (URL, time, kind, id) and staged with their
partition; inside a (URL, partition) group a window carries the last response forward; the
last response of each group is carried on to the URL's later partitions over one row per
group.  Only keys, headers and digests move, never the payload.

Defined results: a revisit without URL is ``no_url``, without time ``no_time``; without an
earlier response ``no_response``; without validators ``no_validator``; with others than the
response's ``mismatch``; else ``resolved``.  Responses without URL or time are not used; of
responses at one time the one with the largest id counts; a response at the revisit's own
time is not earlier; repeated revisit rows each give a row; null headers are none; header
names compare in lower case, the last value of a repeated name counts; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadsmith.llm.common import staged

# fixed values: fields of a 304 that never update a stored response (RFC 9111, section 3.2, and connection fields)
NOT_PERMITTED = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                 "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection",
                 "te", "trailer", "transfer-encoding", "upgrade"]
#: Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|gclid|fbclid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host, path and sorted query: without scheme, user, default port, leading www., fragment, tracking parameters, last slash."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), r"^www\.", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^?]*", 0), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.concat(host, F.when(path == "", "/").otherwise(path),
                    F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise(""))


def lower_names(headers: Column) -> Column:
    entries = F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull())
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    values = F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"])
    return F.coalesce(F.map_from_arrays(names, values), F.create_map().cast("map<string,string>"))


def merge_headers(stored: Column, update: Column) -> Column:
    """Stored headers with the permitted headers of the update in their place."""
    permitted = F.map_filter(update, lambda n, _: ~n.isin(NOT_PERMITTED))
    return F.map_concat(F.map_filter(stored, lambda n, _: ~F.map_contains_key(permitted, n)), permitted)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records`` (record_id, type, url, ts, status, headers, payload_digest).

    Returns record_id, canonical_url, ts, outcome, response_id, response_ts, payload_digest, headers.
    """
    full = (F.col("type") == "response") & (F.col("status") == 200)
    base = records.select(
        F.col("record_id").cast("string").alias("record_id"), F.col("type"), canonical_url(F.col("url")).alias("canonical_url"), "ts",
        lower_names(F.col("headers")).alias("headers"), "payload_digest", F.when(full, 1).otherwise(0).alias("kind"))
    base = base.where((F.col("type") == "revisit") | (F.col("kind") == 1))
    usable = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = staged(base.where(usable).repartitionByRange(parts, "canonical_url", "ts", "kind", "record_id")
                     .withColumn("part", F.spark_partition_id()), "revisits")
    response = F.when(F.col("kind") == 1, F.struct(F.col("record_id").alias("id"), "ts", "headers", "payload_digest"))
    own = Window.partitionBy("canonical_url", "part").orderBy("ts", "kind", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    here = ordered.withColumn("here", F.last(response, ignorenulls=True).over(own)).where("kind = 0")
    ends = ordered.where("kind = 1").groupBy("canonical_url", "part").agg(
        F.max_by(F.struct(F.col("record_id").alias("id"), "ts", "headers", "payload_digest"), F.struct("ts", "record_id")).alias("end"))
    groups = ordered.select("canonical_url", "part").distinct().join(ends, ["canonical_url", "part"], "left")
    before = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.select("canonical_url", "part", F.last("end", ignorenulls=True).over(before).alias("carried")).where("carried is not null")
    met = here.join(carried, ["canonical_url", "part"], "left").withColumn("r", F.coalesce("here", "carried"))
    loose = (base.where(~usable & (F.col("kind") == 0)))
    met = met.select("record_id", "canonical_url", "ts", "headers", "r").unionByName(
        loose.select("record_id", "canonical_url", "ts", "headers", F.lit(None).cast(met.schema["r"].dataType).alias("r")))
    tag, date = F.col("headers")["etag"], F.col("headers")["last-modified"]
    agrees = F.when(tag.isNotNull(), _weak(tag) == _weak(F.col("r.headers")["etag"])).otherwise(date == F.col("r.headers")["last-modified"])
    outcome = (F.when(F.col("canonical_url").isNull(), "no_url").when(F.col("ts").isNull(), "no_time")
               .when(F.col("r").isNull(), "no_response").when(tag.isNull() & date.isNull(), "no_validator")
               .when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("mismatch"))
    met = met.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return met.select("record_id", "canonical_url", "ts", "outcome", F.col("r.id").alias("response_id"), F.col("r.ts").alias("response_ts"),
                      F.when(ok, F.col("r.payload_digest")).alias("payload_digest"),
                      F.when(ok, merge_headers(F.col("r.headers"), F.col("headers"))).alias("headers"))


HTTP_DATE = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def capture_records(pages: DataFrame) -> DataFrame:
    """Capture records derived from the table of pages.

    Each page gives a response (not every 7th), a not-modified revisit a day later under another
    spelling of its URL, every 3rd a changed response after two days, and a revisit with the
    first validators after three days (of every 5th with Last-Modified alone, every 11th without any).
    """
    n = F.col("page_id")
    second = F.lit(1704067200) + n * 60
    day = F.lit(86400)

    def headers(**fields):
        return F.map_filter(F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in fields]), F.array(*fields.values())), lambda _, v: v.isNotNull())
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html").cast("binary")), 1, 16), F.lit('"'))
    new_tag = F.concat(F.lit('"'), F.substring(F.md5(F.concat("html", F.lit("v2")).cast("binary")), 1, 16), F.lit('"'))
    when = lambda s: F.date_format(F.timestamp_seconds(s), HTTP_DATE)
    modified = when(F.lit(1700000000) + F.pmod(n, F.lit(50)) * day)
    digest = F.sha2(F.col("html").cast("binary"), 256)
    size = F.octet_length("html").cast("string")

    def record(name, kind, url, s, status, h, payload, take):
        return F.when(take, F.struct(F.concat(n.cast("string"), F.lit(name)).alias("record_id"), F.lit(kind).alias("type"), url.alias("url"),
                                     F.timestamp_seconds(s).alias("ts"), F.lit(status).alias("status"), h.alias("headers"), payload.alias("payload_digest")))
    other = F.concat(F.regexp_replace(F.regexp_replace("url", "^https:", "HTTP:"), "#.*$", ""), F.lit("#part"))
    no_digest = F.lit(None).cast("string")
    only_date, none = F.pmod(n, F.lit(5)) == 0, F.pmod(n, F.lit(11)) == 0
    rows = F.array(
        record("-a", "response", F.col("url"), second, 200, headers(
            Content_Type=F.lit("text/html"), Content_Length=size, ETag=tag, Last_Modified=modified, Date=when(second), Cache_Control=F.lit("max-age=60")),
            digest, F.pmod(n, F.lit(7)) != 3),
        record("-b", "revisit", other, second + day, 304, headers(
            ETag=F.concat(F.lit("W/"), tag), Date=when(second + day), Cache_Control=F.lit("max-age=600"), Content_Length=F.lit("0"),
            X_Served_By=F.concat(F.lit("c"), F.pmod(n, F.lit(4)).cast("string"))), no_digest, F.lit(True)),
        record("-c", "response", F.col("url"), second + 2 * day, 200, headers(
            Content_Type=F.lit("text/html"), Content_Length=size, ETag=new_tag, Last_Modified=when(second + 2 * day), Date=when(second + 2 * day),
            Cache_Control=F.lit("max-age=60")), digest, F.pmod(n, F.lit(3)) == 0),
        record("-d", "revisit", F.col("url"), second + 3 * day, 304, headers(
            ETag=F.when(~only_date & ~none, tag), Last_Modified=F.when(only_date & ~none, modified), Date=when(second + 3 * day),
            Cache_Control=F.lit("max-age=600")), no_digest, F.lit(True)))
    return pages.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")


def resolved_pages(pages: DataFrame) -> DataFrame:
    """Revisits of the derived records, with merged headers as text."""
    r = resolve(capture_records(pages))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return r.select("record_id", "canonical_url", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("revisit_time"), "outcome", "response_id",
                    F.date_format("response_ts", "yyyy-MM-dd HH:mm:ss").alias("response_time"), "payload_digest",
                    F.array_join(lines, "\n").alias("headers"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, html, 1704067200 + page_id * 60 AS s, '"' || md5(html)[1:16] || '"' AS tag,
         '"' || md5(html || 'v2')[1:16] || '"' AS tag2, 1700000000 + page_id % 50 * 86400 AS lm, sha256(html) AS digest,
         strlen(html)::VARCHAR AS size FROM pages),
rec AS (
  SELECT page_id || '-a' AS record_id, 1 AS kind, url, s, tag, lm, 'max-age=60' AS cache, digest, size, NULL AS served FROM p WHERE page_id % 7 <> 3
  UNION ALL SELECT page_id || '-b', 0, url, s + 86400, tag, NULL, 'max-age=600', NULL, NULL, 'c' || page_id % 4 FROM p
  UNION ALL SELECT page_id || '-c', 1, url, s + 172800, tag2, s + 172800, 'max-age=60', digest, size, NULL FROM p WHERE page_id % 3 = 0
  UNION ALL SELECT page_id || '-d', 0, url, s + 259200, CASE WHEN page_id % 5 <> 0 AND page_id % 11 <> 0 THEN tag END,
         CASE WHEN page_id % 5 = 0 AND page_id % 11 <> 0 THEN lm END, 'max-age=600', NULL, NULL, NULL FROM p),
split AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest
  FROM (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM rec)),
canon AS (
  SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END AS canonical_url
  FROM (SELECT *, regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') AS path,
               list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid|ref)(=|$)')) AS q
        FROM split)),
met AS (
  SELECT v.*, f.record_id AS rid, f.s AS rs, f.tag AS rtag, f.lm AS rlm, f.digest AS rdigest, f.size AS rsize,
         row_number() OVER (PARTITION BY v.record_id ORDER BY f.s DESC, f.record_id DESC) AS rn
  FROM (SELECT * FROM canon WHERE kind = 0) v
  LEFT JOIN (SELECT * FROM canon WHERE kind = 1) f ON f.canonical_url = v.canonical_url AND f.s < v.s),
judged AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'no_response' WHEN tag IS NULL AND lm IS NULL THEN 'no_validator'
                 WHEN CASE WHEN tag IS NOT NULL THEN tag = rtag ELSE lm = rlm END THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM met WHERE rn = 1)
SELECT record_id, canonical_url, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS revisit_time, outcome,
       rid AS response_id, strftime(make_timestamp(rs * 1000000), '%Y-%m-%d %H:%M:%S') AS response_time,
       CASE WHEN outcome = 'resolved' THEN rdigest END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: ' || cache || chr(10) || 'content-length: ' || rsize || chr(10) || 'content-type: text/html' || chr(10)
            || 'date: ' || strftime(make_timestamp(s * 1000000), '%a, %d %b %Y %H:%M:%S GMT') || chr(10)
            || 'etag: ' || CASE WHEN record_id LIKE '%-b' THEN 'W/' || tag WHEN tag IS NOT NULL THEN tag ELSE rtag END || chr(10)
            || 'last-modified: ' || strftime(make_timestamp(coalesce(lm, rlm) * 1000000), '%a, %d %b %Y %H:%M:%S GMT')
            || coalesce(chr(10) || 'x-served-by: ' || served, '') END AS headers
FROM judged
"""
