"""Server-not-modified revisits of a crawl, resolved to the response they stand for.

A WARC revisit record with this profile says that the server answered 304: its body is that of an earlier capture.  The
body is found by an as-of join: the latest earlier full response (status 200 with a body) of the same canonical URL.
It counts if the revisit's validators agree with it (ETag by weak comparison, or else Last-Modified); the response's
headers are then brought up to date with those that a 304 may change.

The as-of join sorts (URL, time) over range partitions, however often a URL was captured; a partition learns the last
full response before it from a prefix over the partitions' last ones.  All captures at one instant are one row there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.llm.common import table
from spanweave.shared import written

# Fields of the connection and of the stored body, which a 304 does not change (RFC 9110 7.6.1, RFC 9111 3.2).
KEPT_HEADERS = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
]
# Query parameters that name a visit and not a page.
VISIT_PARAMETERS = "utm_[a-z]+|ref|sessionid|jsessionid|phpsessid|gclid|fbclid"


def canonical_url(url: Column) -> Column:
    """Without scheme, www., default port, fragment, visit parameters and trailing slash; host in lower case."""
    url = F.regexp_replace(F.trim(url), r"(?i)^https?://(www[0-9]*\.)?", "")
    url = F.regexp_replace(url, "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(url, "^[^/?]*", 0)), r":(80|443)$", "")
    rest = F.regexp_replace(F.regexp_extract(url, "^[^/?]*(.*)$", 1), rf"([?&])({VISIT_PARAMETERS})=[^&]*", "$1")
    return F.concat(host, F.regexp_replace(F.regexp_replace(rest, r"([?&])&+", "$1"), "[?&/]+$", ""))


def _lower_names(headers: Column) -> Column:
    """Names in lower case; of a name that repeats, the last value."""
    entries = F.map_entries(headers)
    names = F.array_distinct(F.transform(F.map_keys(headers), F.lower))
    last = lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"]
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.map_from_arrays(names, F.transform(names, last)), empty)


def _latest_before(instants: DataFrame) -> DataFrame:
    """(key, time, full) -> (key, time, found): the full of the latest earlier instant of the key that has one."""
    cuts = max(int(instants.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = instants.repartitionByRange(cuts, "key", "time").withColumn("part", F.spark_partition_id())
    placed = written(placed, "instants")
    this = F.when(F.col("full").isNotNull(), F.struct("key", "time", "full"))
    tails = placed.groupBy("part").agg(F.max(this).alias("tail"))
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select("part", F.max("tail").over(before_part).alias("carried"))
    before = Window.partitionBy("part").orderBy("key", "time").rowsBetween(Window.unboundedPreceding, -1)
    seen = placed.withColumn("near", F.last(this, ignorenulls=True).over(before)).join(tails, "part")
    last = F.coalesce("near", "carried")
    return seen.select("key", "time", F.when(last["key"] == F.col("key"), last["full"]).alias("found"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """records: record_id long, type ('response', 'revisit', others are ignored), url, time long, status int,
    headers map<string,string>, payload string or binary.

    Returns per revisit: record_id, url, time, verdict, refers_to (the response's record_id), refers_to_time, headers,
    payload.  verdict is 'resolved', 'no_response' (none earlier; also without URL or time), 'no_validator' (the
    revisit has none) or 'changed' (they disagree); headers and payload are null unless it is 'resolved'.

    Earlier is strictly earlier; of responses at one instant the largest record_id counts.  Of responses that repeat a
    record_id one is taken.  Rows that repeat a revisit stay.  Header names are in lower case.  No rows in, no rows out;
    other columns are not looked at.
    """
    keyed = records.withColumn("key", canonical_url(F.col("url")))
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull()
    marked = keyed.select("record_id", "key", "time", "type", full.alias("full")).filter("key IS NOT NULL AND time IS NOT NULL")
    instants = (
        marked.filter("full OR type = 'revisit'")
        .groupBy("key", "time")
        .agg(F.max(F.when(F.col("full"), F.col("record_id"))).alias("full"))
    )
    as_of = written(_latest_before(instants).filter("found IS NOT NULL"), "as-of")
    asked = keyed.filter("type = 'revisit'").select("record_id", "url", "key", "time", _lower_names(F.col("headers")).alias("own"))
    # Written, so that the join below has plain exchanges on both sides, which Spark splits for much visited responses.
    stored = written(
        keyed.filter(full)
        .select("record_id", "time", _lower_names(F.col("headers")).alias("stored"), "payload")
        .dropDuplicates(["record_id"]),
        "responses",
    )
    stored = stored.select(
        F.col("record_id").alias("refers_to"), F.col("time").alias("refers_to_time"), "stored", F.col("payload").alias("body")
    )
    pairs = asked.join(as_of.withColumnRenamed("found", "refers_to"), ["key", "time"], "left").join(stored, "refers_to", "left")
    tag = lambda h: F.regexp_replace(F.trim(h["etag"]), "^W/", "")
    date = lambda h: F.trim(h["last-modified"])
    own, held = F.col("own"), F.col("stored")
    agrees = F.when(tag(own).isNotNull(), tag(own).eqNullSafe(tag(held))).otherwise(date(own).eqNullSafe(date(held)))
    verdict = (
        F.when(F.col("refers_to").isNull(), "no_response")
        .when(tag(own).isNull() & date(own).isNull(), "no_validator")
        .when(agrees, "resolved")
        .otherwise("changed")
    )
    permitted = F.map_filter(own, lambda k, v: ~k.isin(KEPT_HEADERS))
    older = F.map_filter(held, lambda k, v: ~F.array_contains(F.map_keys(permitted), k))
    resolved = F.col("verdict") == "resolved"
    return pairs.withColumn("verdict", verdict).select(
        "record_id", "url", "time", "verdict", "refers_to", "refers_to_time",
        F.when(resolved, F.map_concat(older, permitted)).alias("headers"),
        F.when(resolved, F.col("body")).alias("payload"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """A crawl over the pages: a full response each and revisits with equal, weak, dated and stale validators.

    The first revisit of a page comes before its response: it can only refer to an earlier page of the same URL.
    """
    page = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    date = F.concat(F.lit("day "), page.cast("string"))
    response = F.struct(
        F.lit(0).alias("k"), F.lit("response").alias("type"), F.lit(0).alias("after"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.octet_length("html").cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.col("html").alias("payload"),
    )
    revisit = lambda k, after, *headers: F.struct(
        F.lit(k).alias("k"), F.lit("revisit").alias("type"), F.lit(after).alias("after"), F.lit(304).alias("status"),
        F.create_map(*(F.lit(h) if isinstance(h, str) else h for h in headers)).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    shots = F.array(
        response,
        revisit(1, -50, "ETag", tag, "Date", date),
        revisit(2, 10, "etag", F.concat(F.lit("W/"), tag), "Cache-Control", "max-age=600", "Content-Length", "0"),
        revisit(3, 20, "Last-Modified", date, "Expires", "never", "Connection", "close"),
        revisit(4, 30, "ETag", '"stale"'),
    )
    # Each shot apart before the payload comes in, so that a page is not copied for all its revisits.
    return pages.select("page_id", "url", F.explode(shots).alias("s")).select(
        (page * 10 + F.col("s.k")).alias("record_id"), "s.type", "url", (page * 100 + F.col("s.after")).alias("time"),
        "s.status", "s.headers", "s.payload",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return found.select(
        "record_id", "time", "verdict", "refers_to", "refers_to_time",
        F.when(F.col("headers").isNotNull(), F.array_join(lines, "\n")).alias("headers"),
        F.md5("payload").alias("payload_md5"),
    )


SQL = rf"""
WITH cut AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '(?i)^https?://(www[0-9]*\.)?', ''), '#.*$', '') AS u FROM pages
), pieces AS (
  SELECT page_id, html, '"' || md5(html) || '"' AS tag, 'day ' || page_id AS day,
         regexp_replace(lower(regexp_extract(u, '^[^/?]*', 0)), ':(80|443)$', '')
         || regexp_replace(regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*(.*)$', 1),
              '([?&])({VISIT_PARAMETERS})=[^&]*', '\1', 'g'), '([?&])&+', '\1', 'g'), '[?&/]+$', '') AS key
  FROM cut
), responses AS (
  SELECT page_id * 10 AS refers_to, page_id * 100 AS refers_to_time, key, tag, day, md5(html) AS payload_md5,
         strlen(html) AS size FROM pieces WHERE html IS NOT NULL AND key IS NOT NULL
), revisits AS (
  SELECT page_id * 10 + k AS record_id, page_id * 100 + after AS time, key,
         CASE k WHEN 3 THEN NULL WHEN 4 THEN '"stale"' ELSE tag END AS own_tag, CASE k WHEN 3 THEN day END AS own_day, k, day AS own
  FROM pieces, (VALUES (1, -50), (2, 10), (3, 20), (4, 30)) AS v(k, after)
), found AS (
  SELECT * FROM revisits v ASOF LEFT JOIN responses r ON v.key = r.key AND v.time > r.refers_to_time
), judged AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no_response' WHEN own_tag IS NULL AND own_day IS NULL THEN 'no_validator'
                 WHEN own_tag = tag OR own_tag IS NULL AND own_day = day THEN 'resolved' ELSE 'changed' END AS verdict
  FROM found
)
SELECT record_id, time, verdict, refers_to, refers_to_time,
  CASE WHEN verdict = 'resolved' THEN array_to_string(list_filter([
    'cache-control: ' || CASE k WHEN 2 THEN 'max-age=600' ELSE 'max-age=60' END,
    'content-length: ' || size, 'content-type: text/html', CASE k WHEN 1 THEN 'date: ' || own END,
    'etag: ' || CASE k WHEN 2 THEN 'W/' ELSE '' END || tag, CASE k WHEN 3 THEN 'expires: never' END,
    'last-modified: ' || day], lambda x: x IS NOT NULL), chr(10)) END AS headers,
  CASE WHEN verdict = 'resolved' THEN payload_md5 END AS payload_md5
FROM judged
"""
