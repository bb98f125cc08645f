"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit record says that a page had not changed since an earlier capture. It is joined as of its time, by canonical
URL, with the latest earlier full response; when a validator agrees (entity tag, else the modification date), it takes
that response's payload, and its headers update the stored ones where a 304 may.

The join is by time within (URL, bucket of time) and then over the buckets of a URL, so that a URL with a third of all
records is spread over tasks. Payloads are not moved: a result names the response's record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Query parameters that name a visit, not a page. Fixed values.
TRACKING = ["fbclid", "gclid", "ref", "sessionid", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
# Headers of a 304 that do not replace the stored ones: they describe the message or its (absent) body.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
RECORD = ["record_id", "url", "captured", "kind", "status", "headers", "digest", "length"]
BUCKET_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, without www, user, default port, fragment, tracking parameters and last slash.

    Parameters are sorted. http and https are one. Null for null and for texts that are no URL with a host.
    """
    parts = r"^\s*(?i:https?)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#[\s\S]*)?$"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r"^www\.|\.$", "")
    port = F.regexp_extract(url, parts, 2)
    path = F.regexp_replace(F.regexp_extract(url, parts, 3), r"\s+$", "")
    given = F.filter(
        F.split(F.regexp_replace(F.regexp_extract(url, parts, 4), r"\s+$", ""), "&"),
        lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(TRACKING),
    )
    query = F.array_join(F.array_sort(given), "&")
    out = F.concat(
        host, F.when(port.isin("", "80", "443"), F.lit("")).otherwise(F.concat(F.lit(":"), port)),
        F.when(F.regexp_replace(path, "/+$", "") == "", F.lit("/")).otherwise(F.regexp_replace(path, "/+$", "")),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )
    return F.when(F.regexp_extract(url, parts, 1) != "", out)


def header_map(headers: Column) -> Column:
    """Names in lower case without outer blanks; of equal names the last counts, and a null value is empty."""
    lower = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), F.coalesce(e["value"], F.lit("")).alias("value"))
    )
    last = F.filter(lower, lambda e, i: ~F.exists(F.slice(lower, i + 2, F.size(lower)), lambda l: l["key"] == e["key"]))
    return F.coalesce(F.map_from_entries(last), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def value(headers: Column, name: str) -> Column:
    return F.nullif(F.trim(F.element_at(headers, F.lit(name))), F.lit(""))


def validators_agree(stored: Column, sent: Column) -> Column:
    """Weak comparison of entity tags where both have one, else equal modification dates; false where neither tells."""
    tag, other = (F.regexp_replace(value(h, "etag"), "^W/", "") for h in (stored, sent))
    date, date_sent = value(stored, "last-modified"), value(sent, "last-modified")
    by_tag = F.when(tag.isNotNull() & other.isNotNull(), tag == other)
    by_date = F.when(date.isNotNull() & date_sent.isNotNull(), date == date_sent)
    return F.coalesce(by_tag, by_date, F.lit(False))


def merged(stored: Column, sent: Column) -> Column:
    """Stored headers updated by those that a 304 may update, as sorted (name, value) pairs."""
    update = F.map_filter(sent, lambda k, _: ~k.isin(NOT_MERGED))
    rest = F.map_filter(stored, lambda k, _: ~F.map_contains_key(update, k))
    return F.array_sort(F.concat(F.map_entries(rest), F.map_entries(update)))


def latest_earlier(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Each revisit with `found`, the latest full response of its URL that was captured before it.

    Of responses captured at one time the one with the greatest record id counts.
    """
    response = F.struct("captured", "record_id", F.col("headers").alias("headers"), "digest", "length")
    rows = records.withColumns({
        "_bucket": F.floor(F.col("captured").cast("double") / bucket_seconds).cast("long"),
        "_full": F.when(F.col("kind") == "response", response),
    })
    # A revisit of the same time as a response is not later than it, so it comes first.
    order = Window.partitionBy("key", "_bucket").orderBy(
        "captured", F.when(F.col("kind") == "response", 1).otherwise(0), "record_id"
    )
    inside = rows.withColumn("_near", F.last("_full", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    inside = inside.where(F.col("kind") == "revisit")
    # The last response of each bucket, carried over to the buckets after it: one row per URL and bucket.
    last = rows.groupBy("key", "_bucket").agg(F.max_by("_full", F.struct("captured", "record_id")).alias("any"), F.max(
        F.when(F.col("kind") == "response", F.struct("captured", "record_id"))).alias("at"))
    full = rows.where(F.col("kind") == "response").groupBy("key", "_bucket").agg(
        F.max_by("_full", F.struct("captured", "record_id")).alias("last")
    )
    buckets = last.select("key", "_bucket").join(full, ["key", "_bucket"], "left")
    before = Window.partitionBy("key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select("key", "_bucket", F.last("last", ignorenulls=True).over(before).alias("_far"))
    return inside.join(carried, ["key", "_bucket"]).withColumn("found", F.coalesce("_near", "_far")).drop(
        "_bucket", "_full", "_near", "_far"
    )


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit: (record_id, url_key, outcome, response_id, digest, length, headers).

    `records` has record_id long, url string, captured timestamp, kind ("response", "revisit", others are left out),
    status int, headers map<string,string>, digest string, length long; other columns are not read. Full responses are
    responses of status 200. outcome is "resolved", "changed" (the latest earlier response has other validators, or
    neither side has any to compare), "unseen" (no earlier response of the URL) or "invalid" (no URL or no time).
    response_id is that of the earlier response in the first two cases; digest, length and the merged headers (as
    sorted name and value pairs) are given when resolved. Repeated rows give repeated rows. An empty table gives none.
    """
    chosen = records.select(*RECORD)
    known = chosen.where(
        (F.col("kind") == "revisit") | ((F.col("kind") == "response") & (F.col("status") == 200))
    ).withColumns({"key": canonical_url(F.col("url")), "headers": header_map(F.col("headers"))})
    usable = F.col("key").isNotNull() & F.col("captured").isNotNull()
    joined = latest_earlier(known.where(usable), bucket_seconds)
    seen, agree = F.col("found").isNotNull(), validators_agree(F.col("found.headers"), F.col("headers"))
    outcome = F.when(~seen, "unseen").when(agree, "resolved").otherwise("changed")
    out = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    columns = [
        "record_id", F.col("key").alias("url_key"), "outcome", F.col("found.record_id").alias("response_id"),
        F.when(resolved, F.col("found.digest")).alias("digest"), F.when(resolved, F.col("found.length")).alias("length"),
        F.when(resolved, merged(F.col("found.headers"), F.col("headers"))).alias("headers"),
    ]
    out = out.select(*columns)
    invalid = known.where((F.col("kind") == "revisit") & ~usable)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in out.dtypes[3:]]
    return out.unionByName(invalid.select("record_id", F.col("key").alias("url_key"), F.lit("invalid").alias("outcome"), *nothing))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures as records, made from the page table by fixed rules; a page's URL gets every capture of its row.

    Page n is fetched in full at second 900 n. It is visited again one hour later, when its validators still hold (in
    every fifth page the entity tag has changed, in every seventh only the date is sent), and once more 30 hours later.
    Every eleventh page is first visited a minute before its response.
    """
    n, at = F.col("page_id"), F.col("page_id") * 900
    tag, date = F.concat(F.lit('"'), F.md5("html"), F.lit('"')), F.concat(F.lit("day "), (n % 365).cast("string"))

    def headers(**pairs: Column) -> Column:
        return F.map_from_arrays(
            F.array(*[F.lit(k.replace("_", "-")) for k in pairs]), F.array(*[v.cast("string") for v in pairs.values()])
        )

    length = F.octet_length("html").cast("long")
    full = F.struct(
        (n * 4).alias("record_id"), at.alias("second"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        headers(Content_Type=F.lit("text/html"), Content_Length=length, ETag=tag, Last_Modified=date, Cache_Control=F.lit("max-age=60")).alias("headers"),
        F.md5("html").alias("digest"), length.alias("length"),
    )

    def visit(k: int, second: Column, sent: Column) -> Column:
        return F.struct(
            (n * 4 + k).alias("record_id"), second.alias("second"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
            sent.alias("headers"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("length"),
        )

    changed = F.when(n % 5 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    by_tag = headers(ETAG=changed, Date=(at + 3600), Cache_Control=F.lit("max-age=90"), Content_Length=F.lit(0))
    by_date = headers(last_modified=date, Date=(at + 3600), Content_Length=F.lit(0))
    visits = [
        visit(1, at + 3600, F.when(n % 7 == 0, by_date).otherwise(by_tag)),
        visit(2, at + 108_000, headers(ETag=tag, Server=F.lit("late"))),
        F.when(n % 11 == 0, visit(3, at - 60, headers(ETag=tag))),
    ]
    rows = pages.where(n.isNotNull()).select("url", F.explode(F.array_compact(F.array(full, *visits))).alias("r"))
    return rows.select("url", "r.*").withColumn("captured", F.timestamp_seconds("second")).drop("second")


_TRACKED = "|".join(TRACKING)
_KEPT = "', '".join(NOT_MERGED)
SQL = rf"""
WITH parts AS (
  SELECT page_id AS n, html,
    regexp_replace(lower(regexp_extract(url, '^\s*(?:[hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.|\.$', '', 'g') AS host,
    regexp_extract(url, '^\s*(?:[hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?[^/?#:]+:(\d*)', 1) AS port,
    regexp_replace(regexp_extract(url, '^\s*(?:[hH][tT][tT][pP][sS]?)://[^/?#]+([^?#]*)', 1), '/*\s*$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_full_match(lower(string_split(p, '=')[1]), '{_TRACKED}'))) AS params
  FROM pages
), keyed AS (
  SELECT n, html, host || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END
    || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS key,
    '"' || md5(html) || '"' AS tag, 'day ' || (n % 365) AS date
  FROM parts
), responses AS (
  SELECT key, n * 900 AS at, n * 4 AS record_id, tag, date, md5(html) AS digest, strlen(html)::BIGINT AS length FROM keyed
), visits AS (
  SELECT key, n * 4 + 1 AS record_id, n * 900 + 3600 AS at,
    CASE WHEN n % 7 = 0 THEN NULL WHEN n % 5 = 0 THEN '"other"' ELSE tag END AS tag,
    CASE WHEN n % 7 = 0 THEN date END AS date,
    CASE WHEN n % 7 = 0 THEN [{{'key': 'date', 'value': (n * 900 + 3600)::VARCHAR}}, {{'key': 'last-modified', 'value': date}}]
      ELSE [{{'key': 'cache-control', 'value': 'max-age=90'}}, {{'key': 'date', 'value': (n * 900 + 3600)::VARCHAR}},
        {{'key': 'etag', 'value': CASE WHEN n % 5 = 0 THEN '"other"' ELSE 'W/' || tag END}}] END AS sent
  FROM keyed
  UNION ALL
  SELECT key, n * 4 + 2, n * 900 + 108000, tag, NULL, [{{'key': 'etag', 'value': tag}}, {{'key': 'server', 'value': 'late'}}] FROM keyed
  UNION ALL
  SELECT key, n * 4 + 3, n * 900 - 60, tag, NULL, [{{'key': 'etag', 'value': tag}}] FROM keyed WHERE n % 11 = 0
), latest AS (
  SELECT v.record_id, max(r.at) AS at FROM visits v JOIN responses r ON v.key = r.key AND r.at < v.at GROUP BY v.record_id
), found AS (
  SELECT v.*, r.record_id AS response_id, r.digest, r.length, r.tag AS r_tag, r.date AS r_date,
    [{{'key': 'cache-control', 'value': 'max-age=60'}}, {{'key': 'content-length', 'value': r.length::VARCHAR}},
     {{'key': 'content-type', 'value': 'text/html'}}, {{'key': 'etag', 'value': r.tag}}, {{'key': 'last-modified', 'value': r.date}}] AS stored
  FROM visits v LEFT JOIN latest l ON v.record_id = l.record_id LEFT JOIN responses r ON r.key = v.key AND r.at = l.at
), judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'unseen'
    WHEN CASE WHEN tag IS NOT NULL THEN tag = r_tag ELSE coalesce(date = r_date, false) END THEN 'resolved' ELSE 'changed' END AS outcome
  FROM found
)
SELECT record_id, key AS url_key, outcome, response_id, CASE WHEN outcome = 'resolved' THEN digest END AS digest,
  CASE WHEN outcome = 'resolved' THEN length END AS length,
  CASE WHEN outcome = 'resolved' THEN array_to_string(list_transform(list_sort(list_concat(
    list_filter(stored, lambda s: NOT list_contains(list_transform(sent, lambda x: x.key), s.key)), sent)),
    lambda e: e.key || ': ' || e.value), chr(10)) END AS headers
FROM judged
"""
