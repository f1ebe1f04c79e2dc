"""Not-modified revisit resolution over web-archive records.

A revisit record says that a URL's content had not changed and carries headers only. It is
resolved by an as-of join: the latest earlier full response of the same canonical URL. The
revisit's validators must agree with that response's (entity tags compared weakly, else
Last-Modified, else the payload digest); then the response's headers are updated with those
headers of the revisit that a 304 answer may change.

Scale: the join runs on slim rows (URL key, time, record id, validators, headers; never
payloads). Time is cut into slots, their number growing with the table; a URL's slots are separate groups, and a
slot's first rows see the last response of the earlier slots through a second pass over one
pre-aggregated row per (URL, slot). A URL with a third of all records is thus spread over
the slots. Payloads join by record id afterwards, only where asked for.

Defined cases: a null or empty URL has the canonical form '' and is a URL like any other;
records without a time resolve to nothing, and those without a time or an id serve nothing; a response at the same instant
is not earlier; of responses at one instant the one with the largest record id is the
latest; a null headers map is empty; header names are compared in lower case (of names that
clash, the last in order of the original name counts); repeated revisit rows each get their
row. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pricelens.llm.common import written

# What a 304 answer must not change, by the HTTP semantics (representation
# metadata and framing); all other headers of the revisit are merged.
FORBIDDEN = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
SLOTS = 64  # at least; more where a slot of the whole table would pass SLOT_ROWS rows
SLOT_ROWS = 200_000
QUANTILES = 256  # cuts of the time axis by counts


def canonical_url(url: Column) -> Column:
    """Lower-case host without 'www.', default port or user; no scheme, fragment or final slash; sorted query."""
    bare = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "^[^/?@]*@", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www\\.|:(80|443)$", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, "\\?.*$", 0), "^\\?", "")
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: p != ""))
    tail = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
    return F.concat(host, path, tail)


def lower_headers(headers: Column) -> Column:
    """A map with lower-case names."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    lowered = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(lowered, lambda e, i: ~F.exists(
        F.slice(lowered, i + 2, F.greatest(F.size(lowered) - i - 1, F.lit(0))), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def weak(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def _slotted(records: DataFrame, slots: int) -> DataFrame:
    """Slim records with ``slot``: the time axis of the whole table cut where equally many records lie
    between the cuts (``QUANTILES`` at most), and each of these parts into equal times if more are needed."""
    n = records.filter("ts IS NOT NULL").count()
    parts = max(slots, -(-n // SLOT_ROWS))
    cuts = min(parts, QUANTILES)
    shares = [k / cuts for k in range(cuts)] + [1.0]
    found = records.agg(F.percentile_approx("ts", shares, 20 * cuts).alias("q")).first()["q"]  # one row
    edges = sorted(set(found)) if found else [0]
    inner = -(-parts // len(edges))
    starts = F.array(*[F.lit(e).cast("long") for e in edges])
    part = F.greatest(F.size(F.filter(starts, lambda e: e <= F.col("ts"))), F.lit(1))
    if inner > 1:
        ends = F.array(*[F.lit(e).cast("long") for e in edges[1:] + [edges[-1] + 1]])
        low, high = F.element_at(starts, part), F.element_at(ends, part)
        width = F.greatest(F.ceil((high - low) / F.lit(inner)), F.lit(1))
        within = F.greatest(F.least(F.floor((F.col("ts") - low) / width), F.lit(inner - 1)), F.lit(0))
        part = part * F.lit(inner) + within
    return records.withColumn("slot", F.when(F.col("ts").isNotNull(), part).cast("long"))


def resolve(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per revisit record.

    ``records``: record_id long, kind 'response' or 'revisit', url, ts long, headers
    map<string,string>, digest (of the payload; a revisit's names the payload it refers to).
    Returns record_id, url_key, ts, response_id (null if there is none earlier), response_ts,
    status ('resolved', 'no_earlier_response', 'validator_mismatch', 'no_validator'),
    matched_by ('etag', 'last-modified', 'digest' or null) and headers (merged if resolved;
    as a sorted 'name: value' text, one a line).
    """
    slim = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", (F.col("kind") == "response").alias("full"), canonical_url(F.col("url")).alias("url_key"),
        F.col("ts").cast("long").alias("ts"), lower_headers(F.col("headers")).alias("h"), "digest")
    slotted = written(_slotted(slim, slots), "revisits")
    response = F.struct("ts", "record_id")
    full = F.col("full") & F.col("ts").isNotNull() & F.col("record_id").isNotNull()
    # The last response of each (URL, slot), then of all earlier slots: a row per URL and slot.
    last = slotted.filter(full).groupBy("url_key", "slot").agg(
        F.max(response).alias("last"))
    every = slotted.filter(F.col("ts").isNotNull()).select("url_key", "slot").distinct()
    earlier = Window.partitionBy("url_key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(last, ["url_key", "slot"], "left").select(
        "url_key", "slot", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    # Inside a slot: the latest response at a strictly smaller time.
    inside = Window.partitionBy("url_key", "slot").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    within = slotted.filter(F.col("ts").isNotNull()).withColumn(
        "near", F.max(F.when(full, F.struct("ts", "record_id"))).over(inside))
    revisits = within.filter(~F.col("full"))
    found = revisits.join(carried, ["url_key", "slot"], "left").select(
        "record_id", "url_key", "ts", "h", "digest",
        F.coalesce(F.col("near.record_id"), F.col("carried.record_id")).alias("response_id"),
        F.coalesce(F.col("near.ts"), F.col("carried.ts")).alias("response_ts"))
    timeless = slotted.filter(~F.col("full") & F.col("ts").isNull()).select(
        "record_id", "url_key", "ts", "h", "digest", F.lit(None).cast("long").alias("response_id"),
        F.lit(None).cast("long").alias("response_ts"))
    base = slotted.filter(full).select(
        F.col("record_id").alias("response_id"), F.col("url_key").alias("r_url"), F.col("ts").alias("response_ts"),
        F.col("h").alias("r_h"), F.col("digest").alias("r_digest")).dropDuplicates(["response_id", "r_url", "response_ts"])
    joined = found.unionByName(timeless).join(
        base.withColumnRenamed("r_url", "url_key"), ["response_id", "url_key", "response_ts"], "left")
    return joined.select("record_id", "url_key", "ts", "response_id", "response_ts", *_judged())


def _judged() -> list[Column]:
    etag, r_etag = weak(F.col("h")["etag"]), weak(F.col("r_h")["etag"])
    mod, r_mod = F.trim(F.col("h")["last-modified"]), F.trim(F.col("r_h")["last-modified"])
    by = (F.when(etag.isNotNull() & r_etag.isNotNull(), "etag")
          .when(mod.isNotNull() & r_mod.isNotNull(), "last-modified")
          .when(F.col("digest").isNotNull() & F.col("r_digest").isNotNull(), "digest"))
    same = (F.when(by == "etag", etag == r_etag).when(by == "last-modified", mod == r_mod)
            .when(by == "digest", F.col("digest") == F.col("r_digest")))
    status = (F.when(F.col("response_id").isNull(), "no_earlier_response").when(by.isNull(), "no_validator")
              .when(same, "resolved").otherwise("validator_mismatch"))
    allowed = F.map_filter("h", lambda k, v: ~k.isin(*FORBIDDEN))
    kept = F.map_filter("r_h", lambda k, v: ~F.map_contains_key(allowed, k))
    merged = F.when(status == "resolved", F.map_concat(kept, allowed)).otherwise(F.col("h"))
    lines = F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))))
    return [status.alias("status"), F.when(F.col("response_id").isNotNull(), by).alias("matched_by"),
            F.array_join(lines, "\n").alias("headers")]


def with_payload(resolved: DataFrame, records: DataFrame, payload: str = "payload") -> DataFrame:
    """Resolved revisits with the payload of their response (null where unresolved)."""
    bodies = records.filter("kind = 'response'").select(
        F.col("record_id").alias("response_id"), F.col(payload).alias("payload")).dropDuplicates(["response_id"])
    hit = resolved.withColumn("__id", F.when(F.col("status") == "resolved", F.col("response_id")))
    return hit.join(bodies.withColumnRenamed("response_id", "__id"), "__id", "left").drop("__id")


# ---- records from the test table ---------------------------------------------------------

DAY = 86_400


def _number(text: Column) -> Column:
    """A 28-bit number from the text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def captures_of(pages: DataFrame) -> DataFrame:
    """Two records for every page: a capture, and a later not-modified answer for the same URL.

    The URL is that of the page's section (without the final number, query and fragment), so
    a section's pages are versions of its front page, and a large host's sections are hot.

    Times, entity tags and dates come from the page itself: the capture's second from the
    md5 of its id, its entity tag from its html's digest. The revisit, up to three days
    later, repeats the tag; where another version of the URL was captured in between, the
    validators disagree. Pages whose tag hash begins with 0 to 3 send Last-Modified only.
    """
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    t = _number(F.concat(F.lit("t"), page)) % (90 * DAY)
    digest = F.md5(F.coalesce("html", F.lit("")))
    gap = _number(F.concat(F.lit("g"), page)) % (3 * DAY) + 1
    dated = F.substring(digest, 1, 1) < F.lit("4")
    length = F.length(F.coalesce("html", F.lit(""))).cast("string")
    modified = F.concat(F.lit("day "), F.floor(t / DAY).cast("string"))
    section = F.regexp_replace("url", r"[0-9]+([?#].*)?$", "")
    base = pages.select("page_id", section.alias("url"), t.alias("t"), gap.alias("gap"), digest.alias("digest"), dated.alias("dated"),
                        length.alias("length"), modified.alias("modified"))

    def tagged(h: Column, prefix: str) -> Column:
        tag = F.create_map(F.lit("ETag"), F.concat(F.lit(prefix + '"'), F.substring("digest", 1, 16), F.lit('"')))
        date = F.create_map(F.lit("Last-Modified"), F.col("modified"))
        return F.when(F.col("dated"), F.map_concat(h, date)).otherwise(F.map_concat(h, tag))

    answer = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("length"),
        F.lit("Date"), F.col("t").cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"))
    again = F.create_map(
        F.lit("Date"), (F.col("t") + F.col("gap")).cast("string"), F.lit("Cache-Control"), F.lit("max-age=600"),
        F.lit("Content-Length"), F.lit("0"), F.lit("Age"), F.col("gap").cast("string"))
    responses = base.select(
        (F.col("page_id") * 2).cast("long").alias("record_id"), F.lit("response").alias("kind"), "url",
        F.col("t").alias("ts"), tagged(answer, "").alias("headers"), "digest")
    revisits = base.select(
        (F.col("page_id") * 2 + 1).cast("long").alias("record_id"), F.lit("revisit").alias("kind"), "url",
        (F.col("t") + F.col("gap")).alias("ts"), tagged(again, "W/").alias("headers"), F.lit(None).cast("string").alias("digest"))
    return responses.unionByName(revisits)


REVISIT_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(page_id::VARCHAR, '') AS id, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS len,
         regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(coalesce(url, ''), '[0-9]+([?#].*)?$', '')), '#.*$', ''),
           '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^[^/?@]*@', '') AS bare
  FROM pages),
q AS (
  SELECT *, regexp_replace(bare, '^[^/?]*', '') AS rest,
         ('0x' || substr(md5('t' || id), 1, 7))::BIGINT % 7776000 AS t,
         ('0x' || substr(md5('g' || id), 1, 7))::BIGINT % 259200 + 1 AS gap
  FROM p),
u AS (
  SELECT *, list_sort([x for x in string_split(regexp_replace(regexp_extract(rest, '\?.*$'), '^\?', ''), '&') if x <> '']) AS parts
  FROM q),
k AS (
  SELECT page_id, digest, len, t, gap, digest[1] < '4' AS dated,
         regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.|:(80|443)$', '', 'g')
         || regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '')
         || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END AS url_key,
         CASE WHEN dated THEN 'last-modified: day ' || (t // 86400)::VARCHAR
              ELSE 'etag: W/"' || substr(digest, 1, 16) || '"' END AS validator
  FROM u),
j AS (
  SELECT r.*, f.page_id * 2 AS response_id, f.t AS response_ts, f.dated AS f_dated, f.digest AS f_digest, f.len AS f_len,
         row_number() OVER (PARTITION BY r.page_id ORDER BY f.t DESC NULLS LAST, f.page_id DESC) AS n
  FROM k r LEFT JOIN k f ON f.url_key = r.url_key AND f.t < r.t + r.gap),
s AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier_response' WHEN dated <> f_dated THEN 'no_validator'
                 WHEN dated AND t // 86400 = response_ts // 86400 THEN 'resolved'
                 WHEN NOT dated AND substr(digest, 1, 16) = substr(f_digest, 1, 16) THEN 'resolved'
                 ELSE 'validator_mismatch' END AS status
  FROM j WHERE n = 1)
SELECT page_id * 2 + 1 AS record_id, url_key, t + gap AS ts, response_id, response_ts, status,
       CASE WHEN response_id IS NULL OR dated <> f_dated THEN NULL WHEN dated THEN 'last-modified' ELSE 'etag' END AS matched_by,
       'age: ' || gap::VARCHAR || chr(10) || 'cache-control: max-age=600' || chr(10)
       || CASE WHEN status = 'resolved' THEN 'content-length: ' || f_len::VARCHAR || chr(10) || 'content-type: text/html'
               ELSE 'content-length: 0' END || chr(10)
       || 'date: ' || (t + gap)::VARCHAR || chr(10) || validator AS headers
FROM s
"""
