"""Web archive records: not-modified revisits are resolved to the full responses they stand for.

An as-of join by canonical url finds the latest earlier full response. It is done in two levels, so
that a url with a third of all records does not meet in one task: inside slices of time, and from the
last response of each slice to the slices after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE_S = 86_400
#: Fixed list: headers that a not-modified answer may update, in lower case.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Fixed pattern: query parameters that do not change what is fetched.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical(url: Column) -> Column:
    """One spelling of a url: no scheme, user, default port, fragment, "www." or "m.", final slash or
    ".html", tracking parameters; host in lower case, parameters sorted. Null stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#[\s\S]*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^[^/?]*", 0)
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^[^@]*@", ""), r":(80|443)?$", "")
    host = F.regexp_replace(host, r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"(/|/index\.html|\.html)$", "")
    query = F.regexp_extract(rest, r"\?([\s\S]*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    tail = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def _lower(headers: Column) -> Column:
    """Headers by lower-case name; values of names that differ in case alone are sorted and joined by
    commas, as the entries of a map have no order."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    values = lambda n: F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == n), lambda e: e["value"])
    return F.map_from_arrays(names, F.transform(names, lambda n: F.when(F.size(values(n)) == 1, F.get(values(n), F.lit(0))).otherwise(F.array_join(F.array_sort(values(n)), ", "))))


def resolve_revisits(records: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """One row for each revisit among records (record_id, url, ts, kind, etag, last_modified, digest,
    headers): record_id, canonical, ts, ref_id, outcome, headers.

    kind is "response" for a full response and "revisit" for a not-modified answer; other kinds are
    ignored. ref_id is the response of the same canonical url with the latest ts before the
    revisit's, of equal times that of the largest record_id. outcome is "unmatched" without one (also
    for a null url or ts); else the first validator that both have decides: etag (weak comparison),
    last_modified, digest give "resolved" or "mismatch"; without any it is "unverified". headers, a
    map with lower-case names, are the response's, with those that a not-modified answer may update
    taken from the revisit; null unless resolved or unverified. Rows may repeat, and each revisit row
    gives one row; other columns are ignored."""
    at = F.col("ts").cast("double")
    rows = records.where("kind in ('response', 'revisit')").select(
        canonical(F.col("url")).alias("canonical"), at.alias("at"), F.floor(at / slice_s).alias("slice"),
        (F.col("kind") == "revisit").alias("revisit"),
        F.struct("record_id", "ts", "etag", "last_modified", "digest", "headers").alias("rec"),
    )
    whole = F.col("canonical").isNotNull() & F.col("at").isNotNull()
    lost = rows.where(F.col("revisit") & ~whole).select("canonical", "rec", F.lit(None).cast(rows.schema["rec"].dataType).alias("ref"))
    rows = rows.where(whole)
    # at one time revisits come first, as only an earlier response counts
    order = [F.col("at"), F.when(F.col("revisit"), 0).otherwise(1), F.col("rec.record_id")]
    full = F.when(~F.col("revisit"), F.col("rec"))
    inside = Window.partitionBy("canonical", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.last(full, ignorenulls=True).over(inside)).where("revisit")
    ends = rows.groupBy("canonical", "slice").agg(F.max_by(F.when(~F.col("revisit"), F.col("rec")), F.when(~F.col("revisit"), F.struct("at", F.col("rec.record_id").alias("id")))).alias("end"))
    before = Window.partitionBy("canonical").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("canonical", "slice", F.last("end", ignorenulls=True).over(before).alias("far"))
    found = near.join(carried, ["canonical", "slice"], "left").select("canonical", "rec", F.coalesce("near", "far").alias("ref"))
    both = found.union(lost)
    checks = [
        (F.col("rec.etag").isNotNull() & F.col("ref.etag").isNotNull(), _weak(F.col("rec.etag")) == _weak(F.col("ref.etag"))),
        (F.col("rec.last_modified").isNotNull() & F.col("ref.last_modified").isNotNull(), F.col("rec.last_modified") == F.col("ref.last_modified")),
        (F.col("rec.digest").isNotNull() & F.col("ref.digest").isNotNull(), F.col("rec.digest") == F.col("ref.digest")),
    ]
    outcome = F.when(F.col("ref").isNull(), "unmatched")
    for have, same in checks:
        outcome = outcome.when(have, F.when(same, "resolved").otherwise("mismatch"))
    out = both.withColumn("outcome", outcome.otherwise("unverified"))
    new = F.map_filter(_lower(F.col("rec.headers")), lambda k, v: k.isin(*PERMITTED))
    old = F.map_filter(_lower(F.col("ref.headers")), lambda k, v: ~F.map_contains_key(F.col("_new"), k))
    out = out.withColumn("_new", new).withColumn("_old", old)
    merged = F.when(F.col("outcome").isin("resolved", "unverified"), F.map_concat("_old", "_new"))
    return out.select(
        F.col("rec.record_id").alias("record_id"), "canonical", F.col("rec.ts").alias("ts"),
        F.col("ref.record_id").alias("ref_id"), "outcome", merged.alias("headers"),
    )
