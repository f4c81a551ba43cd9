"""Not-modified revisits: each is given the latest earlier full response of its canonical URL.

A record table has one row a WARC record: ``record_id`` (long), ``warc_type`` ('response' or
'revisit'), ``url``, ``date`` (timestamp), ``status`` (int), ``etag``, ``last_modified``, ``digest`` (of
the payload) and ``headers`` (map of lower-case names). A full response is a 'response' with status 200.

The as-of join sorts all records by (URL, date) into ranges, once. Inside a range a running window
carries the last full response along; what a URL carries into a range from earlier ones is a running window
over one row per URL and range. So a URL with a third of all records is as many windows as it has
ranges, and no join pairs its records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import lower_ascii, partitions, written

# Fields that a 304 response may bring up to date, and query parameters that name no content.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid|sid|phpsessid|jsessionid"
EMPTY_MAP = "map<string,string>"


def canonical_url(url: Column) -> Column:
    """One key for the spellings of a URL: scheme, ``www.``, default port, user, fragment, tracking
    parameters, parameter order and a last slash do not count, nor does case in the host. Without ``://`` the text
    itself, trimmed, is the key; null stays null."""
    text = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(text, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = lower_ascii(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*(/[^?]*)?", 1), "/+$", "")
    query = F.regexp_extract(rest, "[?](.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(f"^({TRACKING})(=|$)")))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(text.contains("://"), F.concat(host, path, query)).otherwise(F.trim(url))


def _weak(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit with what it refers to.

    Columns: ``record_id, url_key, date, refers_to, refers_to_date, outcome, digest, headers``. ``outcome``:

    * ``no_earlier``: no full response of the URL is strictly earlier; records of the same instant are not;
    * ``mismatch``: the latest earlier one has other validators. Entity tags are compared weakly if both
      have one; else last-modified dates; else payload digests;
    * ``unchecked``: neither pair of validators is there to compare; nothing is merged;
    * ``resolved``: validators agree; ``digest`` is the response's, and ``headers`` are the response's with the
      permitted fields of the revisit in their place.

    Of responses of one instant the one with the largest ``record_id`` counts. A revisit without a URL or date is
    ``no_earlier``; responses without one, or with another status, are never referred to. Null headers
    are empty. Repeated rows are each resolved. Extra columns are ignored; empty in, empty out.
    """
    spark = records.sparkSession
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), "warc_type", canonical_url(F.col("url")).alias("url_key"), "date",
        F.col("status").cast("int").alias("status"), "etag", "last_modified", "digest",
        F.coalesce(F.col("headers").cast(EMPTY_MAP), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("headers"),
    )
    known = F.col("url_key").isNotNull() & F.col("date").isNotNull()
    full = known & (F.col("warc_type") == "response") & (F.col("status") == 200)
    rows = rows.where((F.col("warc_type") == "revisit") | full).withColumn("is_full", F.coalesce(full, F.lit(False)))
    # at one instant revisits come before responses, so a response is always strictly earlier
    order = ("url_key", "date", "is_full", "record_id")
    dealt = rows.repartitionByRange(partitions(spark), *order).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, "captures")

    response = F.when(F.col("is_full"), F.struct("record_id", "date", "etag", "last_modified", "digest", "headers"))
    inside = Window.partitionBy("range", "url_key").orderBy("date", "is_full", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    near = dealt.withColumn("response", response).withColumn("near", F.last("response", ignorenulls=True).over(inside))
    # maps can't be compared, so the latest response of a range is picked by its order alone
    latest = dealt.groupBy("url_key", "range").agg(
        F.max_by(response, F.when(F.col("is_full"), F.struct("date", "record_id"))).alias("response")
    )
    before = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("url_key", "range", F.last("response", ignorenulls=True).over(before).alias("far")).where("far is not null")
    revisits = near.where("not is_full").join(carried, ["url_key", "range"], "left")
    base = F.coalesce("near", "far")

    revisits = revisits.withColumn("base", F.when(known, base))
    tags = F.col("etag").isNotNull() & F.col("base.etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("base.last_modified").isNotNull()
    digests = F.col("digest").isNotNull() & F.col("base.digest").isNotNull()
    agree = (
        F.when(tags, _weak(F.col("etag")) == _weak(F.col("base.etag")))
        .when(dates, F.trim("last_modified") == F.trim("base.last_modified"))
        .when(digests, F.col("digest") == F.col("base.digest"))
    )
    outcome = (
        F.when(F.col("base").isNull(), "no_earlier").when(agree.isNull(), "unchecked").when(agree, "resolved").otherwise("mismatch")
    )
    fresh = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    merged = F.map_concat(F.map_filter("base.headers", lambda k, v: ~F.map_contains_key(fresh, k)), fresh)
    out = revisits.withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    return out.select(
        "record_id", "url_key", "date", F.col("base.record_id").alias("refers_to"), F.col("base.date").alias("refers_to_date"),
        "outcome", F.when(done, F.col("base.digest")).alias("digest"), F.when(done, merged).alias("headers"),
    )
