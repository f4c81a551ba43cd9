import datetime as dt

from tidegate.llm import warc_revisits as wr

SCHEMA = "record_id long, warc_type string, url string, date timestamp, status int, etag string, last_modified string, digest string, headers map<string,string>"


def at(hour):
    return None if hour is None else dt.datetime(2024, 1, 1, hour)


def records(spark, rows):
    return spark.createDataFrame([(i, kind, url, at(hour), status, etag, lm, digest, headers) for i, kind, url, hour, status, etag, lm, digest, headers in rows], SCHEMA)


def resolved(df):
    return {r.record_id: r for r in wr.resolve(df).collect()}


def test_canonical_urls(spark):
    same = ["http://www.Example.org:80/a/?b=2&a=1&utm_source=x#top", "https://example.org/a?a=1&b=2", "https://me@EXAMPLE.org/a/?ref=q&a=1&b=2"]
    rows = [(u,) for u in [*same, "https://example.org/A?a=1&b=2", " no scheme ", None, "https://example.org"]]
    got = [r.k for r in spark.createDataFrame(rows, "u string").select(wr.canonical_url(wr.F.col("u")).alias("k")).collect()]
    assert got == ["example.org/a?a=1&b=2"] * 3 + ["example.org/A?a=1&b=2", "no scheme", None, "example.org"]


def test_latest_earlier_response_validators_and_headers(spark):
    u = "https://example.org/x"
    rows = [
        (1, "response", u, 1, 200, '"a"', None, "d1", {"etag": '"a"', "content-type": "text/html", "cache-control": "old", "set-cookie": "s"}),
        (2, "response", u, 3, 200, '"b"', "monday", "d2", {"etag": '"b"', "content-type": "text/plain"}),
        (3, "response", u, 4, 404, None, None, "d3", None),
        (4, "revisit", u, 0, 304, '"a"', None, None, None),
        (5, "revisit", u, 2, 304, 'W/"a"', None, None, {"etag": 'W/"a"', "cache-control": "new", "content-type": "x", "set-cookie": "t"}),
        (6, "revisit", u, 5, 304, '"a"', None, None, None),
        (7, "revisit", u, 5, 304, None, "monday", None, None),
        (8, "revisit", u, 5, 304, None, None, "d2", None),
        (9, "revisit", u, 5, 304, None, None, None, None),
        (10, "revisit", u, 3, 304, '"a"', None, None, None),  # the response of this instant is not earlier
        (11, "revisit", "http://www.example.org/x/#f", 6, 304, '"b"', "tuesday", "other", None),
    ]
    got = resolved(records(spark, rows))
    assert {i: (r.refers_to, r.outcome) for i, r in got.items()} == {
        4: (None, "no_earlier"), 5: (1, "resolved"), 6: (2, "mismatch"), 7: (2, "resolved"), 8: (2, "resolved"),
        9: (2, "unchecked"), 10: (1, "resolved"), 11: (2, "resolved"),
    }
    assert got[5].headers == {"etag": 'W/"a"', "cache-control": "new", "content-type": "text/html", "set-cookie": "s"}
    assert got[5].digest == "d1" and got[6].headers is None and got[6].digest is None
    assert got[7].headers == {"etag": '"b"', "content-type": "text/plain"}


def test_a_url_over_many_ranges_agrees_with_brute_force(spark):
    rows = [(i, "response" if i % 37 == 0 else "revisit", "https://hot.example.org/" if i % 3 else f"https://e.org/{i % 50}", None, 200, None, None, "d", None) for i in range(900)]
    start = dt.datetime(2024, 1, 1)
    rows = [(i, k, u, start + dt.timedelta(minutes=(i * 577) % 300), *rest) for i, k, u, _, *rest in rows]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = {r.record_id: r.refers_to for r in wr.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    for i, kind, url, date, *_ in rows:
        if kind == "revisit":
            earlier = [(d, j) for j, k, u, d, *_ in rows if k == "response" and u == url and d < date]
            assert got[i] == (max(earlier)[1] if earlier else None)


def test_odd_rows(spark):
    u = "https://example.org/x"
    rows = [(1, "response", None, 1, 200, '"a"', None, "d", None), (2, "revisit", None, 2, 304, '"a"', None, "d", None),
            (3, "response", u, None, 200, '"a"', None, "d", None), (4, "revisit", u, None, 304, '"a"', None, "d", None),
            (5, "response", u, 1, 200, None, None, "d", None), (6, "response", u, 1, 200, None, None, "e", {"k": None}),
            (7, "revisit", u, 2, 304, None, None, "e", {"etag": None}), (7, "revisit", u, 2, 304, None, None, "e", {"etag": None}),
            (8, None, u, 3, 304, None, None, "e", None), (9, "revisit", u, 3, None, None, None, "e", None), (None, "revisit", u, 3, None, None, None, "d", None)]
    df = records(spark, rows).selectExpr("*", "1 as near", "2 as range", "'x' as base", "0 as url_key")
    got = wr.resolve(df).collect()
    assert sorted((str(r.record_id), str(r.refers_to), r.outcome) for r in got) == sorted([
        ("2", "None", "no_earlier"), ("4", "None", "no_earlier"), ("7", "6", "resolved"), ("7", "6", "resolved"), ("9", "6", "resolved"), ("None", "6", "mismatch")])
    assert wr.resolve(df.where("record_id < 0")).count() == 0
