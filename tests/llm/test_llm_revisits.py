import random

import pytest
from medallion.llm.revisits import canonical_url, merged_headers, resolve_revisits
from pyspark.sql import functions as F

SCHEMA = (
    "record_id long, url string, ts long, is_revisit boolean, etag string, last_modified string, "
    "payload_digest string, headers map<string,string>"
)


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTP://User@WWW.Example.com:80/a/B/?utm_source=x&b=2&a=1#top", "example.com/a/B?a=1&b=2"),
        ("https://example.com/", "example.com"),
        ("https://example.com:8080?ref=1", "example.com:8080"),
        ("not a url", "not a url"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "u string")
    assert frame.select(canonical_url(F.col("u"))).first()[0] == expected


def test_only_permitted_headers_are_merged(spark):
    stored, update = {"Date": "1", "ETag": "a", "Content-Type": "t"}, {"date": "2", "Content-Length": "0", "Vary": "x"}
    row = spark.createDataFrame([(stored, update)], "s map<string,string>, u map<string,string>")
    assert row.select(merged_headers(F.col("s"), F.col("u"))).first()[0] == {
        "date": "2", "ETag": "a", "Content-Type": "t", "Vary": "x"
    }
    assert row.select(merged_headers(F.lit(None).cast("map<string,string>"), F.col("u"))).first()[0] == {
        "date": "2", "Vary": "x"
    }


def brute(rows):
    out = {}
    for r in rows:
        if not r[3]:
            continue
        fulls = [f for f in rows if not f[3] and f[1] == r[1] and r[1] is not None and None not in (f[2], r[2]) and f[2] < r[2]]
        if not fulls:
            out[r[0]] = (None, "no_earlier_response")
            continue
        f = max(fulls, key=lambda f: (f[2], f[0]))
        for k in (4, 5):
            if r[k] is not None and f[k] is not None:
                same = r[k] == f[k]
                break
        else:
            same = r[6] is not None and r[6] == f[6]
        out[r[0]] = (f[0], "resolved" if same else "validator_mismatch")
    return out


@pytest.mark.parametrize("bucket", [1, 50, 10_000])
def test_revisits_by_brute_force(spark, bucket):
    random.seed(1)
    rows = [
        (
            k,
            random.choice(["h/a", "h/a", "h/a", "h/b", None]),
            random.choice([*range(0, 400, 4), None]),
            random.random() < 0.5,
            random.choice(["e1", "e2", None]),
            random.choice(["m1", "m2", None]),
            random.choice(["d1", "d2", None]),
            random.choice([{"Date": str(k)}, None]),
        )
        for k in range(300)
    ]
    found = resolve_revisits(spark.createDataFrame(rows, SCHEMA).withColumn("bucket", F.lit("x")), bucket).collect()
    assert {r.record_id: (r.refers_to, r.outcome) for r in found} == brute(rows)
    assert len(found) == sum(r[3] for r in rows)
    assert all((r.headers is not None) == (r.outcome == "resolved") for r in found)


def test_no_captures(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
