import pytest
from pyspark.sql import functions as F

from stratalex.plans import audit
from stratalex.policies import WebPolicy
from stratalex.sources import connector


def test_token_bucket():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(round(s, 6))
        now[0] += s

    bucket = connector.TokenBucket(2.0, 2, clock=lambda: now[0], sleep=sleep)
    for _ in range(4):
        bucket.take()
    assert waits == [0.5, 0.5]
    now[0] += 10
    bucket.take()
    assert len(waits) == 2
    with pytest.raises(ValueError):
        connector.TokenBucket(0, 1)


def test_pauses_double_and_stop_growing():
    assert connector.pauses(1, 5, 5) == [1, 2, 4, 5] and connector.pauses(1, 5, 1) == []


def test_fetcher(spark):
    def client(url):
        if url.endswith("down"):
            raise OSError("no route")
        if url.endswith("error"):
            return 503, "text/html", b"", url
        if url.endswith("none"):
            return 404, "text/html", b"", url
        if url.endswith("big"):
            return 200, "text/html", b"x" * (2 << 20), url
        return 200, "text/html; charset=ISO-8859-1", "café".encode("latin-1"), url

    urls = spark.createDataFrame([(f"http://a/{x}",) for x in ("ok", "down", "error", "none", "big")], "url string")
    got = connector.fetcher(client, WebPolicy(max_content_mb=1), rate=1000, attempts=2, sleep=lambda s: None)(urls)
    rows = {r["url"][9:]: r for r in got.collect()}
    assert rows["ok"]["error"] is None and rows["down"]["attempts"] == 2 and "no route" in rows["down"]["error"]
    assert rows["error"]["error"] == "status 503" and rows["none"]["error"] == "status 404" and rows["big"]["error"] == "content_budget"
    assert [tuple(r) for r in connector.as_pages(got).select("url", "html").collect()] == [("http://a/ok", "café")]


@pytest.mark.parametrize(("body", "kind"), [("hé".encode(), "text/html"), ("hé".encode("latin-1"), "text/html"), ("hé".encode("latin-1"), 'text/html; charset="latin-1"'), ("hé".encode("utf-16"), "text/html; charset=utf-16")])
def test_decoding(spark, body, kind):
    df = spark.createDataFrame([(bytearray(body), kind)], "body binary, kind string")
    assert df.select(connector.decoded(F.col("body"), F.col("kind"))).first()[0] == "hé"


def test_audit(spark):
    stages = [("double", lambda df: df.select((F.col("id") * 2).alias("id")), {"small": F.col("id") < 6}), ("all", lambda df: df, {})]
    told = audit.run(spark.range(100), stages, limit=5, order="id", baseline={"double": 0.0})
    assert told["quality"] == {"double": {"<rows>": 5, "small": 2}, "all": {"<rows>": 5}} and told["recommendations"]["double"] == ["small: 2 of 5 rows"]
    assert [t["stage"] for t in told["timing"]] == ["double", "all"] and "double" in told["deltas"]
    with pytest.raises(ValueError):
        audit.run(spark.range(1), [], limit=0)
