from __future__ import annotations

import gzip
import hashlib
import io
import itertools
import json
import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from landfall.llm import urls, warc
from landfall.llm.common import scratch
from tests.conftest import SF001

PAGES = [(1, "http://a.b/1", "x" * 200), (2, "http://a.b/2\r\nX: y", "x" * 200), (3, None, None), (4, "u", ""), (5, "http://é.org/", "é" * 60), (6, "u6", "short"), (7, "u7", "short"),
         (8, "u8", "a\r\n\r\nb" * 50), (None, "n", "x" * 200), (None, "m", "y" * 300), (8, "u8", "a\r\n\r\nb" * 50), (9, "u9", "z" * 3_000_000)]


def local(path):
    return Path(re.sub("^file:/*", "/", path))


def test_archives(spark):
    pages = spark.createDataFrame([(*r, "x", "y") for r in PAGES], "page_id long, url string, html string, digest string, bytes string").repartition(3)
    source, target = scratch(spark, "t"), scratch(spark, "t")
    warc.write_archives(pages, source)
    for f in local(source).glob("*.gz"):   # one stream from end to end
        d = zlib.decompressobj(31)
        d.decompress(f.read_bytes())
        assert d.eof and not d.unused_data
    index = warc.normalise(spark, source, target)
    for f in local(target).glob("*.warc.gz"):
        raw = f.read_bytes()
        listed = [json.loads(x) for x in Path(f"{f}.cdxj").read_text().splitlines()]
        assert sum(x["length"] for x in listed) == len(raw)
        for x in listed:
            assert gzip.decompress(raw[x["offset"]:x["offset"] + x["length"]]).startswith(b"WARC/1.1\r\n")
        assert b"".join(gzip.decompress(raw[x["offset"]:x["offset"] + x["length"]]) for x in listed) == gzip.decompress(raw)
    got = warc.read_records(index, target).collect()
    assert len(got) == len(PAGES)
    kinds = {}
    for r in got:
        kinds.setdefault(r["page_id"], set()).add((r["record_type"], r["refers_to"], r["payload_bytes"]))
        if r["record_type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
    assert kinds["1"] == {("response", None, 200)} and kinds["2"] == {("revisit", "1", 200)} and kinds["8"] == {("response", None, 300)}
    assert kinds[None] == {("revisit", "1", 200), ("response", None, 300)} and kinds["6"] == kinds["7"] == {("response", None, 5)}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    source, target = scratch(spark, "t"), scratch(spark, "t")
    warc.write_archives(pages, source)
    assert warc.read_records(warc.normalise(spark, source, target), target).collect() == []


def test_streams_of_several_members_and_broken_ones():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for raw in (gzip.compress(record * 3), gzip.compress(record) + gzip.compress(record * 2)):
        got = list(warc.split_records(warc.inflate(io.BytesIO(raw))))
        assert [b for _, b in got] == [record] * 3
    for bad in (record[:-6], record[:20], b"nonsense\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.split_records(iter([bad])))
    small = (bytes([b]) for b in record * 2)   # steps of one byte
    assert len(list(warc.split_records(small))) == 2


def test_archives_larger_than_spark_reads_whole(spark):
    """Files over the limit of whole-file reads, and streams of many buffers."""
    r = random.Random(4)
    noise = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=900_000)) for _ in range(5)]   # hardly compresses
    pages = spark.createDataFrame(list(enumerate(noise)), "page_id long, html string").selectExpr("page_id", "'u' AS url", "html").coalesce(1)
    source, target = scratch(spark, "t"), scratch(spark, "t")
    warc.write_archives(pages, source)
    assert max(f.stat().st_size for f in local(source).glob("*.gz")) > 2 * warc.STEP
    old = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    try:
        got = {x["page_id"]: x["payload"].decode() for x in warc.read_records(warc.normalise(spark, source, target), target).collect()}
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", old)
    assert got == {str(i): t for i, t in enumerate(noise)}


def test_page_ids_of_any_text(spark):
    ids = ["a\r\nWARC-Type: revisit", " spaced ", "a+b%20c", "é漢", "a|b", "\r\n\r\n", ""]
    pages = spark.createDataFrame([(i, "u", "same payload " * 20) for i in ids], "page_id string, url string, html string")
    source, target = scratch(spark, "t"), scratch(spark, "t")
    warc.write_archives(pages, source)
    got = warc.read_records(warc.normalise(spark, source, target), target).collect()
    assert {x["page_id"]: x["refers_to"] for x in got} == {i: None if i == min(ids) else min(ids) for i in ids}


# ------------------------------------------------------------ urls

def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


ODD = [None, "", "abc", "http://", "HTTP://WWW.Example.ORG/EN/1", "http://example.org/en/12?x#y", "http://x.example.org/es/", "https://example.org", "http://notexample.org/es/",
       "http://É.com/de/ü", "http://a.com?b/c", "http://a.com#/d", "x://y://z/", "http://com/fr/", "http://a.com/fr/\nq", "http://a.com/de/1"]


def test_hosts_paths_and_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD)], "page_id long, url string, rule string")
    got = {r["page_id"]: r for r in urls.judge(pages, pages.select("url", F.lit(False).alias("blocked"))).collect()}
    for i, u in enumerate(ODD):
        host, path = plain(u)
        fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
        want = max(fits)[2:] if fits else (None, "allow")
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, *want), u


def labelled(spark, n=900):
    rows = [(f"https://{'spam' if i % 3 == 0 else 'fine'}.site{i % 7}.net/{'buy' if i % 5 < 2 else 'read'}/{i}.html?id={i}", i % 3 == 0 and i % 5 < 2) for i in range(n)]
    return spark.createDataFrame(rows, "url string, blocked boolean")


def test_mined_rules_against_brute_force(spark):
    rows = labelled(spark)
    sets = [(frozenset(r["t"]), r["blocked"]) for r in rows.select(urls.tokens(F.col("url")).alias("t"), "blocked").collect()]
    rules = {frozenset(r["antecedent"]): r for r in urls.mine(rows, min_support=0.05).collect()}
    assert frozenset({"host=spam", "path=buy"}) in rules
    for antecedent, r in rules.items():
        held = [b for t, b in sets if antecedent <= t]
        assert abs(r["confidence"] - sum(held) / len(held)) < 1e-9 and r["confidence"] >= urls.MIN_CONFIDENCE
        assert abs(r["support"] - sum(held) / len(sets)) < 1e-9 and r["item"] in antecedent
    judged = urls.judge(rows.select(F.xxhash64("url").alias("page_id"), "url"), rows, min_support=0.05)
    want = {r["k"]: any(a <= frozenset(r["t"]) for a in rules) for r in rows.select(F.xxhash64("url").alias("k"), urls.tokens(F.col("url")).alias("t")).collect()}
    assert {r["page_id"]: r["verdict"] == "block" for r in judged.collect()} == want and any(want.values()) and not all(want.values())


def test_no_rule_is_missing(spark):
    """All combinations of tokens of the blocked urls, counted one by one."""
    r = random.Random(8)
    rows = [(f"http{'s' if r.random() < 0.5 else ''}://{r.choice('abc')}.{r.choice(['x', 'y'])}.net/{r.choice(['p', 'q', 'r'])}/{r.choice(['', 'd', 'e.html'])}", None) for _ in range(600)]
    rows = [(u, ("//a." in u and "/p/" in u and r.random() < 0.95) or ("https://b" in u and ".y." in u) or r.random() < 0.05) for u, _ in rows]
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    sets = [(frozenset(x["t"]), x["blocked"]) for x in df.select(urls.tokens(F.col("url")).alias("t"), "blocked").collect()]
    held: dict = {}
    for t, b in sets:
        for k in range(1, len(t) + 1):
            for some in itertools.combinations(sorted(t), k):
                x = held.setdefault(some, [0, 0])
                x[0] += b
                x[1] += 1
    rules = {a: x[0] / x[1] for a, x in held.items() if x[0] >= urls.MIN_URLS and x[0] / x[1] >= urls.MIN_CONFIDENCE}
    less = lambda a: [rules[b] for k in range(len(a)) if (b := a[:k] + a[k + 1:]) in rules]
    want = {a: c for a, c in rules.items() if all(x < c for x in less(a))}
    got = {tuple(x["antecedent"]): x for x in urls.mine(df).collect()}
    assert {a: round(x["confidence"], 9) for a, x in got.items()} == {a: round(c, 9) for a, c in want.items()} and any(len(a) > 1 for a in want)
    assert all(x["item"] in a and round(x["support"] * len(sets)) == held[a][0] for a, x in got.items())


def test_null_and_hot_urls(spark):
    rows = labelled(spark)
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit("https://spam.site0.net/buy/1.html")).alias("url"))
    got = urls.judge(pages, rows)
    assert {(x["page_id"] % 2, x["host"], x["verdict"]) for x in got.collect()} == {(0, "", "allow"), (1, "spam.site0.net", "block")} and got.count() == 400


def test_rare_blocked_host_in_many_urls(spark):
    n = 50_000
    rare = F.col("id") % 2000 == 0   # 25 urls of 50,000
    name = F.when(rare, "rare").otherwise(F.concat(F.lit("h"), F.col("id") % 300))
    rows = spark.range(n).select(F.concat(F.lit("http://"), name, F.lit(".net/p"), F.col("id") % 7).alias("url"), (rare | (F.col("id") % 11 == 0)).alias("blocked"))
    rules = {tuple(r["antecedent"]): r for r in urls.mine(rows).collect()}
    assert set(rules) == {("host=rare",)}   # and not with tokens that add nothing
    assert rules["host=rare",]["confidence"] == 1.0 and round(rules["host=rare",]["support"] * n) == 25
    pages = spark.createDataFrame([(1, "http://rare.net/new"), (2, "http://h1.net/p1")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in urls.judge(pages, rows).collect()} == {1: "block", 2: "allow"}


def test_common_tokens_in_combination(spark):
    part = F.col("id") % 100   # host x: 8 of 100 urls are http and fine, 8 are https and blocked
    host, scheme = F.when(part < 16, "x").otherwise("y"), F.when(part < 8, "http").otherwise("https")
    rows = spark.range(2000).select(F.concat(scheme, F.lit("://"), host, F.lit(".net/")).alias("url"), part.between(8, 15).alias("blocked"))
    assert [r["antecedent"] for r in urls.mine(rows).collect()] == [["host=x", "scheme=https"]]


def test_tokens_of_every_url(spark):
    rows = spark.range(1000).select(F.concat(F.lit("http://h"), F.col("id") % 3, F.lit(".net/")).alias("url"), (F.col("id") % 10 > 0).alias("blocked"))
    rules = {tuple(r["antecedent"]): (r["confidence"], r["support"]) for r in urls.mine(rows).collect()}
    assert rules["top=net",] == rules["scheme=http",] == (0.9, 0.9)
    pages = spark.createDataFrame([(1, "http://new.org/"), (2, "https://new.org/")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in urls.judge(pages, rows, rules=()).collect()} == {1: "block", 2: "allow"}


@pytest.mark.parametrize("held, mined", [(19, False), (20, True)])
def test_floor_is_exact(spark, held, mined):
    rows = spark.range(21_977).select(F.concat(F.lit("http://"), F.when(F.col("id") < held, "x").otherwise("y"), F.lit(".net/")).alias("url"), (F.col("id") < held).alias("blocked"))
    assert [r["antecedent"] for r in urls.mine(rows).collect()] == ([["host=x"]] if mined else [])


def test_nothing_to_learn_from(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert urls.judge(pages, urls.labelled_urls(pages, labels)).collect() == []
    some = spark.createDataFrame([(1, "http://a.net/x", None), (1, "http://a.net/x", None)], "page_id long, url string, html string")
    assert [r["verdict"] for r in urls.judge(some, urls.labelled_urls(some, labels)).collect()] == ["allow", "allow"]


def test_no_python_on_executors(spark):
    from landfall.llm import queries

    for name in ("op4_bottom_k", "op10_url_filters"):
        plan = queries.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
