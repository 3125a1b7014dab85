import re

import pytest
from pyspark.sql import functions as F

from jornada.llm import url_filter as U

URLS = [
    "http://www.Example.ORG/es/1", "https://example.org/en/12", "http://example.org/fr", "http://x.com/fr/1",
    "http://x.com/de/", "http://com/fr/", "http://notorg.net/", "ftp://a.b.org", "http://org/", "no scheme", "", None,
    "http://h?q=/es/", "http://h#f", "x://y://z/p", "http://casino-slots.net/play?x", "HTTP://A.NET/Path#x", "://", "://org/",
    "http://library.net/books\nmore", "http://" + "a" * 5000 + ".net/" + "b" * 5000, "http://example.org/en/1",
]


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    best = None
    for said, rule in U.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[1]):
                best = said, rule
    return host, path, best


def test_rules_equal_a_plain_version(spark):
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], "h", "c")], "page_id long, url string, html string, host string")
    got = U.judge(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, best = plain(URLS[r["page_id"]] if r["page_id"] is not None else URLS[0])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == best[0] if best else r["verdict"] in ("allow", "block")
    by_id = {r["page_id"]: r for r in got}
    assert by_id[9]["verdict"] == by_id[10]["verdict"] == by_id[11]["verdict"] == "allow"


def test_unseen_urls_are_judged_by_their_parts(spark):
    bad = ["http://m.casino-fun.net/en/1", "https://adult-stream.net/x", "http://spam-links-farm.net/a", "http://free-bets-now.net/en/3",
           "http://xxx-videos.net/1", "http://www.cheap-pills-shop.net/"]
    good = ["http://www.gardenclub.net/en/1", "https://blog.thermal.net/de/7", "http://townhall.net/fr/55", "http://m.thernt.net/en/699/",
            "https://thrones.net/en/852", "http://poetry.net/es/1"]
    pages = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in U.judge(pages).collect()}
    assert [got[i] for i in range(len(bad))] == ["block"] * len(bad)
    assert [got[i + len(bad)] for i in range(len(good))] == ["allow"] * len(good)


def test_labels_are_learned(spark):
    labels = U.labelled(spark)
    model = U.train(labels)
    assert 0.05 < model.block_from < 0.95
    rows = labels.withColumnRenamed("label", "page_id").withColumn("page_id", F.col("page_id").cast("long"))
    judged = U.judge(rows, rules=(), model=model)
    told = {(r["page_id"], r["verdict"]): r["count"] for r in judged.groupBy("page_id", "verdict").count().collect()}
    assert told[1, "block"] > 0.97 * len(U.UNWANTED) and told[0, "allow"] > 0.97 * len(U.WANTED)


def test_any_labelled_table(spark):
    data = [(f"http://{'bad' if i % 3 == 0 else 'fine'}{i}.test/{i}", float(i % 3 == 0)) for i in range(90)]
    data += [(None, 1.0), ("http://odd.test", None), ("http://odd.test", 7.0)]
    model = U.train(spark.createDataFrame(data, "url string, label double"))
    pages = spark.createDataFrame([(1, "http://bad1000.test/"), (1, "http://fine1000.test/"), (1, "http://bad1000.test/")], "page_id long, url string")
    assert sorted(r["verdict"] for r in U.judge(pages, model=model).collect()) == ["allow", "block", "block"]


def test_threshold():
    assert U.best_threshold({(0.0, 10): 5, (0.0, 30): 1, (1.0, 50): 3, (1.0, 90): 1}, 100) == pytest.approx(0.405)
    assert U.best_threshold({(0.0, 10): 5}, 100) == U.best_threshold({}, 100) == 0.5


def test_no_label_is_named_after_a_page(spark):
    hosts = {r[0] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(U.host_and_path(F.col("url"))[0]).collect()}
    names = {h.rsplit(".example.", 1)[0].split(".")[-1] for h in hosts}
    labels = {u.split("://")[1].split("/")[0].removesuffix(".test").split(".")[-1] for u in (*U.UNWANTED, *U.WANTED)}
    assert not names & labels


def test_empty(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
