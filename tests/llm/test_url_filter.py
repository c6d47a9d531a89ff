import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.llm import url_filter as U
from ludica.llm.queries import op7_url_filter

ODD = [None, "", "nothing", "http://", "HTTP://EXAMPLE.ORG", "http://Example.org/en/1", "https://a.example.org/es/", "x://org/", "x://org",
       "http://notexample.org/es/x", "http://exampleXorg/es/", "http://a.com/fr/1?x=/de/", "http://com/de/#y", "http://a.b.com/de", "ftp://h?q#f",
       "http://one://two.org/x", "http://É.com/fr/", "http://a.com/en/1\n2", "http://casino-win.example.net/en/3", "http://garden.example.net/en/3"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [(h + p, says) for h, p, says in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def probability(model, host, path):
    z = model.bias
    for text, salt in ((f"<{host}>", 1), (f"<{path}>" if path else "", 2)):
        z += sum(model.weights[b] for b in U.hashed_ngrams([text], U.NGRAMS, U.BUCKETS, salt=salt)[1])
    return 1 / (1 + math.exp(-z))


def judged(model, urls):
    out = []
    for k, url in urls:
        host, path = split(url)
        name, says = rule(host, path)
        out.append((k, host, path, name, says or ("block" if probability(model, host, path) >= 0.5 else "allow")))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def model(spark):
    return U.train(spark.createDataFrame(U.LABELLED, "url string, label int"))


def test_odd_urls(spark, model):
    pages = spark.createDataFrame(list(enumerate(ODD)) + [(3, ODD[5]), (None, ODD[6])], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = U.filter_urls(pages, model).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == judged(model, list(enumerate(ODD)) + [(3, ODD[5]), (None, ODD[6])])
    assert U.filter_urls(pages.limit(0), model).collect() == []


def test_query(spark, model):
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").collect()]
    assert sorted(str(tuple(r)[:5]) for r in op7_url_filter(spark, "/root/testdata/sf0.001").collect()) == judged(model, pages)


def test_training_separates_unseen_urls(model):
    p = model.probability(["cheap-pills.example.org", "www.casino-win.example.com", "m.therou.example.net", "blog.theres.example.com"],
                          ["/en/9", "/es/8", "/en/25", "/es/575"])
    assert (p[:2] > 0.5).all() and (p[2:] < 0.5).all()


def test_one_sided_labels_allow(spark):
    m = U.train(spark.createDataFrame([("http://a.net/", 1), (None, 0), ("http://b.net/", None)], "url string, label int"))
    assert (m.probability(["a.net"], ["/"]) < 0.5).all()
    assert np.isfinite(m.weights).all()


# None of these hosts is in the labelled table, and neither are the bad stems of the test pages.
STEMS = ("cheap-pills", "casino-win", "free-bets", "adult-x", "spam-farm", "ads-track")
HELD_BAD = ["mypharmacy.example.com", "bestcasino.example.net", "www.adult-films.example.org", "bets4u.example.com",
            "spam-mails.example.net", "m.ads-tracker.example.org", "poker-room.example.com", "payday-cash.example.net"]
HELD_GOOD = ["gardencentre.example.com", "www.newsroom.example.net", "citylibrary.example.org", "blog.mathematics.example.com",
             "museums.example.net", "m.weatherstation.example.org", "www.schools.example.com", "cookbook.example.net"]
BAD_PATHS = ["/casino/free-bets", "/en/online-casino.html", "/shop/cheap-pills/9", "/adult/live-cams", "/spam/farm.html",
             "/ads/track.php", "/poker/bonus", "/payday-loans"]
GOOD_PATHS = ["/articles/garden", "/docs/library.html", "/news/weather/9", "/recipes/cakes", "/travel/france", "/science/history",
              "/en/12", "/about/team"]


def test_labelled_table_is_apart_from_the_pages(spark):
    hosts = {split(url)[0] for url, _ in U.LABELLED}
    pages = {split(r["url"])[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()}
    assert not hosts & (pages | set(HELD_BAD + HELD_GOOD))
    assert not [u for u, _ in U.LABELLED if any(s in u for s in STEMS)]
    assert not {split(u)[1] for u, _ in U.LABELLED} & set(BAD_PATHS)


def test_held_out_hosts(model):
    assert (model.probability(HELD_BAD, ["/en/9"] * 8) >= 0.5).sum() >= 5
    assert (model.probability(HELD_GOOD, ["/en/9"] * 8) < 0.5).all()
    assert (model.probability([f"{s}.example.net" for s in STEMS], ["/en/9"] * 6) >= 0.5).all()


def test_a_path_alone_decides(model):
    for host in ("neutral.example.net", "www.example.com"):
        assert (model.probability([host] * 8, BAD_PATHS) >= 0.5).all()
        assert (model.probability([host] * 8, GOOD_PATHS) < 0.5).all()
