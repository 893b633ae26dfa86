import random
import re

import pytest
from pyspark.sql import functions as F

from roadstate.llm import url_filter
from roadstate.llm.queries import URL_RULES
from roadstate.llm.url_filter import judge

from llm_fixtures import pages_of  # noqa: F401


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for kind, rule in URL_RULES:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, kind))
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


URLS = [
    "http://A.Example.NET/en/1", "https://example.net/fr/x", "http://net/", "http://net", "http://notexample.net/en/",
    "http://www.example.com/de/?a=b&c=d#e", "http://example.com/de", "http://w.org/fr/9", "ftp://org/fr/", "nothing", "", None,
    "http://?q", "http://#f", "://example.net/en/", "http://a.example.net/en/?x://y", "http://É.example.com/de/ü", "http://h/\n/x",
    "http://spam-" + "z" * 20_000 + ".example.org/en/1",
]


def test_rules_equal_brute_force(spark, pages_of):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (3, URLS[3], "x")]
    got = judge(pages_of(rows), URL_RULES).collect()
    assert len(got) == len(rows)
    by_id = {i: u for i, u, _ in rows}
    for r in got:
        host, path, rule, verdict = brute(by_id[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")


@pytest.mark.parametrize("urls, verdict", [(["http://x.example/"], "allow"), (["http://a.net/", "http://x.example/"], "block")])
def test_one_kind_of_label(spark, pages_of, urls, verdict):
    got = judge(pages_of([(i, u, "") for i, u in enumerate(urls)]), URL_RULES).collect()
    assert {r.verdict for r in got} == {verdict}


def test_trees_learn_from_given_labels(spark, pages_of):
    good = [f"https://site{i}.example/docs/page" for i in range(150)]
    bad = [f"http://x-{i}-{i * 7919 % 1000}-9.example/?a={i}&b={i}&c=1" for i in range(150)]
    labels = spark.createDataFrame([(u, 0) for u in good[:100]] + [(u, 1) for u in bad[:100]], "url string, block int")
    rows = [(i, u, "") for i, u in enumerate(good[100:] + bad[100:])]
    got = {r.page_id: r.verdict for r in judge(pages_of(rows), [], labelled=labels).collect()}
    right = sum((got[i] == "block") == (i >= 50) for i in got)
    assert right >= 95


def test_empty_table(spark, pages_of):
    assert judge(pages_of([(1, "http://a/", "")]).where("false"), URL_RULES).count() == 0


def test_a_label_is_not_among_its_own_features(spark):
    """Labels drawn by chance on hosts of their own: the rates must tell nothing about them."""
    rng = random.Random(4)
    rows = [(f"http://w{i}.host{i}/page", float(rng.random() < 0.5)) for i in range(600)]
    found = url_filter.held_out(spark.createDataFrame(rows, "url string, label double")).collect()
    right = sum(r.n for r in found if r.label == r.predicted) / sum(r.n for r in found)
    assert 0.3 < right < 0.7
    marked = url_filter.labelled_urls(spark.createDataFrame(rows, "url string, label double"))
    outside = url_filter.outside_rates(marked, "suffix", 0.5).collect()
    assert {r.suffix_rate for r in outside} == {0.5} and {r.suffix_n for r in outside} == {0}


def test_outside_rates_by_hand(spark):
    rows = [(f"http://x{i}.{'abc'[i % 3]}/", float(i % 2)) for i in range(90)] * 2
    marked = url_filter.labelled_urls(spark.createDataFrame(rows, "url string, label double")).cache()
    by_hand = marked.collect()
    for r in url_filter.outside_rates(marked, "suffix", 0.25).collect():
        others = [x for x in by_hand if x.suffix == r.suffix and x.fold != r.fold]
        n = sum(x.weight for x in others)
        assert r.suffix_n == n and abs(r.suffix_rate - (sum(x.weight * x.label for x in others) + 1.25) / (n + 5)) < 1e-12


def test_a_url_with_most_rows_is_one_row_of_the_fit(spark, pages_of):
    hot = "http://hot.example/?a=1"
    good = [f"https://site{i}.example/docs/page" for i in range(100)]
    bad = [f"http://x-{i}-{i * 7919 % 1000}-9.example/?a={i}&b={i}&c=1" for i in range(100)]
    labels = [(u, 0) for u in good] + [(u, 1) for u in bad] + [(hot, 1)] * 400
    known = spark.createDataFrame(labels, "url string, block int")
    marked = url_filter.labelled_urls(known.select("url", F.col("block").cast("double").alias("label")))
    assert marked.count() == 201 and marked.where(F.col("url") == hot).first().weight == 400
    rows = [(i, u, "") for i, u in enumerate([hot, *good[:20]])]
    got = {r.page_id: r.verdict for r in judge(pages_of(rows), [], labelled=known, sample_rows=150).collect()}
    assert got[0] == "block" and sum(v == "allow" for i, v in got.items() if i) >= 18


def test_columns_with_names_of_the_operator(spark):
    rows = [(i, f"http://a{i}.net/", "h", "r", 1.0, 2) for i in range(3)]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, row_id string, score double, suffix_n int")
    got = judge(table, URL_RULES).collect()
    assert {(r.page_id, r.host, r.verdict) for r in got} == {(i, f"a{i}.net", "block") for i in range(3)}
