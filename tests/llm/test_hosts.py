import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.llm import hosts
from fleetlens.llm.queries import URL_RULES, op9_hosts

SF = "/root/testdata/sf0.001"


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op9_hosts(spark, SF).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == plain(urls[r.page_id])
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aZ:/?#.É\n"), max_size=20)), min_size=1, max_size=30))
def test_parts_of_urls(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(hosts.host_of(F.col("url")).alias("h"), hosts.path_of(F.col("url")).alias("p"))
    assert [(r.h, r.p) for r in df.collect()] == [plain(u) for u in urls]


def judged(spark, outcomes, pages, **options):
    got = hosts.judge(spark.createDataFrame([(u,) for u in pages], "url string"),
                      spark.createDataFrame(outcomes, "url string, bad int"), (), **options)
    return {r.url: r for r in got.collect()}


def test_reputation_shrinks_to_domain_and_suffix(spark):
    bad = [(f"https://a{k}.bad.net/{i}", 1) for k in range(5) for i in range(20)]
    good = [(f"https://a{k}.good.net/{i}", 0) for k in range(5) for i in range(20)]
    mixed = [("https://one.good.net/x", 1)]
    pages = ["https://a1.bad.net/", "https://new.bad.net/", "https://a1.good.net/", "https://one.good.net/", "https://new.good.net/", "https://other.net/", "https://x.org/", None]
    got = judged(spark, bad + good + mixed, pages)
    verdicts = {u: r.verdict for u, r in got.items()}
    assert verdicts["https://a1.bad.net/"] == verdicts["https://new.bad.net/"] == "block"
    assert {verdicts[u] for u in pages if u and "good" in u} == {"allow"} and verdicts["https://x.org/"] == "allow"
    # One bad page of one: shrunk towards its domain, yet worse than its siblings.
    assert got["https://a1.good.net/"].bad_rate < got["https://one.good.net/"].bad_rate < 0.6
    assert got[None].host == "" and got[None].bad_rate == pytest.approx(101.5 / 202)
    more = judged(spark, bad + good + mixed, pages, most_bad=0.999)
    assert {r.verdict for r in more.values()} == {"allow"}


def test_suffixes(spark):
    rows = [("a.b.co.uk", "b.co.uk", "co.uk"), ("b.com", "b.com", "com"), ("localhost", "localhost", "localhost"), ("", "", "")]
    df = spark.createDataFrame([(r[0],) for r in rows], "host string")
    assert [(r.host, r.domain, r.suffix) for r in hosts.with_levels(df).collect()] == rows


def test_awkward(spark):
    pages = spark.createDataFrame([(1, None, "h", 1), (2, "", "h", 1), (3, "HTTP://Example.ORG/es/x?y", "h", 1), (3, "HTTP://Example.ORG/es/x?y", "h", 1),
                                   (None, "ftp://x.com", "h", 1), (5, "a" * 100_000 + "://b.com/fr/", "h", 1)], "page_id long, url string, host string, weight int")
    none = spark.createDataFrame([], "url string, bad int")
    got = hosts.judge(pages, none, URL_RULES)
    rows = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=repr)
    es = (3, "example.org", "/es/x", "example.org/es/", "block")
    assert rows == sorted([(1, "", "", None, "allow"), (2, "", "", None, "allow"), es, es, (None, "x.com", "", None, "allow"),
                           (5, "b.com", "/fr/", "com/fr/", "allow")], key=repr)
    assert "weight" in got.columns and hosts.judge(pages.limit(0), none, URL_RULES).count() == 0
    nulls = spark.createDataFrame([("http://a.com/", None), (None, 1)], "url string, bad int")
    assert {r.verdict for r in hosts.judge(pages, nulls, ()).collect()} == {"allow"}
