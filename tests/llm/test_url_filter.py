import numpy as np
import pytest

from statloom.llm import url_filter as u

URLS = [
    "https://www.example.net/en/1?x=1", "https://example.net/de/1", "http://a.net", "https://shop.casino-win.example.com/en/4",
    "https://EXAMPLE.com/de/x", "https://sub.example.com/DE/x", "https://fr.org/fr/1", "https://fr.org/fr", "https://notnet/",
    "https://xnet/en/", "ftp://x.org/a://b/c", "no scheme", "", "://", "http://?q", "https://a.org#frag/fr/", "a://B.Example.NET/en/#x",
    "https://free-bets.example.com/en/1", "https://library.example.com/books", "https://ü.example.org/fr/ñ", None, "x" * 100_000,
]


def plain(url):
    """Host, path and rule, read off the contract."""
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in u.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_against_the_contract(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0])], "page_id long, url string")
    got = u.url_filter(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, (rule, verdict) = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        own = u.url_features(host, path)
        assert r.verdict == (verdict or ("block" if r.block_probability >= 0.5 else "allow"))
        assert r.block_probability == pytest.approx(MODEL(own), abs=1e-12)


def MODEL(own):
    rows = [u.url_features(*u._split(x)) for x, _ in u.LABELLED]
    weights, intercept = u.fit_logistic(rows, np.array([y for _, y in u.LABELLED], float))
    margin = intercept + (sum(weights[i] for i in own) / np.sqrt(len(own)) if len(own) else 0)
    return 1 / (1 + np.exp(-margin))


def test_learns_the_labelled_table():
    for url, label in u.LABELLED:
        assert (MODEL(u.url_features(*u._split(url))) >= 0.5) == bool(label), url
    assert MODEL(u.url_features("www.casino-win.example.com", "/fr/999.html")) > 0.5
    assert MODEL(u.url_features("www.therthe.example.com", "/fr/999.html")) < 0.5


def test_empty_table_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", 2, 3)], "page_id long, url string, host int, Verdict int")
    got = u.url_filter(pages)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "block_probability", "verdict"]
    assert got.first().host == "a.b" and u.url_filter(pages.limit(0)).count() == 0
