"""URL filter against plain string rules."""

import re
from collections import Counter

from roadlens.llm import urls

CASES = [
    ("https://WWW.a.example.org/es/1?x", "www.a.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/en/1234", "example.org", "/en/1234", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/fr/casino", "x.com", "/fr/casino", "com/fr/", "allow"),
    ("http://x.com/de", "x.com", "/de", None, "allow"),
    ("http://a.org", "a.org", "", None, "allow"),
    ("http://casino-win.net/", "casino-win.net", "/", None, "block"),
    ("http://casinos.net/", "casinos.net", "/", None, "allow"),
    ("http://free.net/bets", "free.net", "/bets", None, "block"),
    ("http://free.net/free/free", "free.net", "/free/free", None, "allow"),
    ("http://h?a/b", "h", "", None, "allow"), ("http://h#a/b", "h", "", None, "allow"),
    ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
]


def test_rules_and_terms(spark):
    pages = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(CASES)] + [(None, None, "r")] * 2,
                                  "page_id bigint, url string, rule string")
    got = urls.filter_urls(pages).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is not None} == \
        {i: c[1:] for i, c in enumerate(CASES)}
    assert len(got) == len(CASES) + 2
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_terms_against_regular_expressions():
    words = urls.automaton(urls.STRICT_TERMS, urls.SOFT_TERMS)
    terms = {t: 1 for t in urls.SOFT_TERMS} | {t: 2 for t in urls.STRICT_TERMS}
    for url in ("http://porno.xxx/free-bets", "x.com/adult_video", "ads/track?free=1", "FREE BET wins", "éxxx xxxé", "ad-ads.ad"):
        hits = {t for t in terms if re.search(rf"(?<![^\W_]){t}(?![^\W_])", url.lower())}
        assert urls.url_weight(words, url) == (sum(terms[t] for t in hits), len(hits)), url
    assert Counter(urls.STRICT_TERMS + urls.SOFT_TERMS).most_common(1)[0][1] == 1
