"""URL filter: host rules, then a weighted vocabulary by Aho-Corasick (operator 4)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import map_batches, process_cache

#: A url with one of the strict terms is rejected, and one with
#: ``SOFT_HITS`` different soft terms.  Terms count only between characters
#: that are neither letters nor digits.
STRICT_TERMS = (
    "adult", "casino", "camgirls", "escort", "hentai", "nsfw", "phishing", "porn", "porno", "sexcam",
    "slots", "spam", "viagra", "warez", "xxx",
)
SOFT_TERMS = (
    "ad", "ads", "affiliate", "banner", "bet", "bets", "bonus", "cheap", "click", "coupon", "crack", "dating",
    "deal", "discount", "download", "farm", "free", "jackpot", "keygen", "loan", "loans", "lottery", "meds",
    "pharma", "pharmacy", "pill", "pills", "poker", "popup", "prize", "promo", "replica", "sex", "torrent",
    "track", "tracker", "win", "winner",
)
STRICT_WEIGHT, SOFT_WEIGHT, SOFT_HITS = 2, 1, 2
REJECT_AT = 2

#: (verdict, rule): host and all its subdomains, url paths that start with the rule's path.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)


def automaton(strict, soft):
    import ahocorasick

    words = ahocorasick.Automaton()
    for term, weight in [*((t, SOFT_WEIGHT) for t in soft), *((t, STRICT_WEIGHT) for t in strict)]:
        words.add_word(term, (term, weight))
    words.make_automaton()
    return words


def url_weight(words, url: str) -> tuple[int, int]:
    """(weight, distinct terms): the summed weights of the distinct terms that
    stand in the url with a boundary on both sides."""
    low = url.lower()
    seen = {}
    for end, (term, weight) in words.iter(low):
        start = end + 1 - len(term)
        if (start == 0 or not low[start - 1].isalnum()) and (end + 1 == len(low) or not low[end + 1].isalnum()):
            seen[term] = weight
    return sum(seen.values()), len(seen)


def split_url(url):
    """(host, path) by the fixed rules: host after the first ``://`` up to
    ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path from there up to
    ``?``, ``#`` or the end; both empty without ``://``."""
    rest = (url or "").partition("://")[2]
    rest = min((rest.partition(c)[0] for c in "?#"), key=len)
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def matching_rule(table, host: str, path: str):
    """The longest rule that fits the host or one of its parents, or None."""
    best = None
    for at in [0] + [i + 1 for i, c in enumerate(host) if c == "."]:
        for prefix, rule, verdict in table.get(host[at:], ()):
            if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                best = rule, verdict
    return best


def rule_table(rules) -> dict:
    table: dict = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        table.setdefault(host, []).append((slash + path, rule, verdict))
    return table


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES,
                strict=STRICT_TERMS, soft=SOFT_TERMS) -> DataFrame:
    """One row per row of ``pages``: ``(page_id, host, path, rule, verdict,
    weight, n_terms)``.  A fitting rule decides; else the url is blocked when
    the weights of its distinct terms reach ``REJECT_AT`` (one strict or
    several soft ones).  A null url, or one without ``://``, has empty host
    and path and fits no rule; a null one is allowed.  Ids may be null or
    repeated, other columns are ignored, an empty table gives an empty
    result.  The vocabulary and the rules are parameters shipped with the
    task; nothing is shuffled."""
    table = rule_table(rules)
    strict, soft = tuple(strict), tuple(soft)

    def run(batch: pa.RecordBatch):
        words = process_cache(("urls", strict, soft), lambda: automaton(strict, soft))
        out = [], [], [], [], [], []
        for u in batch.column(1).to_pylist():
            host, path = split_url(u)
            rule = matching_rule(table, host, path)
            weight, terms = url_weight(words, u or "")
            verdict = rule[1] if rule else "block" if weight >= REJECT_AT else "allow"
            for col, v in zip(out, (host, path, rule and rule[0], verdict, weight, terms)):
                col.append(v)
        return [batch.column(0), *out]

    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    kind = src.schema["page_id"].dataType.simpleString()
    return map_batches(src, run, f"page_id {kind}, host string, path string, rule string, verdict string, "
                                 "weight int, n_terms int", 4096)
