"""URL rules against brute force over all token subsets, and the contract's host, path and seed rules against plain code."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import pytest

from gridcast.llm import queries, url_rules

SEEDS = queries.URL_SEEDS
SCHEMA = "page_id long, url string, html string, row long, verdict string, tokens string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(url):
    if url is None or "://" not in url:
        return "", "", "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    rest = rest[len(host) :]
    path = re.split("[?#]", rest, maxsplit=1)[0]
    rest = rest[len(path) :]
    query, mark, fragment = rest.partition("#")
    return host.translate(LOW), path, query, mark + fragment


def seed_of(host, path):
    fits = [(len(r), r, v) for v, r in SEEDS for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else None


def tokens_of(host, path, query, fragment):
    pieces = lambda s: ["#" if re.fullmatch("[0-9]+", x) else x for x in re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", s.translate(LOW))]
    out = {f"h:{x}" for x in host.split(".") if x} | {f"p:{x}" for x in pieces(path)} | {f"f:{x}" for x in pieces(fragment)}
    return out | {f"q:{x}" for x in re.findall("[?&]([^=&]+)", query.translate(LOW))}


def plain(urls, support=0.01, confidence=90):
    """page_id -> host, path, rule, verdict, mined tokens; rules by trying all subsets of all labelled URLs."""
    rows, train = [], []
    named = {f"h:{x}" for _, r in SEEDS for x in r.split("/")[0].split(".")}
    for page, url in urls:
        host, path, query, fragment = parsed(url)
        seed = seed_of(host, path)
        rows.append((page, host, path, seed, tokens_of(host, path, query, fragment)))
        if seed:
            rest = path[len("/" + seed[0].split("/", 1)[1]) :]
            train.append((tokens_of(host, rest, query, fragment) - named, seed[1]))
    least = max(1, -(-int(support * len(train) * 1000) // 1000)) if train else 1
    where = defaultdict(list)
    for i, (tokens, _) in enumerate(train):
        for t in tokens:
            where[t].append(i)
    same = defaultdict(list)
    for t, at in where.items():
        if least <= len(at) < len(train):
            same[tuple(at)].append(t)
    members = {min(ts): sorted(ts) for ts in same.values()}
    n, both, share = Counter(), Counter(), Counter(v for _, v in train)
    for tokens, verdict in train:
        items = sorted(t for t in tokens if t in members)
        for k in range(1, len(items) + 1):
            for s in combinations(items, k):
                n[s] += 1
                both[s, verdict] += 1
    rules = {(s, v): c for (s, v), c in both.items() if c >= least and 100 * c >= confidence * n[s] and c * len(train) > n[s] * share[v]}
    rules = {(s, v): c for (s, v), c in rules.items() if not any(
        (s[:i] + s[i + 1 :], v) in rules and Fraction(rules[s[:i] + s[i + 1 :], v], n[s[:i] + s[i + 1 :]]) >= Fraction(c, n[s]) for i in range(len(s)))}
    out = []
    for page, host, path, seed, tokens in rows:
        if seed:
            out.append((page, host, path, seed[0], seed[1], None))
            continue
        fits = [(c / n[s], -len(s), c, v, " ".join(sorted(t for x in s for t in members[x]))) for (s, v), c in rules.items() if all(set(members[x]) <= tokens for x in s)]
        best = max(fits, default=None)
        out.append((page, host, path, None, best[3] if best else "allow", best[4] if best else None))
    return out


def key(rows):
    return sorted(tuple("" if v is None else f"={v}" for v in r) for r in rows)


def judged(spark, urls, **parameters):
    pages = spark.createDataFrame([(p, u, "<p>", 1, "v", "t") for p, u in urls], SCHEMA)
    return [tuple(r[:5]) + (r["mined"],) for r in url_rules.judge_urls(pages, SEEDS, **parameters).collect()]


@pytest.fixture(scope="module")
def odd_urls(tables):
    urls = [(r.page_id, r.url) for r in tables("pages").orderBy("page_id").collect()]
    hot = "https://very.long.host.example.net/" + "/".join(f"w{i}" for i in range(40))
    urls += [(5000 + i, hot) for i in range(60)]  # 40 tokens that always come together, in half of all labelled URLs
    urls += [(6000, None), (6001, ""), (6002, "no scheme"), (6003, "http://"), (6004, "HTTP://NET"), (6005, "x://NET/"), (6006, "x://anet/"), (6007, "x://a.net?net/"),
             (6008, "a://b://c.net/"), (6009, "x://Ü.net/\nfr/é?Ä=1#Top-2"), (6010, "http://org/fr/x"), (6011, "http://org/fr"), (6012, "https://example.net/en/" + "y" * 50_000),
             (6013, "x://example.net/EN/"), (None, "http://a.example.org/w1/w2"), (7, urls[7][1]), (7, urls[8][1])]
    return urls


def test_urls_equal_brute_force(spark, odd_urls):
    short = [(p, u) for p, u in odd_urls if u is None or "w39" not in u]
    assert key(judged(spark, short)) == key(plain(short))


def test_long_repeated_url(spark, odd_urls):
    """Tokens of the same rows are one item: 2^40 subsets aren't mined, and the rule asks for all of them."""
    got = judged(spark, odd_urls + [(9000, "http://q.example.org/" + "/".join(f"w{i}" for i in range(40))), (9001, "http://q.example.org/w1/w2")])
    assert len(got) == len(odd_urls) + 2
    by = {r[0]: r for r in got}
    assert by[5000][3:5] == ("net/", "block") and by[9001][3] is None and by[9001][5] is None
    assert by[6000][1:5] == ("", "", None, "allow") and by[6005][3] == "net/" and by[6006][3] is None and by[6013][3] == "net/"


def test_seed_evidence_is_hidden(spark):
    """What a seed rule names isn't learnt back; what goes with it is, on hosts that no seed rule names."""
    urls = [(i, f"http://a{i}.net/casino/{i}") for i in range(20)] + [(100 + i, f"http://b{i}.example.net/en/news/{i}") for i in range(20)]
    urls += [(200, "http://x.example.com/casino/1"), (201, "http://x.example.com/news/1"), (202, "http://x.example.com/other/1")]
    got = {r[0]: r for r in judged(spark, urls)}
    assert got[200][4:] == ("block", "p:casino") and got[201][4:] == ("allow", "p:news") and got[202][4:] == ("allow", None)


def test_no_pages_and_no_labels(spark):
    assert judged(spark, []) == []
    assert key(judged(spark, [(1, "http://a.com/x"), (1, "http://a.com/x")])) == key([(1, "a.com", "/x", None, "allow", None)] * 2)
