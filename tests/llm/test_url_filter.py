"""The url filter against brute force over all token combinations."""

import itertools
import math
import random
import re
from collections import Counter

from sparkloom.llm import queries, url_filter

SCHEMA = "page_id long, url string"


def split(url):
    after = url.partition("://")[2] if url and "://" in url else ""
    host = re.match("[^/?#]*", after)[0]
    path = re.match("[^?#]*", after[len(host) :])[0]
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    return lower(host), path, after[len(host) + len(path) :], lower


def words(url):
    host, path, rest, lower = split(url)
    plain = lambda s, cut: [w for w in re.split(cut, re.sub("[0-9]+", "0", lower(s))) if w]
    found = ["h:" + w for w in plain(host, "[.]")[::-1]] + ["p:" + w for w in plain(path, "[/._,;=&+%~-]+")] + ["q:" + w for w in plain(rest, "[?#/._,;=&+%~-]+")]
    return list(dict.fromkeys(found))


def fixed(url, rules):
    host, path, *_ = split(url)
    fits = [(len(h + s), len(h), [-ord(c) for c in h + s], v, h + s) for v, h, s in rules if (host == h or host.endswith("." + h)) and path.startswith(s)]
    return max(fits)[3:] if fits else (None, None)


def brute(rows, rules=url_filter.RULES, support=0.01, confidence=0.9, width=3, mined=12):
    judged = [(i, u, *fixed(u, rules)) for i, u in rows]
    labelled = [(words(u)[:mined], v) for _, u, v, _ in judged if v]
    seen, hits = Counter(), Counter()
    for w, v in labelled:
        for n in range(1, width + 1):
            for c in itertools.combinations(sorted(w), n):
                seen[c] += 1
                hits[c, v] += 1
    least = math.ceil(support * len(labelled))
    found = {k: n / seen[k[0]] for k, n in hits.items() if n >= least and n / seen[k[0]] >= confidence}
    found = {(c, v): p for (c, v), p in found.items() if not any(found.get((s, v), 0) >= p for n in range(1, len(c)) for s in itertools.combinations(c, n))}
    out = []
    for i, u, v, rule in judged:
        best = None
        if not v:
            have = set(words(u))
            best = max(((p, hits[c, x], " ".join(c), x) for (c, x), p in found.items() if have >= set(c)), default=None)
        out.append((i, *split(u)[:2], rule, v or (best[3] if best else "allow"), best and best[2]))
    return sorted(out, key=str)


def urls(r, n):
    host = lambda: ".".join([*r.sample(["www", "m", "blog", "Casino-Win", "shop"], r.randint(0, 2)), r.choice(["example", "Example", "other", "net-works"]), r.choice(["net", "com", "org", "NET", "info"])])
    path = lambda: r.choice(["", "/", "/en/", "/de/", "/fr/", "/EN/", "/en"]) + "/".join(r.choice(["a", "b1", "news", "2024", "x-y_z.html", "é"]) for _ in range(r.randint(0, 3)))
    tail = lambda: r.choice(["", "", "?q=1&page=22", "#top", "?u=http://x.net/en/", "?", "#a?b"])
    return [f"{r.choice(['http', 'https', 'ftp'])}://{host()}{path()}{tail()}" for _ in range(n)]


ODD = [None, "", "no scheme", "://", "http://", "http:///path", "http://net", "http://net/", "http://NET/x", "http://x.net:80/", "http://user@example.net/en/", "a://b://net/", "http://example.net/en", "http://example.net/en/?#", "http://xnet/", "http://.net/", "http://a.org/fr/" + "long/" * 9000, "http://a.com/" + "w" * 60_000, "http://ünet/é", " http://a.net/ "]


def rows_of(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_verdicts_equal_brute_force(spark):
    r = random.Random(4)
    found = urls(r, 600) + ODD * 2 + ["http://hot.example.com/en/"] * 300
    rows = list(enumerate(found)) + [(None, found[0]), (7, found[7]), (7, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' as host", "1 as path", "2 as tokens", "'x' as verdict", "3 as rule").repartition(5)
    got = rows_of(url_filter.judge(df))
    assert got == brute(rows)
    assert {x[4] for x in got if x[3] is None} == {"allow", "block"}


def test_rules_of_equal_length_and_weak_evidence(spark):
    rules = (("block", "b.net", "/"), ("allow", "net", "/ab"), ("allow", "a.b.net", "/"), ("block", "org", "/"))
    r = random.Random(5)
    rows = [(i, u) for i, u in enumerate(["http://b.net/ab/c", "http://a.b.net/x", "http://c.net/ab", "http://c.net/a"] * 9 + urls(r, 300))]
    got = rows_of(url_filter.judge(spark.createDataFrame(rows, SCHEMA), rules, support=0.05, confidence=0.75))
    assert got == brute(rows, rules, 0.05, 0.75)


def test_nothing_to_learn_from(spark):
    rows = [(1, "http://a.com/x"), (2, None)]
    assert rows_of(url_filter.judge(spark.createDataFrame(rows, SCHEMA))) == brute(rows) == [(1, "a.com", "/x", None, "allow", None), (2, "", "", None, "allow", None)]
    assert rows_of(url_filter.judge(spark.createDataFrame([], SCHEMA))) == []


def test_rules_too_many_to_broadcast(spark, monkeypatch):
    r = random.Random(6)
    rows = list(enumerate(urls(r, 300)))
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(url_filter.surest, "__defaults__", (0,))
    assert rows_of(url_filter.judge(df)) == brute(rows)


def long_urls(r, n):
    """Urls of 14 to 22 words, whose labels hang together with words at any place."""
    pool = [f"w{chr(97 + k)}" for k in range(26)]
    out = []
    for _ in range(n):
        some = r.sample(pool, r.randint(14, 22))
        host = "a.net" if ("wa" in some and "wb" in some) or r.random() < 0.4 else r.choice(["b.org/fr", "c.info", "d.com"])
        r.shuffle(some)
        out.append(f"http://{host}/{'/'.join(some)}?{r.choice(['x', 'y'])}=1")
    return out


def test_rules_from_all_tokens_of_long_urls(spark, tmp_path):
    r = random.Random(7)
    words14 = "/".join(f"z{chr(97 + k)}" for k in range(14))
    # copies of long urls with either label, their label known by the last word alone
    rows = [f"http://a.net/{words14}/late"] * 40 + [f"http://b.org/fr/{words14}/last?q=2"] * 60 + ["http://c.com/late", "http://c.com/last"] + long_urls(r, 150)
    rows = list(enumerate(rows))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = rows_of(queries.op13_url_filter(spark, str(tmp_path)))
    assert got == brute(rows, mined=10**6)
    assert {x[1:] for x in got if x[0] in (100, 101)} == {("c.com", "/late", None, "block", "p:late"), ("c.com", "/last", None, "allow", "p:last")}


def test_sets_counted_level_by_level(spark, monkeypatch):
    r = random.Random(8)
    rows = list(enumerate(urls(r, 300) + long_urls(r, 60) + ODD))
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(url_filter, "MOST_GROWN", 0)
    assert rows_of(url_filter.judge(df, support=0.03, confidence=0.8, mined=None)) == brute(rows, support=0.03, confidence=0.8, mined=10**6)
    assert rows_of(url_filter.judge(df, support=0.03, confidence=0.8)) == brute(rows, support=0.03, confidence=0.8)
