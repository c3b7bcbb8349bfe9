"""URL filter: fixed host and path rules, and association rules for the urls that they leave open.

Urls that a fixed rule judges are the labels.  Spark's FP-growth mines the token combinations that
come often with a label; a combination becomes an association rule when it has enough support,
its urls have one label with enough confidence, and no part of it is as sure already.  Tokens that
no rule of several can need are left out before; where a url has too many left for FP-growth, whose
combinations double with each, they are counted level by level, up to a rule's width.  The rules
stand in an inverted index under their rarest token, so that a url meets only those rules
of which it has that token; of those that it has whole, the surest decides.  A url that no rule
knows is allowed.

Everything here is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import parts, stored

#: Verdict, host and path of the fixed rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
VERDICTS = ("allow", "block")
#: An association rule's least share of the labelled urls, least confidence and most tokens.
SUPPORT, CONFIDENCE, WIDTH = 0.01, 0.9, 3
#: The operator's default of tokens of a labelled url that are mined, host labels from the right, then path words from
#: the left, as in ``sql``; None mines all, as the query does.  Urls are judged by all their tokens.
MINED = 12
#: FP-growth mines urls of at most so many tokens that rules of several can need; longer ones are counted by level.
MOST_GROWN = 12
#: Rules are broadcast up to so many.
MOST_BROADCAST = 60_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first ``://`` to a slash, question mark, hash or the end, A to Z lower-cased."""
    rest = F.substring_index(F.substring_index(F.substring_index(after_scheme(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, UPPER, LOWER)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without it and for null."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end."""
    rest = F.substring_index(F.substring_index(after_scheme(url), "?", 1), "#", 1)
    at = F.locate("/", rest)
    return F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as verdict and name (of equally long ones that of the longer host, then the
    first by name): its host or a subdomain of it, and a path that starts with the rule's."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, at, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]), reverse=True):
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(at + start).alias("rule"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: ``h:`` host labels from the right, ``p:`` words of the path and ``q:`` of the rest,
    in lower case, with runs of digits as one ``0``."""
    rest = F.substring(after_scheme(url), F.length(host) + F.length(path) + 1, F.length(url))
    words = lambda text, split: F.array_remove(F.split(F.regexp_replace(F.translate(text, UPPER, LOWER), "[0-9]+", "0"), split), "")
    marked = lambda mark, found: F.transform(found, lambda t: F.concat(F.lit(mark), t))
    return F.array_distinct(F.concat(marked("h:", F.reverse(words(host, r"\."))), marked("p:", words(path, r"[/._,;=&+%~-]+")), marked("q:", words(rest, r"[?#/._,;=&+%~-]+"))))


def counted(sets: DataFrame) -> DataFrame:
    """How often each antecedent of ``sets`` (antecedent, verdict, n) was seen, most with one verdict (top), and by verdict."""
    each = sets.groupBy("antecedent", "verdict").agg(F.sum("n").alias("hits"))
    return each.groupBy("antecedent").agg(F.sum("hits").alias("seen"), F.max("hits").alias("top"), F.collect_list(F.struct("verdict", "hits")).alias("by"))


def grown(urls: DataFrame, least: int, width: int) -> DataFrame:
    """The sets of 2 to ``width`` tokens that FP-growth finds at least ``least`` times with a verdict."""
    rows = urls.select(F.concat("tokens", F.array(F.concat(F.lit("="), F.col("verdict")))).alias("items"))
    # half a url less, as a share times the urls may come out above the whole number; few frequent tokens at any size,
    # so more partitions than cores would only copy urls
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / rows.count(), minConfidence=1.0, numPartitions=parts(urls.sparkSession)).fit(rows)
    label = F.get(F.filter("items", lambda t: F.startswith(t, F.lit("="))), F.lit(0))
    antecedent = F.array_sort(F.filter("items", lambda t: ~F.startswith(t, F.lit("="))))
    sets = model.freqItemsets.select(antecedent.alias("antecedent"), F.substring(label, 2, 100).alias("verdict"), "freq")
    sets = stored(sets.where((F.size("antecedent") > 1) & (F.size("antecedent") <= width)), "itemsets")
    seen = sets.where("verdict is null").select("antecedent", F.col("freq").alias("seen"))
    return sets.where("verdict is not null").join(seen, "antecedent").select("antecedent", "verdict", F.col("freq").alias("hits"), "seen")


def by_level(urls: DataFrame, single: DataFrame, least: int, width: int) -> DataFrame:
    """Those sets, counted for each number of tokens in turn: equal urls once, a set in a row of its own, and a longer one
    only if the sets of its first and of its last tokens (``single``: antecedent, seen) can be parts of a rule."""
    lists = stored(urls.groupBy("tokens", "verdict").agg(F.count("*").alias("n")), "lists")

    def longer(sets: DataFrame) -> DataFrame:
        each = sets.select("verdict", "n", "antecedent", "rest", F.posexplode("rest").alias("at", "token"))
        return each.select("verdict", "n", F.concat("antecedent", F.array("token")).alias("antecedent"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"))

    sets = longer(lists.select("verdict", "n", F.array().cast("array<string>").alias("antecedent"), F.col("tokens").alias("rest")))
    out, last = None, single
    for size in range(2, width + 1):
        sets = longer(sets)
        if size > 2:
            sets = sets.join(last.select(F.col("antecedent").alias("end")), F.slice("antecedent", 2, size) == F.col("end"), "left_semi")
        found = stored(counted(sets).where(F.col("top") >= least), "itemsets")
        rows = found.select("antecedent", "seen", F.inline("by")).select("antecedent", "verdict", "hits", "seen")
        out = rows if out is None else out.unionByName(rows)
        if size < width:
            sides = found.where("top < seen").select("antecedent", "seen", F.explode(F.transform("antecedent", lambda t: F.array_remove("antecedent", t))).alias("side"))
            rarer = sides.join(last.select(F.col("antecedent").alias("side"), F.col("seen").alias("before")), "side").where("seen < before")
            last = stored(rarer.groupBy("antecedent", "seen").agg(F.count("*").alias("sides")).where(F.col("sides") == size).select("antecedent", "seen"), "parts")
            sets = sets.join(last.select("antecedent"), "antecedent", "left_semi")
    return out


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, width: int = WIDTH, mined: int | None = MINED) -> DataFrame:
    """Association rules from ``labelled`` (tokens, verdict): antecedent, verdict, hits (urls with both), seen (urls with
    the antecedent) and confidence.  A rule goes if a part of its antecedent gives the same verdict at least as surely.

    So no rule of several tokens has one that comes with one verdict only (that is as sure alone), one of all urls (the
    others are as sure without it), or, of any part, one more token than is needed for the same urls."""
    tokens = F.col("tokens") if mined is None else F.slice("tokens", 1, mined)
    urls = stored(labelled.select(F.monotonically_increasing_id().alias("id"), "verdict", tokens.alias("tokens")), "labelled")
    total = urls.count()
    least = max(1, math.ceil(support * total))
    each = urls.select("id", "verdict", F.explode("tokens").alias("token"))
    ones = stored(counted(each.select(F.array("token").alias("antecedent"), "verdict", F.lit(1).alias("n"))).where(F.col("top") >= least), "tokens")
    single = ones.where((F.col("top") < F.col("seen")) & (F.col("seen") < total)).select("antecedent", "seen")
    left = each.join(single.select(F.col("antecedent")[0].alias("token")), "token").groupBy("id", "verdict").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    left = stored(left.where(F.size("tokens") > 1), "left")
    sets = ones.select("antecedent", "seen", F.inline("by")).select("antecedent", "verdict", "hits", "seen")
    longest = left.agg(F.max(F.size("tokens"))).first()[0] or 0
    if longest and width > 1:
        sets = sets.unionByName(grown(left, least, width) if longest <= MOST_GROWN else by_level(left, single, least, width))
    rules = sets.where(F.col("hits") >= least).select("*", (F.col("hits") / F.col("seen")).alias("confidence")).where(F.col("confidence") >= confidence)
    rules = stored(rules, "rules")
    subsets = F.aggregate("antecedent", F.array(F.array().cast("array<string>")), lambda all, t: F.concat(all, F.transform(all, lambda s: F.concat(s, F.array(t)))))
    sides = rules.select("antecedent", "verdict", "confidence", F.explode(subsets).alias("side")).where((F.size("side") > 0) & (F.size("side") < F.size("antecedent")))
    known = rules.select(F.col("antecedent").alias("k"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    weak = sides.join(known, (F.col("side") == F.col("k")) & (F.col("verdict") == F.col("v")) & (F.col("c") >= F.col("confidence"))).select(F.col("antecedent").alias("w"), "v").distinct()
    return rules.join(weak, (F.col("antecedent") == F.col("w")) & (F.col("verdict") == F.col("v")), "left_anti")


def inverted(rules: DataFrame) -> DataFrame:
    """The rules under that token of theirs that the fewest of them have (the first by name of equals)."""
    each = rules.select("antecedent", "verdict", "hits", "confidence", F.explode("antecedent").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("often")).withColumnRenamed("token", "o")
    least = each.join(often, F.col("token") == F.col("o")).groupBy("antecedent", "verdict", "hits", "confidence").agg(F.min(F.struct("often", "token")).alias("least"))
    return least.select(F.col("least.token").alias("post"), "antecedent", "verdict", "hits", "confidence")


def surest(urls: DataFrame, index: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """url and the verdict of the surest rule that it has whole (of equally sure ones that with more hits, then the last
    by name), for the urls (url, tokens) that have any."""
    index = F.broadcast(index) if index.count() <= most_broadcast else index
    met = urls.select("url", "tokens", F.explode_outer("tokens").alias("token")).join(index, F.col("token") == F.col("post"))
    whole = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "hits", F.array_join("antecedent", " ").alias("name"), "verdict"))
    return whole.groupBy("url").agg(best.alias("best")).select(F.col("url").alias("u"), F.col("best.verdict").alias("mined"), F.col("best.name").alias("evidence"))


def judge(pages: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, width: int = WIDTH, mined: int | None = MINED) -> DataFrame:
    """page_id, host, path, rule, verdict and evidence (the tokens of the association rule that decided) of every row of
    ``pages`` (page_id, url).

    A null or empty url, and one without ``://``, has an empty host and path and no rule; it is allowed unless its tokens say otherwise.
    Equal urls are judged alike, each row comes out once, null ids stay null, urls of any length are read
    whole, other columns are left out.  Rules are learnt from the first ``mined`` tokens of a labelled url, from all if it
    is None.  Without labelled urls there are no association rules, and an empty table gives no rows."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fixed", rule_of(F.col("host"), F.col("path"), rules))
    words = tokens(F.col("url"), F.col("host"), F.col("path"))
    known, open_ = rows.where("fixed is not null"), rows.where("fixed is null")
    known_out = known.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.col("fixed.verdict").alias("verdict"), F.lit(None).cast("string").alias("evidence"))
    plain = open_.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"), F.lit(None).cast("string").alias("evidence"))
    labelled = known.select(words.alias("tokens"), F.col("fixed.verdict").alias("verdict"))
    if labelled.isEmpty():
        return known_out.unionByName(plain)
    index = stored(inverted(mined_rules(labelled, support, confidence, width, mined)), "index")
    # each url once; a url that many rows have is then one row on this side of the join
    urls = open_.where("url is not null").select("url", "host", "path").distinct().select("url", words.alias("tokens"))
    best = stored(surest(urls, index), "surest")
    out = open_.join(best, F.col("url") == F.col("u"), "left")
    out = out.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.coalesce("mined", F.lit("allow")).alias("verdict"), "evidence")
    return known_out.unionByName(out)


def sql(rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, width: int = WIDTH, mined: int = MINED) -> str:
    """The rows of ``judge`` in DuckDB: every combination of up to three tokens is counted."""
    assert width == 3
    table = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    words = lambda text, split: f"list_filter(string_split_regex(regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '{split}'), lambda x: x <> '')"
    marked = lambda mark, found: f"list_transform({found}, lambda x: '{mark}' || x)"
    all_ = f"{marked('h:', f'list_reverse({words("host", "[.]")})')} || {marked('p:', words('path', '[/._,;=&+%~-]+'))} || {marked('q:', words('rest', '[?#/._,;=&+%~-]+'))}"
    return f"""
with a as (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end after from pages),
b as (select page_id, url, after, regexp_extract(after, '^[^/?#]*') raw, regexp_extract(after, '^[^?#]*') front from a),
c as (select page_id, url, translate(raw, '{UPPER}', '{LOWER}') host, substr(front, length(raw) + 1) path, substr(after, length(front) + 1) rest from b),
r(v, h, s) as (values {table}),
f as (select c.*, (select {{'v': v, 'r': h || s}} from r where (host = h or ends_with(host, '.' || h)) and starts_with(path, s) order by length(h || s) desc, length(h) desc, h || s limit 1) fixed from c),
l as (select f.*, {all_} t0 from f),
t as (select page_id, url, host, path, fixed, row_number() over () n, list_filter(t0, lambda x, i: list_position(t0, x) = i) toks from l),
w as (select n, fixed.v v, unnest(toks[1:{mined}]) tok from t where fixed is not null),
sets as (
  select n, v, [tok] s from w union all
  select x.n, x.v, [x.tok, y.tok] from w x join w y on x.n = y.n and x.tok < y.tok union all
  select x.n, x.v, [x.tok, y.tok, z.tok] from w x join w y on x.n = y.n and x.tok < y.tok join w z on x.n = z.n and y.tok < z.tok),
g as (select s, v, count(*) hits from sets group by all),
k as (select s, v, hits, hits / sum(hits) over (partition by s) confidence from g),
rules as (select * from k where confidence >= {confidence} and hits >= ceil({support} * (select count(*) from t where fixed is not null))),
strong as (select * from rules x where not exists (select 1 from rules y where y.v = x.v and y.confidence >= x.confidence and len(y.s) < len(x.s) and list_has_all(x.s, y.s))),
best as (
  select n, max({{'c': confidence, 'h': hits, 'name': array_to_string(s, ' '), 'v': v}}) b
  from t join strong on list_has_all(toks, s) where fixed is null group by n)
select page_id, host, path, fixed.r "rule", coalesce(fixed.v, b.v, 'allow') verdict, b.name evidence from t left join best using (n)"""
