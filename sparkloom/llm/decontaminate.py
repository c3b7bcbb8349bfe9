"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask keeps some of a few neighbouring tokens and ignores the others, so a seed survives
substitutions at the ignored places.  Seeds of test items and documents are joined; around each
hit the item and the document are laid over each other and compared token by token.  The best
stretch scores one for an equal token and minus one for another; it is an overlap from
``NEED`` on, or from 0.8 of the item's tokens where that is less.

An item shorter than the shortest mask has no room for ignored places: it is one seed of all its
tokens, and an overlap wherever a document has them in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed masks, of weight 6: 1 keeps a token, 0 ignores it.
MASKS = ("11101011", "110100111", "1100101011")
NEED = 13
#: Seeds of the test items are broadcast up to so many rows (under 100 MB with their items).
MOST_BROADCAST = 500_000
#: Hits of one document that are looked at together.
HITS = 10_000


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits; a null text has none."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, h: str, at: str, key: str, masks: tuple[str, ...], keep: list[str], lengths: tuple[int, ...] = ()) -> DataFrame:
    """A row for every seed of the token array ``h``: its place, key and the columns ``keep``.

    ``lengths`` adds seeds of so many tokens in a row.  Places are generated as numbers and each
    one's keys read from the array, all in one span of generated code; only seeds that a join
    finds leave it."""
    masks = (*masks, *("1" * n for n in lengths))
    room = F.size(h) - min(map(len, masks))
    # (for an inner explode the optimizer adds filters that compute the tokens again)
    rows = rows.select(*keep, h, F.explode_outer(F.when(room >= 0, F.sequence(F.lit(0), room))).alias(at))
    keys = []
    for mask in masks:
        kept = [F.get(F.col(h), F.col(at) + o) for o, bit in enumerate(mask) if bit == "1"]
        keys.append(F.when(F.col(at) + len(mask) <= F.size(h), F.xxhash64(F.lit(mask), *kept)))
    return rows.select(*keep, at, F.explode(F.array(*keys)).alias(key)).where(F.col(key).isNotNull())


def best_stretch(a: Column, b: Column) -> Column:
    """The highest score of a stretch of two equally long runs of tokens."""
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, equal: Column) -> Column:
        run = F.greatest(F.lit(0), acc["run"] + F.when(equal, 1).otherwise(-1))
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.zip_with(a, b, lambda x, y: x == y), zero, step, lambda acc: acc["best"])


def overlaps(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, need: int = NEED, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, tie (hash of the text), item_id and score of every verified overlap.

    Null and empty texts and items have none, so an empty table gives no rows.  Repeated rows count once;
    texts are read whole: a long one stands with up to ``HITS`` windows of its hits' own items in a row.  The seeds of the items
    are broadcast when they are few, by a count; otherwise both sides are shuffled.  Hits go back
    to the documents by id and hash, at most ``HITS`` of a document in a row."""
    least = min(map(len, masks))
    whole = items.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("item")).where(F.size("item") > 0).distinct().withColumn("length", F.size("item"))
    # fewer than ``least`` different numbers, however many items
    lengths = tuple(sorted(r.length for r in whole.select("length").where(F.col("length") < least).distinct().collect()))
    test = seeds(whole.where(F.col("length") >= least), "item", "item_at", "key", masks, ["item_id", "length"])
    for n in lengths:
        test = test.unionByName(seeds(whole.where(F.col("length") == n), "item", "item_at", "key", (), ["item_id", "length"], (n,)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), tokens(F.col("text")).alias("doc"))
    hits = seeds(rows, "doc", "doc_at", "doc_key", masks, ["doc_id", "tie"], lengths)
    hits = hits.join(F.broadcast(test) if test.count() <= most_broadcast else test, F.col("doc_key") == F.col("key"))
    # the many hits of one overlap share its shift
    hits = hits.select("doc_id", "tie", "item_id", "length", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()
    bundle = F.pmod(F.xxhash64("item_id", "shift"), F.ceil(F.col("n") / HITS)).alias("bundle")
    counts = hits.groupBy("doc_id", "tie").agg(F.count("*").alias("n")).select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "n")
    hits = hits.join(counts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))).select("doc_id", "tie", bundle, "item_id", "length", "shift")
    hits = hits.groupBy("doc_id", "tie", "bundle").agg(F.collect_list(F.struct("item_id", "length", "shift")).alias("hits")).select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "hits")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text")
    near = texts.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))).select("doc_id", "tie", tokens(F.col("text")).alias("doc"), "hits")
    # per document: the span of tokens that each hit's own item would lie on
    total = whole.select(F.sum("length")).first()[0] or 0
    # (two uses of doc keep the optimizer from computing it inside the lambda)
    start = lambda x: F.greatest(x["shift"], F.lit(0))
    window = lambda x: F.slice(F.col("doc"), start(x) + 1, F.greatest(F.lit(0), F.least(x["length"], F.size("doc") - start(x))))
    lay = F.transform("hits", lambda x: F.struct(x["item_id"].alias("item_id"), x["shift"].alias("shift"), window(x).alias("window")))
    laid = near.select("doc_id", "tie", F.explode(lay).alias("x")).select("doc_id", "tie", "x.*")
    whole = whole.select(F.col("item_id").alias("i"), "item")
    found = laid.join(F.broadcast(whole) if total <= 10 * most_broadcast else whole, F.col("item_id").eqNullSafe(F.col("i")))
    part = F.slice("item", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("window"))
    found = found.select("doc_id", "tie", "item_id", F.size("item").alias("length"), F.slice("window", 1, F.size(part)).alias("window"), part.alias("part"))
    found = found.withColumn("score", best_stretch(F.col("window"), F.col("part")))
    floor = F.when(F.col("length") < least, F.col("length")).otherwise(F.least(F.lit(need), F.ceil(F.col("length") * 0.8)).cast("int"))
    return found.where(F.col("score") >= floor).groupBy("doc_id", "tie", "item_id").agg(F.max("score").alias("score"))


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """For every document row: doc_id, contaminated, item_id (of the best overlap, the smaller id
    when scores tie), score and n_items; null item and score where there is none.

    Null and empty texts are not contaminated, repeated rows come out as often as they are there, null ids
    go by their text, texts are read whole, and an empty table gives no rows."""
    found = overlaps(docs, items, **options)
    best = found.groupBy("doc_id", "tie").agg(F.max(F.struct("score", (-F.col("item_id")).alias("rank"))).alias("best"), F.count("*").alias("n_items"))
    best = best.select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "best", "n_items")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    rows = rows.join(best, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")), "left")
    return rows.select("doc_id", F.col("best").isNotNull().alias("contaminated"), (-F.col("best.rank")).alias("item_id"), F.col("best.score").alias("score"), F.coalesce("n_items", F.lit(0)).alias("n_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a verified overlap, with all their columns: null and empty texts stay, equal rows
    share their fate, an empty table stays empty."""
    found = overlaps(docs, items, **options).select(F.col("doc_id").alias("d"), F.col("tie").alias("t")).distinct()
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    rows = rows.join(found, F.col("row.doc_id").cast("long").eqNullSafe(F.col("d")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("t")), "left_anti")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def sql(masks: tuple[str, ...] = MASKS, need: int = NEED) -> str:
    """The rows of ``contamination`` in DuckDB: seeds as joined words instead of hashes, and the best
    stretch of an overlap as the largest rise of its running score."""
    least = min(map(len, masks))
    rows = ", ".join(f"({n}, {[i for i, bit in enumerate(mask) if bit == '1']}, {len(mask)})" for n, mask in enumerate(masks))
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    seed = "mask, p, array_to_string(list_transform(places, lambda o: w[p + o + 1]), ' ') key"
    return f"""
with d as (select doc_id, {words} w from documents),
i as (select distinct item_id, {words} w from benchmark),
m(mask, places, size) as (select * from (values {rows}) union all select distinct 100 + len(w), range(0, len(w)), len(w) from i where len(w) between 1 and {least - 1}),
ds as (select doc_id, {seed} from (select doc_id, w, unnest(range(0, len(w))) p from d), m where p + size <= len(w)),
its as (select item_id, {seed} from (select item_id, w, unnest(range(0, len(w))) p from i), m where p + size <= len(w) and (mask < 100) = (len(w) >= {least})),
hits as (select distinct doc_id, item_id, ds.p - its.p shift from ds join its using (mask, key)),
laid as (select h.doc_id, h.item_id, h.shift, d.w dw, i.w iw, unnest(range(greatest(0, -h.shift), least(len(i.w), len(d.w) - h.shift))) k from hits h join d using (doc_id) join i using (item_id)),
sums as (select doc_id, item_id, shift, k, len(iw) size, sum(case when dw[shift + k + 1] = iw[k + 1] then 1 else -1 end) over (partition by doc_id, item_id, shift order by k) s from laid),
rises as (select doc_id, item_id, size, s - least(0, coalesce(min(s) over (partition by doc_id, item_id, shift order by k rows between unbounded preceding and 1 preceding), 0)) rise from sums),
found as (select doc_id, item_id, max(rise)::int score from rises group by doc_id, item_id, size having max(rise) >= case when size < {least} then size else least({need}, ceil(size * 0.8)) end),
best as (select doc_id, arg_max(item_id, (score, -item_id)) item_id, max(score) score, count(*) n from found group by 1)
select doc_id, best.doc_id is not null contaminated, item_id, score, coalesce(n, 0) n_items from d left join best using (doc_id)"""
