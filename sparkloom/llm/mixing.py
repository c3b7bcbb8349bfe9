"""Mixing sources to target weights by weighted fair queueing.

Documents of a source come in a shuffled order, pass after pass (at most ``MAX_PASSES``
repeats); a document's virtual finish time is its source's tokens so far, itself included,
divided by the source's target.  A source leaves the queue at time 1, when its target is served;
its document in service then is cut.  The queue of all sources is range-sorted by finish time,
a running sum of its words taken in that order, and cut where the total budget is used up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import even_ranges, give_back, stored

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
LEAD = 7  # hex digits of the order key that place a document in a slice
MOST_RANGES = 10_000


def size_of(text):
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; 0 for null."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, f"{SPACE}+"))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source``, ``source_size``, ``target``: all sizes shared by weight, capped and reshared.

    ``sizes`` has a row for each source, so the windows below sort sources, not documents.
    Water level: with sources by cap / weight, the first k capped and the rest at weight times
    (total - caps) / weights, for the least k at which the next source stays under its cap."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    w = F.get(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(rank) - 1) % len(weights)).cast("long")
    rows = sizes.withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_passes).cast("long"))
    rows = rows.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    every = Window.partitionBy()
    rows = rows.withColumn("left_size", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    rows = rows.withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # at a source's place all smaller ratios are capped; it is itself free when its share fits
    rows = rows.withColumn("fits", F.col("left_size") * F.col("weight") <= F.col("cap") * F.col("left_weight"))
    rows = rows.withColumn("place", F.row_number().over(up))
    first = F.min(F.when(F.col("fits"), F.struct("place", "left_size", "left_weight"))).over(every)
    rows = rows.withColumn("level", first)
    share = (F.col("weight") * F.col("level.left_size")).cast("double") / F.col("level.left_weight")
    target = F.when(F.col("level").isNull() | (F.col("place") < F.col("level.place")), F.col("cap").cast("double")).otherwise(share)
    return rows.select("source", "source_size", target.alias("target"))


def same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def fair_queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, seed: str = "mix", rows_each: int = 4000, budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents (``units``) and the passes of them that the mix takes (``queue``).

    ``docs`` needs doc_id, text and source; null ids, sources and texts are values of their
    own.  A text without words is never taken.  Repeated rows (same id, source and text) form
    one unit of ``n`` rows.  The shuffled order is by md5 of seed, pass, id and text, so reruns
    agree; documents that finish at the same time go by that md5.  Running sums are taken
    within slices of a source's order, about ``rows_each`` units in each, on top of the sums of
    the slices before: a source that holds most rows just has more slices.  ``budget`` is the
    number of words that the mix may take, all words of ``docs`` by default."""
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size_of(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("tie"))
    units = stored(units.groupBy("doc_id", "source", "tie", "size").agg(F.count("*").alias("n")), "units")
    by_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("units"))
    goal = stored(targets(by_source.select("source", "source_size"), weights, max_passes), "targets")
    plan = goal.withColumnRenamed("source", "s").join(by_source.drop("source_size"), same("s", "source")).drop("source")
    plan = plan.withColumn("passes", F.ceil(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("int"))
    plan = plan.select("s", "source_size", "target", "passes", F.ceil(F.col("units") / rows_each).cast("int").alias("slices"))
    units = units.join(plan, same("source", "s")).drop("s")
    copies = units.where("size > 0 and passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    key = F.md5(F.concat(F.lit(seed), F.lit("|"), F.col("pass").cast("string"), F.lit("|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.col("tie")))
    copies = copies.withColumn("key", key).withColumn("words", F.col("size") * F.col("n"))
    lead = F.conv(F.substring("key", 1, LEAD), 16, 10).cast("long")
    copies = copies.withColumn("slice", F.floor(lead * F.col("slices") / F.lit(16**LEAD)).cast("int"))
    sums = copies.groupBy("source", "pass", "slice").agg(F.sum("words").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("pass", "slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("pass").alias("p"), F.col("slice").alias("t"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    copies = copies.join(sums, same("source", "s") & (F.col("pass") == F.col("p")) & (F.col("slice") == F.col("t"))).drop("s", "p", "t")
    run = Window.partitionBy("source", "pass", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    copies = copies.withColumn("so_far", F.col("before") + F.sum("words").over(run))
    copies = copies.withColumn("finish", F.col("so_far") / F.col("target"))
    room = F.floor("target").cast("long") - (F.col("so_far") - F.col("words"))
    copies = copies.withColumn("served", F.least(F.col("words"), room)).where("served > 0")
    queue = stored(copies.select("doc_id", "source", "tie", "size", "n", "pass", "key", "finish", "served"), "queue")
    give_back(docs.sparkSession)
    return units, cut_at(queue, goal.agg(F.sum("source_size")).first()[0] or 0 if budget is None else budget, rows_each)


def cut_at(queue: DataFrame, budget: int, rows_each: int) -> DataFrame:
    """The queue in global order of finish time, up to ``budget`` words: ``taken`` are a row's words
    within it, ``position`` its range of the order."""
    rows, words = queue.agg(F.count("*"), F.sum("served")).first()
    time = F.least("finish", F.lit(1.0))
    ranges = even_ranges(queue, time, F.col("served"), max(1.0, (words or 0) / max(1, min(MOST_RANGES, rows // rows_each))))
    before, total = [], 0
    for w in ranges.totals:
        before.append(int(total))
        total += w
    placed = queue.withColumn("position", ranges.column)
    earlier = F.get(F.from_json(F.lit(str(before)), "array<bigint>"), F.col("position"))
    run = Window.partitionBy("position").orderBy(time, "key").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("upto", earlier + F.sum("served").over(run))
    placed = placed.withColumn("taken", F.least(F.col("served"), F.lit(budget) - (F.col("upto") - F.col("served"))))
    return placed.where("taken > 0").select("doc_id", "source", "tie", "size", "n", "pass", "key", "position", "finish", "taken")


def shares(total, n, number):
    """What one of ``n`` equal rows gets of a total: as even as whole words allow."""
    return (F.floor(total / n) + F.when(number <= total % n, 1).otherwise(0)).cast("long")


def taken_by_document(docs: DataFrame, **options) -> DataFrame:
    """A row for every row of ``docs``: doc_id, size, source_size, target, taken, passes and
    first_finish (null when nothing of it is taken).  No rows for an empty table."""
    units, queue = fair_queue(docs, **options)
    found = queue.groupBy("doc_id", "source", "tie").agg(F.sum("taken").alias("words"), F.count("*").cast("int").alias("times"), F.min("finish").alias("first_finish"))
    found = found.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("tie").alias("t"), "words", "times", "first_finish")
    rows = units.join(found, same("doc_id", "d") & same("source", "s") & (F.col("tie") == F.col("t")), "left")
    rows = rows.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    taken = shares(F.coalesce("words", F.lit(0)), F.col("n"), F.col("number"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.coalesce("times", F.lit(0)).alias("passes"), "first_finish")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, range-sorted by virtual finish time: the columns of ``docs`` for every
    pass of a document, and ``mix_pass``, ``mix_finish`` (1 of a document that its source's target
    cuts) and ``mix_words``.  The text of a document that is cut is its first ``mix_words`` words, with the space
    before and between them; what is taken of equal rows is dealt out as evenly as whole words allow."""
    units, queue = fair_queue(docs, **options)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    rows = rows.withColumn("tie", F.md5(F.coalesce("row.text", F.lit(""))))
    q = queue.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("tie").alias("t"), "size", "n", "pass", "key", "finish", "taken")
    rows = rows.join(q, F.col("row.doc_id").cast("long").eqNullSafe(F.col("d")) & F.col("row.source").eqNullSafe(F.col("s")) & (F.col("tie") == F.col("t")))
    partial = F.col("taken") < F.col("size") * F.col("n")
    several = partial & (F.col("n") > 1)
    # only a few documents are cut: the rows that such a one repeats are numbered, equal rows together
    unit = ["d", "s", "t", "pass"]
    cut = rows.where(several).withColumn("mark", F.xxhash64("row"))
    cut = cut.groupBy(*unit, "mark").agg(F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("row", "size", "n", "key", "finish", "taken")])
    upto = F.sum("m").over(Window.partitionBy(*unit).orderBy("mark"))
    cut = cut.withColumn("upto", upto).withColumn("number", F.explode(F.sequence(F.col("upto") - F.col("m") + 1, F.col("upto"))))
    rest = rows.where(~several).withColumn("number", F.lit(1).cast("long"))
    common = ["row", "size", "n", "pass", "key", "finish", "taken", "number"]
    rows = rest.select(*common).unionByName(cut.select(*common)).withColumn("each", shares(F.col("taken"), F.col("n"), F.col("number"))).where("each > 0")
    # words with the space before each, so that what is left of a text is left as it was
    words = F.regexp_extract_all(F.col("row.text"), F.lit(f"{SPACE}*{WORD}+"), F.lit(0))
    text = F.when(F.col("each") < F.col("size"), F.array_join(F.slice(words, 1, F.col("each").cast("int")), "")).otherwise(F.col("row.text"))
    out = [text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names]
    extra = [F.col("pass").alias("mix_pass"), F.least("finish", F.lit(1.0)).alias("mix_finish"), F.col("each").alias("mix_words")]
    rows = rows.select(*out, *[x for x, c in zip(extra, ("mix_pass", "mix_finish", "mix_words")) if c not in names], F.least("finish", F.lit(1.0)).alias("__time"), F.col("key").alias("__key"))
    return rows.orderBy("__time", "__key").drop("__time", "__key")


#: The same rows in DuckDB: the shuffled order is by md5 on both sides, and sums are of whole numbers.
SQL = r"""
with d as (
  select doc_id, source, md5(coalesce(text, '')) tie,
         len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::bigint size
  from documents),
s as (select source, sum(size)::bigint source_size from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end::bigint weight from s),
r as (select *, 3 * source_size cap, (3 * source_size)::double / weight ratio from w),
p as (
  select *, row_number() over o place,
         sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) left_size,
         sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0) left_weight
  from r window o as (order by ratio, source nulls last)),
f as (select *, min(case when left_size * weight <= cap * left_weight then place end) over () level from p),
g as (
  select source, source_size,
         case when level is null or place < level then cap::double
              else (weight * max(case when place = level then left_size end) over ())::bigint::double
                   / max(case when place = level then left_weight end) over () end target
  from f),
c as (
  select d.*, g.source_size, g.target, pass,
         sum(size) over (partition by d.source order by pass, md5('mix|' || pass || '|' || coalesce(doc_id::varchar, '') || '|' || tie)
                         rows unbounded preceding)::bigint so_far
  from d join g on d.source is not distinct from g.source, (select unnest([1, 2, 3]) pass) x
  where pass <= ceil(g.target / greatest(g.source_size, 1)) or pass = 1),
t as (
  select *, greatest(0, least(size, floor(target)::bigint - (so_far - size))) words
  from c)
select doc_id, any_value(size) size, any_value(source_size) source_size, any_value(target) target,
       sum(words)::bigint taken, (count(*) filter (words > 0))::int passes,
       min(so_far / target) filter (words > 0) first_finish
from t group by doc_id
"""
