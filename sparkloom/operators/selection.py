"""Quality, coverage and the choice of records.

The greedy choice takes, again and again, the record of highest quality and gain, the gain being its
features that no record so far has.  A record's value only falls while coverage grows, so records
are taken in order of the value they are taken at, and only as many of them bring something new as there
are features.  These are found on the driver from pages of the best records; all others are
taken for their quality alone, which is a rank within their lineages and one cut in the global order,
both in executors.  The driver holds a page, and never all records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.config import DIFFICULTIES, DIMENSIONS
from sparkloom.errors import GateError
from sparkloom.operators.gates import gate_fraction, gates_pass
from sparkloom.storage import dispose, stored

STEP = 0.02
#: Records that the driver looks at together for those that bring new features.
PAGE = 2000


def quality_score(fraction: Column, verified: Column, similarity: Column, difficulty: Column) -> Column:
    """0.3 gates + 0.4 verified + 0.2 novelty + 0.1 difficulty, within 0 and 1, added in this order."""
    value = F.lit(0.3) * fraction + F.lit(0.4) * F.when(verified, 1.0).otherwise(0.0)
    value = value + F.lit(0.2) * (F.lit(1.0) - similarity) + F.lit(0.1) * difficulty
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def difficulty_value(name: Column) -> Column:
    out = F.lit(None).cast("double")
    for k, v in DIFFICULTIES.items():
        out = F.when(name == k, v).otherwise(out)
    return out


def coverage_features(dimensions: str = "dimensions") -> Column:
    return F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(f"{dimensions}.{d}").alias("value")) for d in DIMENSIONS])


def coverage_counts(rows: DataFrame, features: Column) -> DataFrame:
    """dimension, value and n; one scan, combined before the shuffle."""
    return rows.select(F.explode(features).alias("f")).groupBy("f.dimension", "f.value").agg(F.count("*").alias("n"))


def counts_by(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The same for flat columns: {dimension: column}."""
    features = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("value")) for d, c in columns.items()])
    return coverage_counts(rows, features)


def floor_deficits(counts: DataFrame, floors: list[tuple[str, str, int]]) -> DataFrame:
    """Floors that the counts do not reach: dimension, value, floor, have, deficit."""
    wanted = counts.sparkSession.createDataFrame(floors, "dimension string, value string, floor long")
    rows = F.broadcast(wanted).join(counts, ["dimension", "value"], "left").withColumn("have", F.coalesce("n", F.lit(0)))
    return rows.where("have < floor").select("dimension", "value", "floor", "have", (F.col("floor") - F.col("have")).alias("deficit"))


def ranked(rows: DataFrame, partition: str, order: list[Column], name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(partition).orderBy(*order)))


def top_per_lineage(rows: DataFrame, k: int, lineage: str = "lineage_id", score: str = "quality_score", id: str = "record_id") -> DataFrame:
    """At most ``k`` rows of each lineage, best first, ties by id.  Spark pushes the rank limit below
    the shuffle, so a large lineage leaves k rows a task."""
    return ranked(rows, lineage, [F.col(score).desc(), F.col(id)]).where(F.col("rank") <= k)


def feature_names(columns: dict[str, Column | str]) -> Column:
    """Features as an array of names, ``dimension=value``; a null value is one of its own."""
    each = [F.concat(F.lit(f"{d}="), F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\0"))) for d, c in columns.items()]
    return F.array_distinct(F.array(*each))


def first_rows(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a global order.  Range partitions before the one with the cut are kept whole, so no
    task sorts more than a partition."""
    if n <= 0:
        return rows.limit(0)
    count = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stored(rows.repartitionByRange(count, *order).withColumn("__range", F.spark_partition_id()), "ordered")
    sizes = sorted(placed.groupBy("__range").count().collect())  # a row for each partition
    before = 0
    for at, size in sizes:
        if before + size > n:
            last = placed.where(F.col("__range") == at).orderBy(*order).limit(n - before)
            return placed.where(F.col("__range") < at).unionByName(last).drop("__range")
        before += size
    return placed.drop("__range")


def best_first(value: str = "quality") -> list[Column]:
    return [F.col(value).desc(), F.col("id")]


def within_cap(rows: DataFrame, cap: int) -> DataFrame:
    """Of each lineage the best rows that it has room for beside the ``used`` ones."""
    place = F.row_number().over(Window.partitionBy("lineage").orderBy(*best_first()))
    return rows.withColumn("__place", place).where(F.col("__place") <= cap - F.col("used")).drop("__place")


def with_used(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows that are not taken, and how many of their lineage are."""
    used = taken.groupBy(F.col("lineage").alias("__lineage")).agg(F.count("*").alias("used"))
    rows = rows.join(taken.select("id"), "id", "left_anti").join(used, F.col("lineage").eqNullSafe(F.col("__lineage")), "left")
    return rows.withColumn("used", F.coalesce("used", F.lit(0))).drop("__lineage")


def fill_floors(table: DataFrame, target: int, cap: int, floors: list[tuple[str, int]]) -> DataFrame:
    """The rows that the floors take, in turn, each from the best rows that have its feature: id, lineage, quality,
    features and phase.  Raises where a floor cannot be met."""
    taken = table.limit(0).withColumn("phase", F.lit(0))
    total = 0
    for phase, (feature, floor) in enumerate(floors):
        have = taken.where(F.array_contains("features", feature)).count()
        room = min(floor - have, target - total)
        if floor > have:
            rows = within_cap(with_used(table.where(F.array_contains("features", feature)), taken), cap)
            picks = stored(first_rows(rows.drop("used"), best_first(), room).withColumn("phase", F.lit(phase)), "floor")
            got = picks.count()
            if have + got < floor:
                raise GateError(f"{feature} has a floor of {floor}, but only {have + got} records can be taken for it")
            taken, total = taken.unionByName(picks), total + got
    return taken


def first_gains(taken: DataFrame) -> DataFrame:
    """id and gain: of how many features a row is the first in the order of taking."""
    order = F.struct("phase", (-F.col("quality")).alias("q"), "id")
    firsts = taken.select(order.alias("order"), F.explode("features").alias("f")).groupBy("f").agg(F.min("order").alias("order"))
    gains = firsts.groupBy(F.col("order.id").alias("__id")).agg(F.count("*").alias("gain"))
    return taken.join(gains, F.col("id") == F.col("__id"), "left").select("id", F.coalesce("gain", F.lit(0)).cast("double").alias("gain"))


def bringing_new(rows: DataFrame, covered: set[str], cap: int) -> list[tuple]:
    """(id, lineage, value, gain) of the rows that are taken for new features, in order, if the target does not end
    before.  ``rows``: id, lineage, quality, features, used, and ``ahead``, the best of its lineage.

    A row's lineage is full when its rows that are taken and its better ones, which are taken for their quality,
    reach the cap.  A page holds the rows of highest value that may be taken; those on it are worked
    off as long as one of them is better than whatever follows the page."""
    picks: list[tuple] = []
    by_lineage: dict = {}
    while True:
        # covered features and picks are as many as there are features at most
        ids = F.array(*[F.lit(p[0]) for p in picks]) if picks else F.array()
        new = F.size(F.array_except("features", F.array(*[F.lit(f) for f in sorted(covered)]) if covered else F.array().cast("array<string>")))
        own = F.lit(0)
        if by_lineage:
            counts = rows.sparkSession.createDataFrame([(k, len(v)) for k, v in by_lineage.items()], rows.select(F.col("lineage").alias("__l"), F.lit(0).alias("__own")).schema)
            found = rows.join(F.broadcast(counts), F.col("lineage").eqNullSafe(F.col("__l")), "left")
            own = F.coalesce("__own", F.lit(0))
        else:
            found = rows
        value = F.col("quality") + F.lit(STEP) * new
        better = F.size(F.filter("ahead", lambda a: ((a["quality"] > F.col("value")) | (a["quality"] == F.col("value")) & (a["id"] < F.col("id"))) & (~F.array_contains(ids, a["id"]) if picks else F.lit(True))))
        found = found.withColumn("new", new).where("new > 0").withColumn("value", value)
        if picks:
            found = found.where(~F.col("id").isin([p[0] for p in picks]))
        page = found.where(F.col("used") + own + better < cap).select("id", "lineage", "quality", "features", "used", "ahead", "value").orderBy(*best_first("value")).limit(PAGE).collect()
        if not page:
            return picks
        end = (-page[-1].value, page[-1].id) if len(page) == PAGE else None
        while page:
            best = None
            for r in page:
                gain = len(set(r.features) - covered)
                if not gain:
                    continue
                key = (-(r.quality + STEP * gain), r.id)
                if best is None or key < best[0]:
                    mine = by_lineage.get(r.lineage, ())
                    ahead = sum((-a.quality, a.id) < key and a.id not in mine for a in r.ahead)
                    if r.used + len(mine) + ahead < cap:
                        best = key, r, gain
            if best is None or end and best[0] > end:
                break
            key, r, gain = best
            picks.append((r.id, r.lineage, -key[0], float(gain)))
            by_lineage.setdefault(r.lineage, set()).add(r.id)
            covered |= set(r.features)
            page.remove(r)


def coverage_selection(rows: DataFrame, target: int, cap: int, floors: list[tuple[str, int]]) -> DataFrame:
    """id and gain of the records that greedy coverage takes from ``rows``: id, lineage, quality and features (names).

    Floors first, in the order given, each from the best rows with its feature; then the row of highest quality
    + STEP * new features, ties by id, until ``target``.  No lineage gives more than ``cap`` rows; a null lineage is one."""
    spark = rows.sparkSession
    table = stored(rows.select("id", "lineage", "quality", "features"), "eligible")
    taken = fill_floors(table, target, cap, floors)
    covered = {r[0] for r in taken.select(F.explode("features")).distinct().collect()}
    # of a lineage's rows with the same features only the best can be taken
    place = F.row_number().over(Window.partitionBy("lineage", "features").orderBy(*best_first()))
    left = with_used(table, taken).where(F.col("used") < cap).withColumn("__place", place).where(F.col("__place") <= cap).drop("__place")
    left = stored(left, "left")
    ranked_ = left.withColumn("__place", F.row_number().over(Window.partitionBy("lineage").orderBy(*best_first()))).where(F.col("__place") <= cap)
    best = ranked_.groupBy(F.col("lineage").alias("__l")).agg(F.collect_list(F.struct("quality", "id")).alias("ahead"))
    known = stored(left.join(best, F.col("lineage").eqNullSafe(F.col("__l"))).drop("__l"), "known")
    picks = bringing_new(known, covered, cap)
    gained = spark.createDataFrame(picks, known.select("id", "lineage", F.col("quality").alias("value"), F.lit(0.0).alias("gain")).schema)
    plain = with_used(left.drop("used"), taken.select("id", "lineage").unionByName(gained.select("id", "lineage")))
    plain = within_cap(plain, cap).select("id", F.col("quality").alias("value"), F.lit(0.0).alias("gain"))
    filled = first_rows(plain.unionByName(gained.select("id", "value", "gain")), best_first("value"), target - taken.count())
    out = stored(first_gains(taken).unionByName(filled.select("id", "gain")), "chosen")
    dispose(table, left, known)
    return out


def scored(evaluated: DataFrame) -> DataFrame:
    """Eligible records with quality_score."""
    rows = evaluated.where(gates_pass(F.col("validation"), F.col("verification.passed"), F.col("contamination.passed")))
    score = quality_score(gate_fraction(F.col("validation")), F.col("verification.passed"), F.col("contamination.similarity"), difficulty_value(F.col("dimensions.difficulty")))
    return rows.withColumn("quality_score", score)


def select(evaluated: DataFrame, quality) -> DataFrame:
    """The selected records with quality_score, coverage_score and selected."""
    rows = scored(evaluated)
    features = feature_names({d: f"dimensions.{d}" for d in DIMENSIONS})
    floors = [(f"{d}={v}", n) for d, v, n in quality.floors()]
    eligible = rows.select(F.col("record_id").alias("id"), F.col("lineage_id").alias("lineage"), F.col("quality_score").alias("quality"), features.alias("features"))
    chosen = coverage_selection(eligible, quality.target_size, quality.max_per_lineage, floors)
    out = rows.join(chosen.select(F.col("id").alias("__id"), F.col("gain").alias("coverage_score")), F.col("record_id") == F.col("__id")).drop("__id")
    return out.withColumn("selected", F.lit(True))


def ledger(evaluated: DataFrame, selected: DataFrame) -> DataFrame:
    """Every record that was not selected, with its reasons; a clean one lost to coverage or capacity."""
    rows = evaluated.join(selected.select("record_id"), "record_id", "left_anti")
    gates = F.transform(F.filter("validation", lambda g: g["status"] == "fail"), lambda g: g["gate"])
    verified = F.when(F.col("verification.passed"), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("verification:"), F.col("verification.kind"))))
    dirty = F.when(F.col("contamination.passed"), F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("contamination:"), F.col("contamination.match_type"), F.lit(":"), F.col("contamination.match_id")))
    )
    reasons = F.concat(gates, verified, dirty)
    reasons = F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("not_selected:coverage_or_capacity")))
    return rows.select("record_id", "seed_id", "lineage_id", reasons.alias("reasons"))
