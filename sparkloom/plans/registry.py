"""Registered queries: each operator over the test tables, with its DuckDB equivalent.

A query derives what an operator needs (a lineage, an answer, a decision) from the tables at
hand and leaves the work to the operator.  All of them run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.config import Quality
from sparkloom.functions import canonical as C
from sparkloom.functions import fingerprint as FP
from sparkloom.functions import text as T
from sparkloom.operators import broker, calibration, dedup, gates, review, selection, splits, verifiers
from sparkloom.operators import referential as R
from sparkloom.plans import eventlog
from sparkloom.sources.sinks import Files
from sparkloom.storage import new_folder, stored
from sparkloom.streaming import leases

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
SALT = "stable-salt"
SPLIT = splits.Split(SALT, 0.8, 0.1, 0.1)


def query(oracle: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column: str):
    """Whole seconds since 1970 of a timestamp without zone, whatever the session's zone: the nearest, of two the even
    one, as DuckDB's cast of a double to a whole number."""
    return F.expr(f"rint(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column}) / 1e6D)")


# DuckDB's forms of what several queries use.
POINT = f"('0x' || substr(sha256('{SALT}:' || {{0}}), 1, 16))::ubigint::double / 18446744073709551616.0"
SPLIT_SQL = f"case when {POINT} < 0.8::double then 'train' when {POINT} < 0.8::double + 0.1::double then 'validation' else 'test' end"
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NORMAL_SQL = r"trim(regexp_replace(regexp_replace(replace(lower({0}), 'ß', 'ss'), '[^\p{{L}}\p{{N}}_]', ' ', 'g'), ' +', ' ', 'g'))"
FOLD_SQL = "replace(lower({0}), 'ß', 'ss')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def split_sql(lineage: str) -> str:
    return SPLIT_SQL.format(lineage)


# ------------------------------------------------------------------ splits and transforms


@query(f"select doc_id, source lineage, {POINT.format('source')} point, {split_sql('source')} split from documents")
def split_assign(spark, sf_dir):
    """A lineage's split by salted hash."""
    point = splits.split_point(F.col("source"), SALT)
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("lineage"), point.alias("point"), splits.assign_split(F.col("source"), SPLIT).alias("split"))


@query(f"select {split_sql('o_orderkey::varchar')} split, count(*) n from orders group by 1")
def split_counts(spark, sf_dir):
    """A2: rows by split."""
    return table(spark, sf_dir, "orders").select(splits.assign_split(F.col("o_orderkey").cast("string"), SPLIT).alias("split")).groupBy("split").agg(F.count("*").alias("n"))


@query(f"select {split_sql('c_custkey::varchar')} split, count(distinct c_custkey) capacity, greatest(1000 - count(distinct c_custkey), 0) deficit from customer group by 1")
def split_capacity(spark, sf_dir):
    """Distinct lineages by split against a floor."""
    return R.split_capacity(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("lineage")), "lineage", SPLIT, 1000)


@query(
    f"""with o as (select o_custkey, {split_sql("o_orderkey::varchar")} split from orders)
    select o_custkey::varchar lineage, count(distinct split) splits from o group by 1 having count(distinct split) > 1"""
)
def split_leakage(spark, sf_dir):
    """A5: lineages whose rows fall into several splits."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("lineage"), splits.assign_split(F.col("o_orderkey").cast("string"), SPLIT).alias("split"))
    return R.crossing_lineages(rows)


def _plan_sql() -> str:
    rows = []
    for i, (name, template) in enumerate(splits.TRANSFORMS.items()):
        rows.append(f"({i}, '{name}', '{template}')")
    return f"""select item_id, candidate_index, transform_id, replace(template, '{{question}}', text) prompt
    from benchmark, (values {", ".join(rows)}) t(candidate_index, transform_id, template)"""


@query(_plan_sql())
def transform_plan(spark, sf_dir):
    """Every question with every controlled transform."""
    rows = splits.expand_questions(table(spark, sf_dir, "benchmark"), "text", 10)
    return rows.select("item_id", "candidate_index", "transform_id", "prompt")


# ------------------------------------------------------------------ text


@query(f"select doc_id, sha256({NORMAL_SQL.format('text')}) digest, len({NORMAL_SQL.format('text')}) chars from documents")
def normalized_text(spark, sf_dir):
    """folded words only."""
    n = T.normalize(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", C.digest(n).alias("digest"), F.length(n).cast("long").alias("chars"))


@query(f"select doc_id, sha256({NORMAL_SQL.format('text')}) digest from documents")
def normalized_text_exact(spark, sf_dir):
    """F1 with NFKC and full case folding in Arrow batches."""
    return table(spark, sf_dir, "documents").select("doc_id", C.digest(T.normalize_exact(F.col("text"))).alias("digest"))


@query(
    f"""with t as (select doc_id, string_split({NORMAL_SQL.format("text")}, ' ') w from documents)
    select doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))).len() shingles,
    greatest(len(w) * 2 - 1, 0) features from t"""
)
def word_trigrams(spark, sf_dir):
    """Distinct word trigrams, and unigram plus bigram features."""
    w = T.tokens(T.normalize(F.col("text")))
    rows = table(spark, sf_dir, "documents").select("doc_id", w.alias("w"))
    return rows.select("doc_id", F.size(T.shingles(F.col("w"))).cast("long").alias("shingles"), F.size(T.bigram_features(F.col("w"))).cast("long").alias("features"))


@query("select * from (select a.vec_id a, b.vec_id b, list_cosine_similarity(a.embedding::double[], b.embedding::double[]) c from embeddings a, embeddings b where a.vec_id % 20 = 0 and a.vec_id <> b.vec_id) p, lateral (select round(c, 6) cosine) where c >= 0.3".replace("select * from", "select a, b, cosine from"))
def embedding_cosine(spark, sf_dir):
    """queries (vec_id divisible by 20) against all vectors, pairs at a threshold."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", T.unit(F.col("embedding")).alias("v"))
    pairs = R.query_pairs(rows, "vec_id", "v", F.col("vec_id") % 20 == 0, 0.3)
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


# ------------------------------------------------------------------ duplicates and protected items


@query("select doc_id, min(doc_id) over (partition by sha256(text)) first_id, count(*) over (partition by sha256(text)) > 1 repeated from documents")
def exact_duplicates(spark, sf_dir):
    """First occurrence of each content."""
    rows = table(spark, sf_dir, "documents").select("doc_id", C.digest(F.col("text")).alias("content"))
    return dedup.first_occurrence(rows, "content", "doc_id").select("doc_id", "first_id", (F.col("equal") > 1).alias("repeated"))


@query("select sha256(text) content, count(*) n from documents group by 1 having count(*) > 1")
def duplicate_content(spark, sf_dir):
    """A4: digests that occur more than once."""
    return R.repeated(table(spark, sf_dir, "documents").select(C.digest(F.col("text")).alias("content")), "content")


NEAR_SQL = f"""with t as (
  select min(doc_id) doc_id, string_split({NORMAL_SQL.format("text")}, ' ') w from documents group by 2),
s as (select doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) s from t),
f as (select doc_id, len(s) n, unnest(s) x from s),
p as (select a.doc_id a, b.doc_id b, a.n na, b.n nb, count(*) i from f a join f b on a.x = b.x and a.doc_id < b.doc_id group by all)
select a id_a, b id_b, i inter, na size_a, nb size_b from p where i / (na + nb - i) >= 0.86"""


@query(NEAR_SQL)
def lexical_near_dups(spark, sf_dir):
    """Pairs of different normalized texts at the lexical threshold, each text by its first id."""
    pairs = dedup.shingle_pairs(table(spark, sf_dir, "documents"), "doc_id", "text", 0.86)
    return pairs.select("id_a", "id_b", *[F.col(c).cast("long").alias(c) for c in ("inter", "size_a", "size_b")])


OVERLAP_SQL = f"""with d as (select doc_id, string_split({NORMAL_SQL.format("text")}, ' ') w from documents),
i as (select item_id, string_split({NORMAL_SQL.format("text")}, ' ') w from benchmark),
ds as (select doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' ')))) x from d),
s as (select item_id, list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) s from i),
f as (select item_id, len(s) n, unnest(s) x from s),
p as (select doc_id, item_id, n, count(*) shared from ds join f using (x) group by all)
select doc_id, item_id, shared, n item_shingles, shared / n containment from p where shared / n >= 0.86"""


@query(OVERLAP_SQL)
def benchmark_overlap(spark, sf_dir):
    """Documents that hold most trigrams of a protected item."""
    return R.containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 0.86)


def verdicts(spark, sf_dir, hash: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("record_id"), F.col("source").alias("lineage_id"), F.col("text").alias("question"), C.digest(F.col("text")).alias("content_sha256")
    )
    items = table(spark, sf_dir, "benchmark").select(F.lpad(F.col("item_id").cast("string"), 12, "0").alias("benchmark_id"), F.col("text").alias("question"))
    out = dedup.decontaminate(docs, items, Quality(), hash)
    return out.select("record_id", "contamination.passed", "contamination.match_type", "contamination.match_id", F.round("contamination.similarity", 6).alias("similarity"), "contamination.detail")


@query()
def simhash_lsh_dedup(spark, sf_dir):
    """the full verdict over BLAKE2b fingerprints; tested against a sequential model."""
    return verdicts(spark, sf_dir, "blake2b")


#: Features, bits, vectors and trigrams of all texts; then every pair that shares a band, scored.
FINGERPRINT_SQL = f"""with t as (
  select lpad(doc_id::varchar, 12, '0') id, 0 kind, source lineage, {NORMAL_SQL.format("text")} n, sha256(text) content from documents where text is not null union all
  select lpad(item_id::varchar, 12, '0'), 1, null, {NORMAL_SQL.format("text")}, null from benchmark where text is not null),
w as (select *, case when n = '' then [] else string_split(n, ' ') end w from t),
f as (select id, kind, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || '::' || w[i + 1])) f from w),
h as (select id, kind, ('0x' || substr(sha256(f), 1, 8))::bigint hi, ('0x' || substr(sha256(f), 9, 8))::bigint lo from f),
c as (select id, kind, b, sum((case when b < 32 then lo else hi end >> (b % 32)) & 1) ones, count(*) n from h, range(64) r(b) group by id, kind, b),
s as (select id, kind, (b // 8)::int band, sum(case when 2 * coalesce(ones, 0) >= coalesce(n, 0) then 1 << (b % 8) else 0 end)::int as key
      from (select id, kind, b from w, range(64) r(b)) left join c using (id, kind, b) group by id, kind, band),
v as materialized (select id, kind, ((hi::hugeint * 4294967296 + lo) % 384)::int i, sum(case when (lo >> 8) & 1 = 1 then 1 else -1 end)::bigint x from h group by id, kind, i having x <> 0),
n as (select id, kind, coalesce(sum(x * x), 0)::double n from w left join v using (id, kind) group by id, kind),
g as materialized (select id, kind, unnest(list_distinct(case when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end)) g from w),
gn as (select id, kind, count(*) n from g group by id, kind),
"""
NEAR_SQL = f"lex >= {Quality().near_duplicate_threshold} or sem >= {Quality().semantic_threshold}"
VERDICT_SQL = FINGERPRINT_SQL + f"""d as (select id, lineage, content, min(id) over (partition by content) first from w where kind = 0),
p as materialized (select distinct x.id a, y.id b, y.kind from s x join s y using (band, key) where x.kind = 0 and (y.kind = 1 or y.id < x.id) and x.id in (select id from d where first = id)),
dots as (select a, b, p.kind, sum(x.x * y.x) dot from p join v x on x.id = a and x.kind = 0 join v y on y.id = b and y.kind = p.kind and y.i = x.i group by a, b, p.kind),
both_ as (select a, b, p.kind, count(*) n from p join g x on x.id = a and x.kind = 0 join g y on y.id = b and y.kind = p.kind and y.g = x.g group by a, b, p.kind),
scored as (
  select a, b, p.kind, coalesce(m.n, 0) / (ga.n + gb.n - coalesce(m.n, 0)) lex,
         case when na.n * nb.n > 0 then greatest(0, least(1, coalesce(dot, 0)::double / sqrt(na.n * nb.n))) else 0 end sem, x.lineage is distinct from y.lineage other
  from p left join dots using (a, b, kind) left join both_ m using (a, b, kind)
  join n na on na.id = a and na.kind = 0 join n nb on nb.id = b and nb.kind = p.kind join gn ga on ga.id = a and ga.kind = 0 join gn gb on gb.id = b and gb.kind = p.kind
  join w x on x.id = a and x.kind = 0 join w y on y.id = b and y.kind = p.kind),
hits as (
  select a, min({{'b': b, 'lex': lex, 'sem': sem}}) filter (kind = 1 and ({NEAR_SQL})) item, min({{'b': b, 'lex': lex, 'sem': sem}}) filter (kind = 0 and other and ({NEAR_SQL})) near,
         max(greatest(lex, sem)) filter (kind = 0) nearest from scored group by a),
verdict as (
  select lpad(doc_id::varchar, 12, '0') record_id, case when d.first < d.id then 'exact_record' when item is not null then 'protected_benchmark' when near is not null then 'cross_lineage_near_duplicate' end match_type,
         case when d.first < d.id then null when item is not null then item when near is not null then near end hit, first, nearest
  from documents left join d on d.id = lpad(doc_id::varchar, 12, '0') left join hits on a = d.id)
select record_id, match_type is null passed, match_type, case when match_type = 'exact_record' then first else hit.b end match_id,
       round(case when match_type = 'exact_record' then 1 when match_type is not null then greatest(hit.lex, hit.sem) else coalesce(nearest, 0) end, 6) similarity,
       case when match_type = 'exact_record' then 'canonical question/answer duplicate' when match_type is not null then format('lexical={{:.3f}}; semantic={{:.3f}}', hit.lex, hit.sem)
            when nearest > 0 then format('nearest candidate similarity={{:.3f}}', nearest) else 'no material overlap detected' end detail
from verdict"""


@query(VERDICT_SQL)
def simhash_sha256_dedup(spark, sf_dir):
    """The full verdict over SHA-256 fingerprints, which are DataFrame operations."""
    return verdicts(spark, sf_dir, "sha256")


@query(
    FINGERPRINT_SQL
    + """vs as (select id, kind, string_agg(i || ':' || x, ',' order by i) vector from v group by id, kind),
    ss as (select id, kind, string_agg(key, ',' order by band) bands from s group by id, kind)
    select id record_id, bands, coalesce(vector, '') vector, n.n::bigint norm, gn.n trigrams from w
    left join vs using (id, kind) join ss using (id, kind) join n using (id, kind) join gn using (id, kind) where kind = 0"""
)
def sha256_fingerprints(spark, sf_dir):
    """Band keys of the signature, the signed feature vector, its squared norm and the number of trigrams."""
    docs = table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("record_id"), "text")
    rows = FP.sha256_fingerprints(docs, "record_id", "text")
    keys = F.array_join(F.transform(FP.band_keys(F.col("fp.signature"), 8), lambda k: k["key"].cast("string")), ",")
    vector = F.array_join(F.transform(F.arrays_zip(F.col("fp.idx").alias("i"), F.col("fp.weights").alias("w")), lambda x: F.concat(x["i"].cast("string"), F.lit(":"), x["w"].cast("string"))), ",")
    return rows.select("record_id", keys.alias("bands"), vector.alias("vector"), F.col("fp.norm").alias("norm"), F.size("fp.shingles").cast("long").alias("trigrams"))


# ------------------------------------------------------------------ gates

RE2_PHONE = r"(^|\W)(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}(\W|$)"


def hits_sql(patterns: dict, text: str) -> str:
    tests = []
    for name in sorted(patterns):
        flags, pattern = patterns[name]
        ci = "(?i)" if "i" in flags else ""
        tests.append(f"case when regexp_matches({text}, '{RE2_PHONE if name == 'phone' else ci + pattern}') then '{name}' end")
    return f"array_to_string(list_filter([{', '.join(tests)}], lambda x: x is not null), ',')"


@query(f"select doc_id, {hits_sql(gates.SECRETS, 'text')} secrets, {hits_sql(gates.PERSONAL, 'text')} pii, {hits_sql(gates.INJECTION, 'text')} injection from documents")
def pii_secret_gates(spark, sf_dir):
    """Names of the patterns that match."""
    cols = [F.array_join(gates.hits(F.col("text"), p), ",").alias(n) for n, p in (("secrets", gates.SECRETS), ("pii", gates.PERSONAL), ("injection", gates.INJECTION))]
    return table(spark, sf_dir, "documents").select("doc_id", *cols)


@query(f"select conv_id, turn, {hits_sql(gates.INJECTION, 'text')} injection, {hits_sql(gates.PERSONAL, 'text')} pii from conversations")
def injection_gate(spark, sf_dir):
    """G9, G10 over conversations."""
    cols = [F.array_join(gates.hits(F.col("text"), p), ",").alias(n) for n, p in (("injection", gates.INJECTION), ("pii", gates.PERSONAL))]
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", *cols)


_TURNS_SQL = f"""with s as (select conv_id, turn, text, {strip_sql("text")} t, string_split(text, '\n') d from conversations),
x as (select conv_id, turn, len(t) >= 12 question_length, len(t) >= 1 answer_length,
  len(d) > 0 and len(list_filter(d, lambda y: len({strip_sql("y")}) not between 24 and 2048)) = 0 derivation_structure,
  {FOLD_SQL.format("t")} <> {FOLD_SQL.format(strip_sql("case when turn % 3 = 0 then upper(text) || chr(10) else text || ' more' end"))} derivation_distinct,
  not contains(text, 'Derivation:') and not contains(text, 'Final answer:') output_marker_collision from s)
select * from x"""


@query(_TURNS_SQL)
def length_and_structure_gates(spark, sf_dir):
    """A turn as its own question, answer and, by lines, derivation."""
    text, d = F.col("text"), F.split("text", "\n")
    folded = lambda c: T.casefold(T.strip(c))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", gates.length_ok(text, 12).alias("question_length"), gates.length_ok(text, 1).alias("answer_length"), gates.derivation_ok(d, 24).alias("derivation_structure"),
        (folded(F.array_join(d, "\n")) != folded(F.when(F.col("turn") % 3 == 0, F.concat(F.upper(text), F.lit("\n"))).otherwise(F.concat(text, F.lit(" more"))))).alias("derivation_distinct"), gates.marker_free(d, text).alias("output_marker_collision"),
    )


@query(
    f"""with g as (select d.doc_id, coalesce(quality, 0) verified, len({strip_sql("text")}) >= 12 a, {hits_sql(gates.PERSONAL, "text")} = '' b, lang = 'en' c,
      coalesce(toxic, 0) / 2.0 similarity from documents d left join labels l using (doc_id))
    select doc_id, (a::int + b::int + c::int) / 3 fraction,
      round(greatest(0, least(1, 0.3::double * ((a::int + b::int + c::int) / 3) + 0.4::double * verified + 0.2::double * (1 - similarity) + 0.1::double * 0.6)), 9) quality,
      a and b and c and verified = 1 eligible from g"""
)
def gate_fraction_quality(spark, sf_dir):
    """Share of passed gates, quality score and eligibility."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    results = [("length", gates.length_ok(F.col("text"), 12)), ("pii", F.size(gates.hits(F.col("text"), gates.PERSONAL)) == 0), ("scope", F.col("lang") == "en")]
    rows = rows.withColumn("validation", F.array(*[gates.gate(n, ok, F.lit("")) for n, ok in results])).withColumn("verified", F.coalesce("quality", F.lit(0)) == 1)
    fraction = gates.gate_fraction(F.col("validation"))
    score = selection.quality_score(fraction, F.col("verified"), F.coalesce("toxic", F.lit(0)) / 2.0, selection.difficulty_value(F.lit("intermediate")))
    return rows.select("doc_id", fraction.alias("fraction"), F.round(score, 9).alias("quality"), gates.gates_pass(F.col("validation"), F.col("verified"), F.lit(True)).alias("eligible"))


# ------------------------------------------------------------------ verifiers


@query(f"select p_partkey, {FOLD_SQL.format('trim(upper(p_brand))')} = {FOLD_SQL.format('trim(p_brand)')} same, {FOLD_SQL.format('p_type')} = {FOLD_SQL.format('p_name')} other from part")
def exact_verifier(spark, sf_dir):
    """V1: case and surrounding space do not count."""
    padded = F.concat(F.lit(" \t"), F.upper("p_brand"), F.lit("\n"))
    return table(spark, sf_dir, "part").select("p_partkey", verifiers.exact(padded, F.col("p_brand")).alias("same"), verifiers.exact(F.col("p_type"), F.col("p_name")).alias("other"))


@query(
    """select l_orderkey, l_linenumber, abs(l_extendedprice::decimal(38,10) - (l_extendedprice * (1 - l_discount))::decimal(38,10)) <= 500 close,
    abs(l_quantity::decimal(38,10) - l_tax::decimal(38,10)) <= 2 other from lineitem"""
)
def numeric_verifier(spark, sf_dir):
    """V2: the first number in a sentence against the expected one, within a tolerance."""
    plain = lambda c: c.cast("decimal(28,10)").cast("string")
    said = F.concat(F.lit("It is about "), plain(F.col("l_extendedprice")), F.lit(" in all, not 7."))
    net = plain(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", verifiers.numeric(said, net, F.lit(500.0)).alias("close"), verifiers.numeric(plain(F.col("l_quantity")), plain(F.col("l_tax")), F.lit(2.0)).alias("other")
    )


@query("select p_partkey, regexp_full_match(p_brand, 'Brand#[1-3][0-9]') matches, regexp_full_match(p_name, '(?i)[a-z]+ .*') words from part")
def regex_verifier(spark, sf_dir):
    """V3: full match of trusted patterns."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", verifiers.regex_trusted(F.col("p_brand"), "Brand#[1-3][0-9]").alias("matches"), verifiers.regex_trusted(F.col("p_name"), "(?i)[a-z]+ .*").alias("words")
    )


@query("select p_partkey, regexp_full_match(p_brand, 'Brand#' || (p_size % 5 + 1) || '[0-9]') matches from part")
def regex_verifier_untrusted(spark, sf_dir):
    """V3: a pattern for each row, with a time budget."""
    pattern = F.concat(F.lit("Brand#"), (F.col("p_size") % 5 + 1).cast("string"), F.lit("[0-9]"))
    return table(spark, sf_dir, "part").select("p_partkey", verifiers.regex_untrusted(F.col("p_brand"), pattern).alias("matches"))


@query("""select event_id, event_id % 2 = 0 reordered, (props->>'k')::bigint = user_id % 100 equal, event_id % 3 = 0 broken from events""")
def json_verifier(spark, sf_dir):
    """V4: structure counts, not spelling."""
    props = F.col("props")
    key = F.get_json_object(props, "$.k")
    both = F.concat(F.lit('{ "b":1.0, "a" : ['), key, F.lit("]}"))
    other = F.concat(F.lit('{"a":['), key, F.when(F.col("event_id") % 2 == 0, F.lit('],"b":1}')).otherwise(F.lit('],"b":2}')))
    whole = F.when(F.col("event_id") % 3 == 0, props).otherwise(F.concat(F.lit("{"), props))
    wanted = F.concat(F.lit('{"k":'), (F.col("user_id") % 100).cast("string"), F.lit("}"))
    return table(spark, sf_dir, "events").select(
        "event_id", verifiers.json_equal(both, other).alias("reordered"), verifiers.json_equal(props, wanted).alias("equal"), verifiers.json_equal(whole, props).alias("broken")
    )


@query(
    """select doc_id, source in ('src1', 'src2') cited, contains(text, '[1]') and contains(text, '[2]') marked,
    source in ('src1', 'src2') and (lang <> 'de' or contains(text, '[1]')) and (lang in ('en', 'de') or contains(text, '[2]')) passed from documents"""
)
def citation_verifier(spark, sf_dir):
    """V5: required ids among the cited ones, and their marks in the answer."""
    need = F.array(F.lit("src1"), F.lit("src2"))
    cited = F.when(F.col("source").isin("src1", "src2"), need).otherwise(F.array("source"))
    mark = lambda langs, sign: F.when(F.col("lang").isin(*langs), F.lit(sign)).otherwise(F.lit(""))
    answer = F.concat("text", F.when(F.col("lang") != "de", F.lit(" see [1]")).otherwise(F.lit("")), mark(("en", "de"), " and [2]"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", (F.size(F.array_except(need, cited)) == 0).alias("cited"), verifiers.citation(F.col("text"), need, need).alias("marked"), verifiers.citation(answer, need, cited).alias("passed"),
    )


# ------------------------------------------------------------------ training rows

_JSON_SQL = "to_json({0}::varchar)"
_PAIR_SQL = f"""with p as (select a.conv_id, a.turn, a.text q, b.text a from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1
  where a.role = 'user' and b.role = 'assistant'),
m as (select conv_id, turn, q, 'Derivation:' || chr(10) || '1. ' || {strip_sql("a")} || chr(10) || chr(10) || 'Final answer:' || chr(10) || {strip_sql("a")} r, a from p),
j as (select conv_id, turn, '{{"messages":[{{"content":' || {_JSON_SQL.format("q")} || ',"role":"user"}},{{"content":' || {_JSON_SQL.format("r")} || ',"role":"assistant"}}]}}' line,
  '{{"answer":' || {_JSON_SQL.format("a")} || ',"question":' || {_JSON_SQL.format("q")} || '}}' legacy from m)
select conv_id, turn, sha256(line) content_sha256, sha256(legacy) legacy_sha256,
  'qa_' || substr(sha256('{{"content":"' || sha256(line) || '","index":' || turn || ',"run":"run-001","seed":"' || conv_id || '"}}'), 1, 24) record_id, len(line) chars from j"""


@query(_PAIR_SQL)
def chat_training_rows(spark, sf_dir):
    """P5-P10: user and assistant turns as canonical rows, digests and record ids."""
    turns = table(spark, sf_dir, "conversations")
    after = turns.where("role = 'assistant'").select(F.col("conv_id").alias("c"), (F.col("turn") - 1).alias("t"), F.col("text").alias("answer"))
    rows = turns.where("role = 'user'").join(after, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")))
    q, a, d = F.col("text"), F.col("answer"), F.array("answer")
    line = C.training_row(q, d, a)
    return rows.select(
        "conv_id", "turn", C.digest(line).alias("content_sha256"), C.legacy_digest(q, a).alias("legacy_sha256"),
        C.record_id(C.digest(line), F.col("turn"), F.lit("run-001"), F.col("conv_id").cast("string")).alias("record_id"), F.length(line).cast("long").alias("chars"),
    )


@query("select conv_id, turn, role = 'assistant' and turn % 2 = 1 valid from conversations")
def training_row_check(spark, sf_dir):
    """P20: rendered rows pass, rows of another shape do not."""
    text = F.col("text")
    good = C.training_row(F.concat(F.lit("Q: "), text), F.array(F.lit("step")), F.concat(F.lit("a"), F.col("turn").cast("string")))
    line = F.when(F.col("role") != "assistant", F.to_json(F.struct("text"))).when(F.col("turn") % 2 == 1, good).otherwise(F.replace(good, F.lit("1. "), F.lit("2. ")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", C.is_training_row(line).alias("valid"))


# ------------------------------------------------------------------ ranking, coverage, selection


@query("select source, doc_id, n_chars, row_number() over (partition by source order by n_chars desc, doc_id) rank from documents qualify rank <= 3")
def lineage_cap_topk(spark, sf_dir):
    """The best rows of each lineage, ties by id."""
    rows = selection.top_per_lineage(table(spark, sf_dir, "documents"), 3, "source", "n_chars", "doc_id")
    return rows.select("source", "doc_id", "n_chars", F.col("rank").cast("long").alias("rank"))


_COVER_SQL = "select 'brand' dimension, p_brand value, count(*) n from part group by all union all select 'type', p_type, count(*) from part group by all union all select 'size', p_size::varchar, count(*) from part group by all"


@query(_COVER_SQL)
def coverage_counts(spark, sf_dir):
    """Counts by dimension and value."""
    return selection.counts_by(table(spark, sf_dir, "part"), {"brand": "p_brand", "type": "p_type", "size": "p_size"})


@query(
    f"""with c as ({_COVER_SQL}), f(dimension, value, floor) as (values ('brand', 'Brand#11', 50), ('brand', 'Brand#99', 5), ('size', '1', 100000), ('type', 'none', 1))
    select dimension, value, floor::bigint floor, coalesce(n, 0) have, floor - coalesce(n, 0) deficit from f left join c using (dimension, value) where coalesce(n, 0) < floor"""
)
def floor_deficits(spark, sf_dir):
    """Floors that are not reached."""
    floors = [("brand", "Brand#11", 50), ("brand", "Brand#99", 5), ("size", "1", 100000), ("type", "none", 1)]
    return selection.floor_deficits(coverage_counts(spark, sf_dir), floors)


#: A step chooses one row: of size 7 in the first three steps, by score and new values then.
GREEDY_SQL = """with recursive p as (select p_partkey id, p_brand lin, p_size::double / 50.0::double q, p_size size, ['brand:' || p_brand, 'type:' || p_type, 'size:' || p_size] f from part),
r as (select 0 n, []::bigint[] ids, []::varchar[] lins, []::varchar[] seen, null::bigint id, null::bigint gain
  union all
  select n + 1, list_append(any_value(ids), arg_max(x.id, (x.v, -x.id))::bigint), list_append(any_value(lins), arg_max(x.lin, (x.v, -x.id))),
    list_distinct(list_concat(any_value(seen), arg_max(x.f, (x.v, -x.id)))), arg_max(x.id, (x.v, -x.id))::bigint, arg_max(x.g, (x.v, -x.id))::bigint
  from (select r.n, r.ids, r.lins, r.seen, p.id, p.lin, p.f, len(list_filter(p.f, lambda y: not list_contains(r.seen, y))) g,
      p.q + case when r.n < 3 then 0 else 0.02::double * len(list_filter(p.f, lambda y: not list_contains(r.seen, y))) end v
    from r, p where r.n < 100 and not list_contains(r.ids, p.id) and len(list_filter(r.lins, lambda y: y = p.lin)) < 8 and (r.n >= 3 or p.size = 7)) x
  group by n)
select id p_partkey, gain::double gain from r where n > 0"""


@query(GREEDY_SQL)
def greedy_coverage_selection(spark, sf_dir):
    """Floors, then greedy coverage."""
    features = selection.feature_names({"brand": "p_brand", "type": "p_type", "size": "p_size"})
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("lineage"), (F.col("p_size") / 50.0).alias("quality"), features.alias("features"))
    return selection.coverage_selection(rows, 100, 8, [("size=7", 3)]).select(F.col("id").alias("p_partkey"), "gain")


# ------------------------------------------------------------------ referential and registry checks


@query(
    """select 'lineitem_part' rule, count(*) bad from lineitem where not exists (select 1 from part where p_partkey = l_partkey)
    union all select 'lineitem_supplier', count(*) from lineitem where not exists (select 1 from supplier where s_suppkey = l_suppkey)
    union all select 'lineitem_order', count(*) from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey)
    union all select 'order_customer', count(*) from orders where not exists (select 1 from customer where c_custkey = o_custkey)
    union all select 'customer_nation', count(*) from customer where not exists (select 1 from nation where n_nationkey = c_nationkey)
    union all select 'label_document', count(*) from labels where not exists (select 1 from documents where documents.doc_id = labels.doc_id)
    union all select 'order_line', count(*) from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)"""
)
def referential_checks(spark, sf_dir):
    """Rows whose reference is missing."""
    t = lambda n: table(spark, sf_dir, n)
    rules = [
        ("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"), ("lineitem_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("lineitem_order", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("order_customer", "orders", "o_custkey", "customer", "c_custkey"),
        ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"), ("label_document", "labels", "doc_id", "documents", "doc_id"),
        ("order_line", "orders", "o_orderkey", "lineitem", "l_orderkey"),
    ]
    return R.union_all([R.missing_count(rule, t(a), x, t(b), y) for rule, a, x, b, y in rules])


@query(
    """select c_nationkey nation, count(*) n, sum(c_acctbal) filter (c_acctbal < 0) overdrawn from customer
    where exists (select 1 from supplier where s_nationkey = c_nationkey and s_acctbal > 0) group by 1"""
)
def attribute_semi_join(spark, sf_dir):
    """Rows whose reference has an attribute."""
    rows = R.referencing(table(spark, sf_dir, "customer"), "c_nationkey", table(spark, sf_dir, "supplier").where("s_acctbal > 0"), "s_nationkey")
    return rows.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("c_acctbal") < 0, F.col("c_acctbal"))).alias("overdrawn"))


@query(
    """select 'documents' name, count(*) - count(distinct doc_id) extra from documents union all select 'orders', count(*) - count(distinct o_orderkey) from orders
    union all select 'conversations', count(*) - count(distinct conv_id) from conversations union all select 'part', count(*) - count(distinct p_name) from part"""
)
def unique_key_checks(spark, sf_dir):
    """A1: how many rows repeat a key."""
    keys = [("documents", "doc_id"), ("orders", "o_orderkey"), ("conversations", "conv_id"), ("part", "p_name")]
    return R.union_all([R.extra_rows(n, table(spark, sf_dir, n), k) for n, k in keys])


@query(
    """with r(reviewer, allowed) as (values ('a', ['BUILDING', 'MACHINERY']), ('b', ['HOUSEHOLD'])), c as (select distinct c_mktsegment segment from customer)
    select segment from c where not exists (select 1 from r where list_contains(allowed, '*') or list_contains(allowed, segment))"""
)
def uncovered_categories(spark, sf_dir):
    """Categories that no approved reviewer may judge."""
    reviewers = spark.createDataFrame([("a", "approved", ["BUILDING", "MACHINERY"]), ("b", "approved", ["HOUSEHOLD"]), ("c", "blocked", ["*"])], "reviewer_id string, authorization_status string, allowed_categories array<string>")
    return R.uncovered(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment")).distinct(), "segment", reviewers)


@query(
    """select doc_id, 'lang' field, lang value from documents where lang not in ('en', 'de') union all
    select doc_id, 'source', source from documents where source not in ('src0', 'src1', 'src2', 'src3')"""
)
def taxonomy_membership(spark, sf_dir):
    """Values outside a taxonomy; a dimension without values is free."""
    taxonomy = {"lang": ["en", "de"], "source": ["src0", "src1", "src2", "src3"], "free": []}
    rows = table(spark, sf_dir, "documents").withColumn("free", F.col("text"))
    return R.outside_taxonomy(rows, "doc_id", taxonomy)


@query(
    """select coalesce(d.doc_id, l.doc_id) doc_id, case when d.doc_id is null then 'unknown' when l.doc_id is null then 'missing' when n > 1 then 'duplicate' end problem
    from documents d full join (select doc_id, count(*) n from labels group by 1) l using (doc_id) where d.doc_id is null or l.doc_id is null or n > 1"""
)
def review_completeness(spark, sf_dir):
    """Decisions against selected rows, both ways."""
    return review.completeness(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query("select count(*) filter (quality = 1) approved, count(*) filter (quality = 0) rejected, count(*) filter (toxic = 1) flagged from labels")
def review_counts(spark, sf_dir):
    """Decisions counted in one pass."""
    return table(spark, sf_dir, "labels").agg(F.count_if(F.col("quality") == 1).alias("approved"), F.count_if(F.col("quality") == 0).alias("rejected"), F.count_if(F.col("toxic") == 1).alias("flagged"))


@query(
    f"""select count(*) filter ({split_sql("source")} = 'train') train, count(*) filter ({split_sql("source")} = 'validation') validation, count(*) filter ({split_sql("source")} = 'test') test,
    count(distinct lang) categories, array_to_string(list_sort(list(distinct lang)), ',') langs, max(n_chars) longest from documents"""
)
def policy_report(spark, sf_dir):
    """All policy metrics in one aggregate."""
    s = splits.assign_split(F.col("source"), SPLIT)
    metrics = [F.count_if(s == n).alias(n) for n in ("train", "validation", "test")]
    return table(spark, sf_dir, "documents").agg(
        *metrics, F.count_distinct("lang").alias("categories"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"), F.max("n_chars").alias("longest")
    )


@query(
    f"""with g as (select doc_id, source, [case when len({strip_sql("text")}) < 200 then 'question_length' end, case when {hits_sql(gates.PERSONAL, "text")} <> '' then 'pii' end,
      case when toxic = 1 then 'verification:exact' end] r from documents left join labels using (doc_id)),
    x as (select doc_id, source, array_to_string(list_filter(r, lambda y: y is not null), ',') reasons from g),
    k as (select doc_id from x where reasons = '' qualify row_number() over (partition by source order by doc_id) <= 5)
    select doc_id, source, case when reasons = '' then 'not_selected:coverage_or_capacity' else reasons end reasons from x where doc_id not in (select doc_id from k)"""
)
def rejection_ledger(spark, sf_dir):
    """K7: every row that was not selected, with its reasons."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    results = F.array(gates.gate("question_length", gates.length_ok(F.col("text"), 200), F.lit("")), gates.gate("pii", F.size(gates.hits(F.col("text"), gates.PERSONAL)) == 0, F.lit("")))
    rows = rows.select(
        F.col("doc_id").alias("record_id"), F.col("doc_id").alias("seed_id"), F.col("source").alias("lineage_id"), results.alias("validation"),
        F.struct(F.lit("exact").alias("kind"), (F.coalesce("toxic", F.lit(0)) != 1).alias("passed")).alias("verification"),
        F.struct(F.lit(True).alias("passed"), F.lit("").alias("match_type"), F.lit("").alias("match_id")).alias("contamination"), (-F.col("doc_id")).alias("quality_score"),
    )
    clean = rows.where(gates.gates_pass(F.col("validation"), F.col("verification.passed"), F.lit(True)))
    out = selection.ledger(rows, selection.top_per_lineage(clean, 5))
    return out.select(F.col("record_id").alias("doc_id"), F.col("lineage_id").alias("source"), F.array_join("reasons", ",").alias("reasons"))


@query(
    """with s as (select doc_id from documents where lang = 'en'), r as (select doc_id from labels where quality = 1)
    select (select count(*) from (select * from s except select * from r)) only_selected, (select count(*) from (select * from r except select * from s)) only_reviewed,
    (select count(*) from (select * from s intersect select * from r)) both_sides, (select count(*) from (select * from s union select * from r)) all_ids"""
)
def set_operations(spark, sf_dir):
    """O1-O3: union, difference and equality of id sets, by one full join."""
    return R.set_report(table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id"), table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"), "doc_id")


# ------------------------------------------------------------------ queue


@query("with s as (select user_id, arg_max(event_type, (ts, event_id)) state from events group by 1) select state, count(*) n from s group by 1")
def queue_status(spark, sf_dir):
    """Tasks by their latest state."""
    return broker.status(broker.latest(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"]))


_LEASE_SQL = """with e as (select user_id task, event_id, epoch(ts)::bigint sec, ts, case when event_type in ('click', 'view') then 'lease' else 'submit' end action from events),
w as (select *, max(case when action = 'lease' then sec end) over (partition by task order by ts, event_id rows between unbounded preceding and 1 preceding) last_lease from e)
select task, count(*) filter (action = 'lease') leases, count(*) filter (action = 'submit') submits,
  count(*) filter (action = 'submit' and last_lease is not null and sec <= last_lease + 900) in_time,
  count(*) filter (action = 'lease' and last_lease is not null and sec > last_lease + 900) expired from w group by 1"""


@query(_LEASE_SQL)
def lease_expiry_fold(spark, sf_dir):
    """Leases that ran out and submissions in time, from the event log."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("task"), "event_id", seconds("ts").cast("long").alias("at"), "ts", F.when(F.col("event_type").isin("click", "view"), "lease").otherwise("submit").alias("action")
    )
    return broker.lease_report(events, 900)


#: The n-th event of all tasks at each step, so as many steps as the longest history has events.
MACHINE_SQL = """with recursive e as (select user_id::varchar task, epoch(ts)::bigint::double sec, case when event_type in ('click', 'view') then 'lease' else 'submit' end action, value token,
  row_number() over (partition by user_id order by epoch(ts)::bigint, event_id) n from events),
r as (select task, 0::bigint n, 'queued' state, null::double token, 0.0::double until, 0 leases, 0 rejected from (select distinct task from e)
  union all
  select x.task, x.n, case when x.grant then 'leased' when x.take then 'submitted' else x.s end, case when x.grant then x.t else x.token end,
    case when x.grant then x.sec + 900 else x.until end, leases + x.grant::int, rejected + (not x.grant and not x.take)::int
  from (select y.*, y.action = 'lease' and y.s = 'queued' as grant, y.action = 'submit' and y.s = 'leased' and y.t is not distinct from y.token as take
    from (select r.*, e.sec, e.action, e.token t, case when r.state = 'leased' and r.until < e.sec then 'queued' else r.state end s, e.n m from r join e on r.task = e.task and e.n = r.n + 1) z,
      lateral (select z.task, z.m n, z.token, z.until, z.leases, z.rejected, z.sec, z.action, z.t, z.s) y) x)
select task task_id, arg_max(state, n) state, arg_max(leases, n)::int leases, arg_max(rejected, n)::int rejected from r group by 1"""


def task_events(spark, sf_dir) -> DataFrame:
    """The events as leases and submissions of their users; a token of -0.0 is one of 0.0."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("task_id"), seconds("ts").cast("double").alias("at"), F.col("event_id").alias("seq"), F.when(F.col("event_type").isin("click", "view"), "lease").otherwise("submit").alias("action"),
        (F.col("value") + F.lit(0.0)).cast("string").alias("token"), F.col("props").alias("answer"),
    )


@query(MACHINE_SQL)
def lease_state_machine(spark, sf_dir):
    """The full machine as a fold, one accepted submission a task."""
    return broker.fold(task_events(spark, sf_dir), 900).select("task_id", "state", "leases", "rejected")


@query(MACHINE_SQL)
def lease_snapshots(spark, sf_dir):
    """The same from a log in four parts with a snapshot after each but the last; some events of every part come with the last one, late."""
    events, log = task_events(spark, sf_dir), eventlog.EventLog(spark, Files(spark, new_folder(spark, "log")), 900)
    cuts = events.approxQuantile("at", [0.25, 0.5, 0.75], 0.01)
    part = F.when(F.col("seq") % 97 == 0, 3).when(F.col("at") < cuts[0], 0).when(F.col("at") < cuts[1], 1).when(F.col("at") < cuts[2], 2).otherwise(3)
    for number in range(4):
        log.append(events.where(part == number))
        if number < 3:
            log.snapshot(grace=0)
    return stored(log.folded(), "folded").select("task_id", "state", "leases", "rejected")


@query(MACHINE_SQL)
def lease_stream(spark, sf_dir):
    """The machine as a stream with state over the events, by its receipts."""
    folder = new_folder(spark, "stream")
    task_events(spark, sf_dir).write.parquet(f"{folder}/events")
    stream = spark.readStream.schema(leases.EVENTS).parquet(f"{folder}/events")
    leases.drain(leases.receipts(stream, 900), f"{folder}/receipts", f"{folder}/checkpoint")
    rows = spark.read.schema(leases.RECEIPTS).parquet(f"{folder}/receipts").where("seq >= 0")
    # a task's last event may stand there several times: a submission that counts is the last of what counts
    order = F.struct("at", "seq", F.col("state") == "submitted")
    counts = [F.count_if(F.col("accepted") & (F.col("action") == "lease")).cast("int").alias("leases"), F.count_if(~F.col("accepted")).cast("int").alias("rejected")]
    return rows.groupBy("task_id").agg(F.max_by("state", order).alias("state"), *counts)


# ------------------------------------------------------------------ calibration


@query(
    """select category, count(*) n from supplier, (values ('inventory-reconciliation'), ('financial-arithmetic'), ('linear-equations'),
    ('proportional-allocation'), ('robust-statistics'), ('dependency-planning'), ('set-accounting'), ('structured-aggregation'), ('deductive-logic'), ('program-tracing')) c(category) group by 1"""
)
def calibration_solved(spark, sf_dir):
    """Of the ten tasks that each supplier's number makes, under every transform, those that the blind solver gets right, by family; all of them."""
    seeds = calibration.tasks(table(spark, sf_dir, "supplier"), "s_suppkey").select("seed_id", "dimensions.category", "question", "reference_answer")
    asked = splits.expand_questions(seeds, "question", 10).withColumn("right", calibration.solve(F.col("prompt")) == F.col("reference_answer"))
    right = asked.groupBy("category", "seed_id").agg(F.every(F.coalesce("right", F.lit(False))).alias("right")).where("right")
    return right.groupBy("category").agg(F.count("*").alias("n"))


@query(
    """select i % 10 slot, case when i % 10 < 3 then 'introductory' when i % 10 < 8 then 'intermediate' else 'advanced' end difficulty,
    sum(140 + i * 7 + 31 + (i * 11) % 83 - (44 + (i * 13) % 71) - (2 + i % 9))::bigint answers from (select p_partkey i from part) group by all"""
)
def calibration_inventory(spark, sf_dir):
    """One family's closed form over the numbers of all parts, summed by difficulty slot."""
    rows = calibration.tasks(table(spark, sf_dir, "part"), "p_partkey").where("dimensions.category = 'inventory-reconciliation'")
    i = F.substring_index("seed_id", "-", -1).cast("long")
    return rows.groupBy((i % 10).alias("slot"), "dimensions.difficulty").agg(F.sum(F.col("reference_answer").cast("long")).alias("answers"))


@query(f"""select item_id, greatest(0, 1000 - len(text)) room, sha256(text) digest, len(text) <= 16384 and not contains({FOLD_SQL.format("text")}, 'tion that') and not contains({FOLD_SQL.format("text")}, 'blees') allowed from benchmark""")
def prompt_guard(spark, sf_dir):
    """Prompts within bounds that show no private identifier; some show one, whatever its case."""
    rows = broker.guard(table(spark, sf_dir, "benchmark"), "text", ["SRC-PILOT-AUTHORED", "Tion That", "BLEES"])
    return rows.select("item_id", F.greatest(F.lit(0), 1000 - F.length("text")).cast("long").alias("room"), C.digest(F.col("text")).alias("digest"), "allowed")
