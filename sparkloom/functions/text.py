"""Text expressions: Python's notions of white space, case and words, as Spark columns."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Python's str.strip() class in Java's dialect.
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def casefold(text: Column) -> Column:
    """Case folding without Python: right for text whose only special fold is sharp s."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def normalize(text: Column) -> Column:
    """Folded words separated by one space; compatibility forms are left as they are."""
    words = F.regexp_replace(casefold(text), rf"[^\p{{L}}\p{{N}}_]|{SPACE}", " ")
    return F.trim(F.regexp_replace(words, " +", " "))


@F.pandas_udf(StringType())
def normalize_exact(text: pd.Series) -> pd.Series:
    """NFKC, full case folding, everything but word characters to spaces, spaces collapsed."""

    def one(value: str | None) -> str | None:
        if value is None:
            return None
        folded = unicodedata.normalize("NFKC", value).casefold()
        return " ".join(re.sub(r"[^\w\s]", " ", folded).split())

    return text.map(one)


def tokens(normalized: Column) -> Column:
    """Words of a normalized text; none for an empty one, where split would give ['']."""
    return F.when(normalized == "", F.array().cast("array<string>")).otherwise(F.split(normalized, " "))


def bigram_features(words: Column) -> Column:
    """Words and their neighbouring pairs, with repetitions."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit("::"), b))
    return F.concat(words, pairs)


def shingles(words: Column, width: int = 3) -> Column:
    """Distinct runs of ``width`` words; a shorter text is one run, an empty one the run ''.

    Shifted slices are zipped: an index into ``words`` inside a lambda would compute it anew for
    every element."""
    count = F.greatest(F.size(words) - (width - 1), F.lit(0))
    runs = F.slice(words, 1, count)
    for k in range(1, width):
        runs = F.zip_with(runs, F.slice(words, k + 1, count), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(count == 0, F.array(F.array_join(words, " "))).otherwise(F.array_distinct(runs))


def shingle_hashes(hashes: Column, width: int = 3) -> Column:
    """Distinct 64-bit names of the runs of ``width`` words, given the words' hashes.

    ``hashes`` must be a column of the frame: it is used several times."""
    count = F.greatest(F.size(hashes) - (width - 1), F.lit(0))
    runs = F.slice(hashes, 1, count)
    for k in range(1, width):
        runs = F.zip_with(runs, F.slice(hashes, k + 1, count), lambda a, b: F.xxhash64(a, b))
    short = F.array(F.xxhash64(F.lit(width), F.size(hashes), F.get(hashes, F.lit(0)), *[F.get(hashes, F.lit(k)) for k in range(1, width - 1)]))
    return F.when(count == 0, short).otherwise(F.array_distinct(runs))


def with_shingles(rows: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``s``, the names of the normalized text's word trigrams.

    Words, their hashes and the runs are columns one upon the other: each is used more than once
    by the next, so the optimizer leaves them apart and each is computed once for a row."""
    words = rows.select(*keep, normalize(text).alias("__n")).select(*keep, tokens(F.col("__n")).alias("__w"))
    hashes = words.select(*keep, F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    return hashes.select(*keep, shingle_hashes(F.col("__h")).alias("s"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets given as arrays; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def cosine(a: Column, b: Column) -> Column:
    """Dot product of unit vectors, clamped to 0..1."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot))


def unit(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(F.transform(v, lambda x: x.cast("double")))


def found_identifiers(text: Column, identifiers: Column) -> Column:
    """Those of an array of identifiers that occur in the text whatever the case, sorted."""
    folded = casefold(text)
    hits = F.filter(identifiers, lambda i: (i != "") & F.contains(folded, casefold(i)))
    return F.array_sort(F.array_distinct(hits))


def checksum_entry(line: Column) -> Column:
    """``<digest>  <name>`` as a struct; null fields when the line is malformed."""
    ok = line.rlike(r"\A[0-9a-f]{64}  [A-Za-z0-9][A-Za-z0-9._-]*\z")
    part = lambda i: F.when(ok, F.get(F.split(line, "  ", 2), F.lit(i)))
    return F.struct(part(0).alias("sha256"), part(1).alias("name"))
