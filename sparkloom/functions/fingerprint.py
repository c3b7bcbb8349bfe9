"""The question fingerprint: one Arrow hop gives all that similarity joins need."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T

SCHEMA = "exact string, shingles array<long>, idx array<int>, weights array<int>, norm long, signature long"


def words_of(value: str) -> list[str]:
    folded = unicodedata.normalize("NFKC", value).casefold()
    return re.sub(r"[^\w\s]", " ", folded).split()


#: The first eight bytes of a digest, by name.
EIGHT = {"blake2b": lambda b: hashlib.blake2b(b, digest_size=8).digest(), "sha256": lambda b: hashlib.sha256(b).digest()[:8]}


def eight_bytes(texts, hash: str) -> np.ndarray:
    """Big-endian 64-bit numbers of some strings."""
    eight = EIGHT[hash]
    return np.frombuffer(b"".join([eight(t.encode()) for t in texts]), ">u8").astype(np.uint64)


def feature_hashes(words: list[str], hash: str = "blake2b") -> np.ndarray:
    """64-bit hashes of every word and of every neighbouring pair; a word of a text is hashed once."""
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    alone = eight_bytes(place, hash)[[place[w] for w in words]] if words else np.zeros(0, np.uint64)
    return np.concatenate([alone, eight_bytes([f"{a}::{b}" for a, b in zip(words, words[1:])], hash)])


def signature(hashes: np.ndarray) -> int:
    """A bit is set when at least half the features have it, so also when there are none."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits >= len(hashes), bitorder="little").tobytes(), "little")


def fingerprint_one(words: list[str], dimensions: int, hash: str = "blake2b") -> tuple:
    hashes = feature_hashes(words, hash)
    runs = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    shingles = np.sort(eight_bytes(runs, hash).view(np.int64))
    place = (hashes % np.uint64(dimensions)).astype(np.int64)
    sign = np.where((hashes >> np.uint64(8)) & np.uint64(1), 1.0, -1.0)
    vector = np.bincount(place, sign, dimensions).astype(np.int64)
    idx = np.flatnonzero(vector)
    sig = signature(hashes)
    return hashlib.sha256(" ".join(words).encode()).hexdigest(), shingles, idx.astype(np.int32), vector[idx].astype(np.int32), int((vector * vector).sum()), sig - (1 << 64) if sig >> 63 else sig


def fingerprint(text: Column, dimensions: int = 384, hash: str = "blake2b", normal: bool = False) -> Column:
    """Digest of the normalized text, hashed word trigrams, the vector of signed feature hashes in
    sparse form with its squared norm, and a 64-bit SimHash as a signed long.  Null for null.  A ``normal`` text is
    normalized already: words between single spaces."""

    @F.pandas_udf(SCHEMA)
    def udf(values: pd.Series) -> pd.DataFrame:
        words = lambda v: (v.split(" ") if v else []) if normal else words_of(v)
        rows = [(None,) * 6 if v is None else fingerprint_one(words(v), dimensions, hash) for v in values]
        # made as whole numbers: beside a null they would pass through doubles, which hold 53 bits
        whole = {name: pd.array([x[at] for x in rows], "Int64") for name, at in (("norm", 4), ("signature", 5))}
        return pd.DataFrame({name: pd.Series([x[at] for x in rows], dtype=object) for at, name in enumerate(("exact", "shingles", "idx", "weights"))} | whole)

    return udf(text)


def sha256_fingerprints(rows: DataFrame, key: str, text: str, dimensions: int = 384) -> DataFrame:
    """``key`` and ``fp`` of the same fields as ``fingerprint`` gives, hashed by SHA-256.  Texts are normalized by Spark,
    without compatibility forms.  Rows with a null text are left out.  A text's features never leave its row, so this
    is one narrow stage."""
    known = rows.where(F.col(text).isNotNull()).select(F.col(key), T.normalize(F.col(text)).alias("__n"))
    return known.select(key, fingerprint(F.col("__n"), dimensions, "sha256", normal=True).alias("fp"))


def with_fingerprints(rows: DataFrame, keep: list[str], text: str, dimensions: int = 384, hash: str = "blake2b") -> DataFrame:
    """The columns ``keep``, the first of which is unique, and ``fp``; null for a null text."""
    if hash == "blake2b":
        return rows.select(*keep, fingerprint(F.col(text), dimensions).alias("fp"))
    if hash != "sha256":
        raise ValueError(f"no fingerprints by {hash}")
    known = rows.select(*keep, T.normalize(F.col(text)).alias("__n"))
    return known.select(*keep, F.when(F.col("__n").isNotNull(), fingerprint(F.col("__n"), dimensions, hash, normal=True)).alias("fp"))


def band_keys(sig: Column, bands: int) -> Column:
    """(band, key) structs; with one band the key is the whole signature."""
    width = 64 // bands
    mask = -1 if width == 64 else (1 << width) - 1
    return F.array(*[F.struct(F.lit(b).alias("band"), F.shiftrightunsigned(sig, b * width).bitwiseAND(F.lit(mask).cast("long")).alias("key")) for b in range(bands)])


def first_band(a: Column, b: Column, bands: int) -> Column:
    """The lowest band on which two signatures agree: a pair is looked at there only."""
    width = 64 // bands
    mask = -1 if width == 64 else (1 << width) - 1
    diff = a.bitwiseXOR(b)
    out = F.lit(None).cast("int")
    for band in reversed(range(bands)):
        out = F.when(F.shiftrightunsigned(diff, band * width).bitwiseAND(F.lit(mask).cast("long")) == 0, band).otherwise(out)
    return out


def lexical(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def semantic(a: Column, b: Column) -> Column:
    """Cosine of the sparse vectors of two fingerprints, clamped to 0..1; 0 where one has no length."""
    right = F.map_from_arrays(b["idx"], b["weights"])
    dot = F.aggregate(F.arrays_zip(a["idx"].alias("i"), a["weights"].alias("w")), F.lit(0).cast("long"), lambda s, x: s + x["w"] * F.coalesce(F.try_element_at(right, x["i"]), F.lit(0)))
    scale = F.sqrt(a["norm"].cast("double") * b["norm"])
    return F.when(scale > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / scale))).otherwise(F.lit(0.0))
