"""Many identifiers in texts: one walk through a text by an automaton of all of them, where a text would else be
searched once for each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sparkloom.errors import ConfigurationError
from sparkloom.functions.text import casefold, found_identifiers

#: An expression does for so few; beyond the other bound, in characters, the automaton's words are not broadcast.
FEW, MOST_CHARS = 16, 50_000_000


def found_among(spark: SparkSession, text: Column, identifiers: list[str], few: int = FEW) -> Column:
    """Those of the identifiers that occur in a text whatever the case, sorted: what ``found_identifiers`` gives.

    The words go to the executors in one broadcast, whose size is checked, and each task builds its automaton from them
    once.  Null and empty identifiers occur nowhere, and a null text holds none."""
    wanted = sorted({i for i in identifiers if i})
    if len(wanted) <= few:
        return found_identifiers(text, F.array(*[F.lit(i) for i in wanted]) if wanted else F.array().cast("array<string>"))
    if sum(map(len, wanted)) > MOST_CHARS:
        raise ConfigurationError(f"{len(wanted)} identifiers have over {MOST_CHARS} characters")
    folded = spark.createDataFrame([(i,) for i in wanted], "id string").select("id", casefold(F.col("id")).alias("folded")).collect()
    names: dict[str, list[str]] = {}
    for r in folded:
        names.setdefault(r.folded, []).append(r.id)
    shared = spark.sparkContext.broadcast(names)

    @F.pandas_udf("array<string>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, ids in shared.value.items():
            automaton.add_word(word, ids)
        automaton.make_automaton()
        for series in texts:
            yield pd.Series([sorted({i for _, ids in automaton.iter(t or "") for i in ids}) for t in series], dtype=object)

    return found(casefold(text))
