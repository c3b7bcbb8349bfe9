"""Substring dedup: runs of consecutive sentences that a document before already has.

A sentence ends at a line break, at one of .!? before white space, or at a full stop, question
or exclamation mark of another script.  From and up to every sentence the shortest run that has
``RUN`` sentences and ``LEAST_WORDS`` words, or ``FULL_RUN`` sentences of any length, is hashed
(its lower-cased words, 64 bits); a document with less is hashed as a whole.  So any passage of
``FULL_RUN`` sentences counts, and a shorter one if it is not just a phrase or two.  The hashes
are joined over all documents, and the sentences covered by a run that occurred before, in a
document of smaller doc_id or earlier in the same one, are removed.  The chance that any two of
n different runs share a hash is below n**2 / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import Words, batches, even_ranges, mix64, powers, stored

RUN = 2
FULL_RUN = 4
LEAST_WORDS = 16
NO_ID = (1 << 63) - 1
#: Signs that end a sentence whatever follows, besides .!? and the line break.
OTHER_ENDS = "。！？｡．؟۔।॥։።"
#: Positions that a range of ``numbered`` holds.
ROWS_EACH, MOST_RANGES = 4000, 10_000
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?"]] = True
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def plain_ends(texts: pa.Array) -> pa.Array:
    """The texts with other scripts' ends as ". " or ".  ", so that no byte changes its place."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    data = texts.buffers()[2] if len(texts) else None
    if data is None or not data.size:
        return texts
    raw = data.to_pybytes()
    for sign in OTHER_ENDS:
        code = sign.encode()
        if code in raw:
            texts = pc.replace_substring(texts, sign, ". ".ljust(len(code)))
    return texts


class Sentences:
    """The sentences of a batch: first word and text of each; ``starts`` in bytes of the text."""

    def __init__(self, texts: pa.Array, lower: bool):
        self.words = w = Words(plain_ends(texts), lower)
        b, n = w.data, len(w.hash)
        stop = ENDS[b]
        if len(b):
            stop[:-1] &= SPACES[b[1:]]
            stop |= b == 10
        passed = np.concatenate(([0], np.cumsum(stop)))
        fresh = np.ones(n, bool)
        if n > 1:
            fresh[1:] = (w.doc[1:] != w.doc[:-1]) | (passed[w.start[1:]] > passed[w.end[:-1]])
        self.first = np.flatnonzero(fresh)
        self.doc = w.doc[self.first]
        self.bounds = np.searchsorted(self.doc, np.arange(w.n + 1))

    def runs(self, run: int, least: int, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first sentence and end (the sentence after the last) of every run, by first sentence.

        From each sentence on, and up to each sentence, the shortest run of at least ``run``
        sentences and ``least`` words, or of ``full`` sentences; a text that is shorter is one
        run.  Together they cover every sentence of any passage that has as much, so no longer
        runs are needed."""
        w, s = self.words, len(self.first)
        if not s:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        up, down = powers(len(w.hash) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w.hash * up[: len(w.hash)])))
        edge = np.append(self.first, len(w.hash))
        at = np.arange(s)
        end = np.maximum(at + run, np.minimum(at + full, np.searchsorted(edge, edge[at] + least)))
        keep = end <= self.bounds[self.doc + 1]
        whole = np.setdiff1d(self.doc, self.doc[keep])
        upto = at + 1
        back = np.minimum(upto - run, np.maximum(upto - full, np.searchsorted(edge, edge[upto] - least, side="right") - 1))
        held = back >= self.bounds[self.doc]
        at = np.concatenate((at[keep], back[held], self.bounds[whole]))
        end = np.concatenate((end[keep], upto[held], self.bounds[whole + 1]))
        at, end = np.divmod(np.unique(at * (s + 1) + end), s + 1)
        lo, hi = edge[at], edge[end]
        return mix64((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64)), at, end


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``doc``, a number of each row's own in order of doc_id.

    That is the doc_id itself where none repeats and at most one is null.  Otherwise rows are
    numbered by doc_id, null ids last, then by a hash of the text; equal rows follow each other."""
    ids = docs.groupBy("doc_id").count().where("count > 1")
    if ids.isEmpty():
        return docs.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = docs.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    out, before = None, 0
    for part, key in ((rows.where("doc_id is not null"), F.col("doc_id")), (rows.where("doc_id is null"), F.col("tie"))):
        n = part.count()
        ranges = even_ranges(part, key, F.lit(1), max(ROWS_EACH, n // MOST_RANGES))
        starts = [before]
        for w in ranges.totals:
            starts.append(starts[-1] + int(w))
        part = part.withColumn("part", ranges.column)
        place = F.row_number().over(Window.partitionBy("part").orderBy("doc_id", "tie"))
        part = part.select("doc_id", "text", (F.get(F.from_json(F.lit(str(starts)), "array<bigint>"), F.col("part")) + place).alias("doc"))
        out = part if out is None else out.union(part)
        before += n
    return stored(out, "numbered")


def run_hashes(docs: DataFrame, run: int = RUN, least: int = LEAST_WORDS, full: int = FULL_RUN) -> DataFrame:
    """``hash`` and ``doc`` of every different run of each row of ``docs`` (doc, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Sentences(batch.column(1), True)
        h, at, _ = s.runs(run, least, full)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        doc = s.doc[at]
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(ids[doc[keep]])], names=["hash", "doc"])

    return batches(docs.select("doc", "text"), work, "hash long, doc long")


def dedup_spans(docs: DataFrame, run: int = RUN, least: int = LEAST_WORDS, full: int = FULL_RUN) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_chars (of what is left) and text of every row.

    A null text counts as an empty one.  Of rows that share a doc_id, or have none, the one whose
    text has the smaller hash comes first; of equal rows one keeps its text and the others lose
    theirs.  A run repeated within a text is cut from its second place on.  Texts of any length
    are read whole; a text without words stays as it is; an empty table gives no rows."""
    docs = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    spans = stored(run_hashes(docs, run, least, full), "spans")
    firsts = spans.groupBy("hash").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("hash").alias("h"), "first")
    cut = spans.join(firsts, (F.col("hash") == F.col("h")) & (F.col("doc") > F.col("first")))
    # a document's own runs, so a list is no longer than its text
    cut = cut.groupBy("doc").agg(F.collect_set("hash").alias("cut")).withColumnRenamed("doc", "d")
    rows = docs.join(cut, F.col("doc") == F.col("d"), "left").select("doc_id", "text", "cut")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        h, at, end = Sentences(texts, True).runs(run, least, full)
        s = Sentences(texts, False)
        lists = batch.column(2).to_pylist()
        gone = np.zeros(len(s.first) + 1, np.int64)
        doc = s.doc[at]
        edges = np.searchsorted(doc, np.arange(len(lists) + 1))
        for i, known in enumerate(lists):
            lo, hi = edges[i], edges[i + 1]
            if lo == hi:
                continue
            own = h[lo:hi]
            hit = np.isin(own.view(np.int64), np.array(known or [], np.int64))
            _, first, back = np.unique(own, return_index=True, return_inverse=True)
            hit |= first[back] != np.arange(hi - lo)
            np.add.at(gone, at[lo:hi][hit], 1)
            np.add.at(gone, end[lo:hi][hit], -1)
        covered = np.cumsum(gone[:-1]) > 0 if len(s.first) else np.zeros(0, bool)
        begins = s.words.start[s.first]
        out, counts, removed = [], [], []
        for i, text in enumerate(texts):
            lo, hi = s.bounds[i], s.bounds[i + 1]
            lost = covered[lo:hi]
            counts.append(int(hi - lo))
            removed.append(int(lost.sum()))
            if not lost.any():
                out.append(text.as_py())
                continue
            base = s.words.offsets[i]
            data = text.as_buffer().to_pybytes()
            edge = [0, *(int(x - base) for x in begins[lo + 1 : hi]), len(data)]
            out.append(b"".join(data[edge[k] : edge[k + 1]] for k in range(hi - lo) if not lost[k]).decode())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(t) for t in out], pa.int64()), pa.array(out, pa.string())],
            names=["doc_id", "n_sentences", "n_removed", "n_chars", "text"],
        )

    return batches(rows, work, "doc_id long, n_sentences long, n_removed long, n_chars long, text string")


def sql(run: int = RUN, least: int = LEAST_WORDS, full: int = FULL_RUN) -> str:
    """The rows of ``dedup_spans`` in DuckDB, for ids that do not repeat: a text is taken apart by one
    pattern into sentences with what follows them, and runs are told apart by their words."""
    word, other = r"[0-9A-Za-z_\x{80}-\x{10FFFF}]", r"[^0-9A-Za-z_\x{80}-\x{10FFFF}]"
    # between words of one sentence: no line break, and no .!? before white space
    inside = rf"(?:[^0-9A-Za-z_\x{{80}}-\x{{10FFFF}}\n.!?]|[.!?]+[^0-9A-Za-z_\x{{80}}-\x{{10FFFF}}\t-\r .!?])*[.!?]*"
    part = rf"{other}*{word}+(?:{inside}{word}+)*{other}*"
    plain = f"translate(coalesce(text, ''), '{OTHER_ENDS}', repeat(chr(10), {len(OTHER_ENDS)}))"
    size = lambda a, e: f"list_sum(list_transform(words[{a} + 1:{e}], lambda x: len(x)))"
    ahead = "case" + "".join(f" when {size('a', f'a + {k}')} >= {least} then {k}" for k in range(run, full)) + f" else {full} end"
    back = "case" + "".join(f" when {size(f'a - {k}', 'a')} >= {least} then {k}" for k in range(run, full)) + f" else {full} end"
    return rf"""
with p as (select doc_id, coalesce(text, '') text, regexp_extract_all({plain}, '{part}') parts from documents),
s as (select doc_id, len(parts) n, list_transform(parts, lambda x: regexp_extract_all(lower(x), '{word}+')) words from p),
spots as (select doc_id, n, words, unnest(range(0, n + 1)) a from s),
ahead as (select doc_id, words, a, a + {ahead} e from spots where a + {run} <= n),
f as (select ahead.* from ahead join s using (doc_id) where e <= n),
b as (select doc_id, words, a - k a, a e from (select *, {back} k from spots where a >= {run}) where k <= a),
whole as (select doc_id, words, 0 a, n e from s where n > 0 and doc_id not in (select doc_id from f)),
runs as (select doc_id, a, e, array_to_string(list_transform(words[a + 1:e], lambda x: array_to_string(x, ' ')), ' ') key from (select * from f union select * from b union select * from whole)),
marked as (select *, min(doc_id) over (partition by key) < doc_id or row_number() over (partition by doc_id, key order by a, e) > 1 again from runs),
cut as (select doc_id, list_sort(list(distinct k)) gone from (select doc_id, unnest(range(a, e)) k from marked where again) group by 1),
edges as (select p.doc_id, p.text, n, coalesce(gone, []) gone, list_transform(parts, lambda x: len(x)) sizes from p join s using (doc_id) left join cut using (doc_id)),
kept as (select doc_id, n, len(gone) removed, case when len(gone) = 0 then text else array_to_string(list_transform(list_filter(range(0, n), lambda k: not list_contains(gone, k)),
  lambda k: substr(text, 1 + coalesce(list_sum(sizes[1:k]), 0)::bigint, sizes[k + 1]::bigint)), '') end text from edges)
select doc_id, n n_sentences, removed n_removed, len(text) n_chars, text from kept"""
