"""Conversation structure repair by a dynamic program that conversations share along a prefix trie.

Of a conversation only the signature matters to the repair: a letter for each row, its role's
initial, or that the row must go, in capitals where its text is cut off.  Signatures are range-sorted, so that
a partition reads them in the order of a walk through their prefix trie.  The walk holds the
program's layers along the current path: what a signature shares with the one before it is not
computed again, and equal signatures have one answer, emitted where they end.

A layer holds the least cost of bringing the rows so far into each state: nothing kept, a system
row, last a user row, last an assistant row.  Of the cheapest repairs the one whose edits
come first in ASCII order is found by marking the states on cheapest paths from the end and
following the least edit from the start, so layers hold numbers and no edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import parts, small_batches, stored

#: The characters that count as space: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: Rows of a conversation whose letters are put together at a time.
BLOCK = 4096


# ---------------------------------------------------------------- the dynamic program


def after(state: int) -> int:
    """The state that an inserted or reroled row leads to."""
    return ASSISTANT if state == USER else USER


def kept(letter: str, state: int) -> int | None:
    """The state that a kept row leads to, if it may stand there."""
    if letter == "s":
        return SYSTEM if state == START else None
    return after(state) if letter == ("a" if state == USER else "u") else None


def with_inserts(layer: list[int]) -> tuple[int, ...]:
    """The layer with rows inserted behind it; two in a row and more lead nowhere cheaper."""
    layer[USER] = min(layer[USER], layer[START] + INSERT, layer[SYSTEM] + INSERT, layer[ASSISTANT] + INSERT)
    layer[ASSISTANT] = min(layer[ASSISTANT], layer[USER] + INSERT)
    return tuple(layer)


FIRST = with_inserts([0, NEVER, NEVER, NEVER])


def moves(letter: str, state: int) -> list[tuple[str, int, int]]:
    """What can be done with a row in a state: edit, next state and cost, in the edits' ASCII order."""
    out = [("D", state, DELETE)]
    if letter != "d":
        more = TRUNCATED if letter.isupper() else 0
        to = kept(letter.lower(), state)
        if to is not None:
            out.append(("K", to, KEEP + more))
        out.append(("R", after(state), REROLE + more))
    return out


MOVES = {letter: [moves(letter, state) for state in range(4)] for letter in "dsuaoSUAO"}


def next_layer(layer: tuple[int, ...], letter: str) -> tuple[int, ...]:
    out = [NEVER] * 4
    for state, cost in enumerate(layer):
        if cost < NEVER:
            for _, to, more in MOVES[letter][state]:
                out[to] = min(out[to], cost + more)
    return with_inserts(out)


def cheapest(signature: str, layers: list[tuple[int, ...]]) -> tuple[int, str]:
    """Cost and edits of a signature, whose rows' layers are at hand."""
    n = len(signature)
    last = layers[n]
    best = min(last[START], last[ASSISTANT])
    marks = [0] * (n + 1)
    marks[n] = sum(1 << s for s in (START, ASSISTANT) if last[s] == best)
    for k in range(n, -1, -1):
        layer, mark = layers[k], marks[k]
        for to, sources in ((ASSISTANT, (USER,)), (USER, (START, SYSTEM, ASSISTANT))):
            if mark >> to & 1:
                for s in sources:
                    if layer[s] + INSERT == layer[to]:
                        mark |= 1 << s
        marks[k] = mark
        if k:
            before, table = layers[k - 1], MOVES[signature[k - 1]]
            marks[k - 1] = sum(1 << s for s in range(4) if any(mark >> to & 1 and before[s] + more == layer[to] for _, to, more in table[s]))
    edits, k, state = [], 0, START
    while k < n or layers[n][state] != best or state not in (START, ASSISTANT):
        here, way = layers[k][state], []
        if k < n:
            way = [(e, k + 1, to) for e, to, more in MOVES[signature[k]][state] if marks[k + 1] >> to & 1 and here + more == layers[k + 1][to]]
        to = after(state)
        if marks[k] >> to & 1 and here + INSERT == layers[k][to]:
            way.append(("I", k, to))
        edit, k, state = min(way)
        edits.append(edit)
    return best, "".join(edits)


def walk(signatures: Iterator[str]) -> Iterator[tuple[int, str]]:
    """Cost and edits of each of some sorted signatures, by a walk through their trie."""
    path, layers, answer = "", [FIRST], (0, "")
    for signature in signatures:
        if signature != path:
            shared, most = 0, min(len(path), len(signature))
            while shared < most and path[shared] == signature[shared]:
                shared += 1
            del layers[shared + 1 :]
            for letter in signature[shared:]:
                layers.append(next_layer(layers[-1], letter))
            path, answer = signature, cheapest(signature, layers)
        yield answer


# ---------------------------------------------------------------- on tables


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the rows that are left when some are dropped, emptied,
    stripped of their sentence ends, repeated or given to the user, by a hash of id and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text without nulls but in id and turn) with their ``place`` in
    the conversation, from 0, their ``fault`` and ``letter``, and whether role initials are ``illegal``
    behind those of the row before.  Rows of one turn stand by role and text.  The windows read a
    conversation as a stream, sorted on disk where it is long."""
    name = F.md5("text")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    talk = Window.partitionBy("conv_id").orderBy(*order)
    initial = F.substring("role", 1, 1)
    rows = rows.withColumn("place", (F.row_number().over(talk) - 1).cast("long")).withColumn("before", F.lag(initial).over(talk))
    first = F.min("place").over(Window.partitionBy("conv_id", "role", "name").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("name", name).withColumn("first", first)
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(bare == "", "blank").when(F.col("first") < F.col("place"), "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    rows = rows.withColumn("fault", fault)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    illegal = F.col("before").isNotNull() & ~F.concat("before", initial).isin("su", "ua", "au")
    return rows.select("conv_id", "turn", "place", "role", "text", "fault", letter.alias("letter"), illegal.alias("illegal"))


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id and its letters in order: put together in blocks first, so that no task holds more
    of a long conversation than a letter a row."""
    ordered = lambda at, what: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, what))), lambda x: x[what]), "")
    blocks = rows.groupBy("conv_id", F.floor(F.col("place") / BLOCK).alias("block")).agg(ordered("place", "letter").alias("letters"))
    return blocks.groupBy("conv_id").agg(ordered("block", "letters").alias("signature"))


def cheapest_edits(signed: DataFrame) -> DataFrame:
    """conv_id, cost and audit from conv_id and signature.  Rows are range-sorted by signature and
    then id, so that a signature that many conversations have fills several partitions."""
    kind = signed.schema["conv_id"].dataType.simpleString()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []

        def letters() -> Iterator[str]:
            for batch in source:
                if batch.num_rows:
                    ids.append(batch.column(0))
                yield from batch.column(1).to_pylist()

        costs, audits, answers = [], [], walk(letters())
        for cost, audit in answers:
            costs.append(cost)
            audits.append(audit)
            if len(costs) == len(ids[0]):
                yield pa.RecordBatch.from_arrays([ids.pop(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], names=["conv_id", "cost", "audit"])
                costs, audits = [], []

    rows = signed.select("conv_id", "signature").repartitionByRange(parts(signed.sparkSession), "signature", "conv_id").sortWithinPartitions("signature")
    return rows.mapInArrow(run, f"conv_id {kind}, cost long, audit string")


class Editor:
    """Applies a conversation's edits to its rows, as they come."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.place, self.user = conv, audit, 0, 0, True

    def put(self, edit: str, role: str, text: str) -> tuple:
        self.place, self.user = self.place + 1, role[:1] != "u"
        return self.conv, self.place - 1, edit, role, text

    def due(self) -> str:
        return "user" if self.user else "assistant"

    def inserts(self) -> Iterator[tuple]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self.put("I", self.due(), "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield self.put(edit, role if edit == "K" else self.due(), text)
        yield from self.inserts()


def apply_edits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place, edit (K, R or I), role and text.  A conversation's rows stand
    together and in order in one partition.  Its edits go before its rows in one sorted stream, so
    a task holds a batch of rows and one conversation's edits."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    head = edits.select("conv_id", F.lit(-1).cast("long").alias("place"), F.col("audit").alias("role"), F.lit("").alias("text"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor = None
        for batch in source:
            out: list[tuple] = []
            for conv, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if place < 0:
                    editor = Editor(conv, role)
                    out += editor.inserts()
                else:
                    out += editor.row(role, text)
            columns = zip(*out) if out else [[]] * 5
            kinds = (batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv_id", "place", "edit", "role", "text"])

    small_batches(rows.sparkSession)
    stream = rows.select("conv_id", "place", "role", "text").unionByName(head).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return stream.mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and ``repaired_sha256``, of ``role:text`` of its rows with newlines between them.  The rows must stand as
    ``apply_edits`` gives them; the hash is fed row by row.  A conversation without rows is not in it."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, of = None, None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in done], of), pa.array([h for _, h in done], pa.string())], names=["conv_id", "repaired_sha256"])

        for batch in source:
            done, of = [], batch.schema.field(0).type
            for i, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place:
                    digest.update(b"\n")
                else:
                    if digest:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = i, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            yield batch_of(done)
        if digest:
            yield batch_of([(conv, digest.hexdigest())])

    return repaired.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows in order with their faults, the cheapest edits of each conversation, and its repaired rows.

    ``rows`` needs conv_id, turn, role and text; other columns are left out.  A null role or text is one
    space, a null turn comes before others, rows of null id are one conversation.  Repeated rows are duplicates
    of each other, rows of one turn stand by role and text, texts are read whole, and an empty table
    gives empty tables."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    ordered = stored(in_order(rows.select("conv_id", "turn", space("role"), space("text"))), "talks")
    edits = stored(cheapest_edits(signatures(ordered)), "edits")
    return ordered, edits, apply_edits(ordered, edits)


def report(conversations: DataFrame) -> DataFrame:
    """For every conv_id, null too, what the damage by ``damaged`` leaves to repair: gaps, blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256; zeros and the empty string's hash where no row is left."""
    ordered, edits, repaired = repair(damaged(conversations))
    fault = lambda x: F.count_if(F.col("fault") == x).alias(x)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    counts = ordered.groupBy("conv_id").agg(gaps, fault("blank"), fault("duplicate"), fault("truncated"), F.count_if("illegal").alias("illegal"))
    out = conversations.select("conv_id").distinct()
    for n, df in enumerate((counts, edits, digests(repaired))):
        out = out.join(df.withColumnRenamed("conv_id", f"c{n}"), F.col("conv_id").eqNullSafe(F.col(f"c{n}")), "left").drop(f"c{n}")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


#: The same in DuckDB: CRC-32 by a table made on the spot, and a recursive query that carries the least cost and
#: edits of each state from row to row.
SQL = r"""
with recursive crc as (
  select list(list_reduce([i::bigint] || range(8), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) tab
  from range(256) r(i)),
named as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') name from conversations),
hashed as (
  select conv_id, turn, role, text,
         xor(list_reduce([4294967295::bigint] || list_transform(range(1, length(name) + 1), lambda j: unicode(substr(name, j, 1))::bigint),
                         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 kind
  from named, crc),
hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text, unnest(range(case when kind = 3 then 2 else 1 end)) again
  from hashed where kind <> 0),
placed as (
  select conv_id, turn, role, text, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) bare, row_number() over w place, lag(role[1]) over w earlier
  from hurt window w as (partition by conv_id order by turn nulls first, role, text)),
seen as (select *, min(place) over (partition by conv_id, role, text) < place again from placed),
faults as (
  select *, case when bare = '' then 'blank' when again then 'duplicate' when right(bare, 1) not in ('.', '!', '?') then 'truncated' else '' end fault from seen),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint gaps, count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
         count(*) filter (fault = 'truncated') truncated, count(*) filter (earlier is not null and earlier || role[1] not in ('su', 'ua', 'au')) illegal, max(place) n
  from faults group by 1),
layers as (
  select conv_id, 0::bigint k, {'c': 0, 'e': ''} z, {'c': 1000000000, 'e': ''} s, {'c': 2, 'e': 'I'} u, {'c': 4, 'e': 'II'} a from counts
  union all
  select conv_id, k, z1, s1, u2, list_sort([a1, {'c': u2.c + 2, 'e': u2.e || 'I'}])[1] from (
    select *, list_sort([u1, {'c': z1.c + 2, 'e': z1.e || 'I'}, {'c': s1.c + 2, 'e': s1.e || 'I'}, {'c': a1.c + 2, 'e': a1.e || 'I'}])[1] u2 from (
      select l.conv_id, k + 1 k, {'c': z.c + 3, 'e': z.e || 'D'} z1,
             list_sort([{'c': s.c + 3, 'e': s.e || 'D'}] || case when not must and f.role[1] = 's' then [{'c': z.c + t, 'e': z.e || 'K'}] else [] end)[1] s1,
             list_sort([{'c': u.c + 3, 'e': u.e || 'D'}] || case when must then [] else [{'c': z.c + t + 2, 'e': z.e || 'R'}, {'c': s.c + t + 2, 'e': s.e || 'R'}, {'c': a.c + t + 2, 'e': a.e || 'R'}] end
                       || case when not must and f.role[1] = 'u' then [{'c': z.c + t, 'e': z.e || 'K'}, {'c': s.c + t, 'e': s.e || 'K'}, {'c': a.c + t, 'e': a.e || 'K'}] else [] end)[1] u1,
             list_sort([{'c': a.c + 3, 'e': a.e || 'D'}] || case when must then [] else [{'c': u.c + t + 2, 'e': u.e || 'R'}] end
                       || case when not must and f.role[1] = 'a' then [{'c': u.c + t, 'e': u.e || 'K'}] else [] end)[1] a1
      from layers l join (select conv_id cid, place, role, fault in ('blank', 'duplicate') must, (fault = 'truncated')::int t from faults) f
        on l.conv_id is not distinct from f.cid and f.place = l.k + 1) x) y),
best as (select l.conv_id, list_sort([z, a])[1] b from layers l join counts c on l.conv_id is not distinct from c.conv_id and k = n),
edits as (select conv_id, b.c cost, b.e audit, unnest(range(1, length(b.e) + 1)) j from best),
steps as (
  select conv_id, j, audit[j] e, count(*) filter (audit[j] <> 'I') over (partition by conv_id order by j) place, count(*) filter (audit[j] <> 'D') over (partition by conv_id order by j) nth from edits),
chosen as (
  select s.conv_id, nth, e, f.role, f.text,
         max((e = 'K' and f.role[1] = 's')::int) over (partition by s.conv_id) system
  from steps s join faults f on s.conv_id is not distinct from f.conv_id and (e = 'I' and f.place = 1 or e <> 'I' and f.place = s.place) where e <> 'D'),
lines as (
  select conv_id, nth, case when e = 'K' then role when (nth - system) % 2 = 1 then 'user' else 'assistant' end || ':' || case when e = 'I' then '' else text end line from chosen),
hashes as (select conv_id, sha256(string_agg(line, chr(10) order by nth)) h from lines group by 1)
select i.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal,
       coalesce(b2.b.c, 0)::bigint cost, coalesce(b2.b.e, '') audit, coalesce(h, sha256('')) repaired_sha256
from (select distinct conv_id from conversations) i
left join counts c on i.conv_id is not distinct from c.conv_id
left join best b2 on i.conv_id is not distinct from b2.conv_id
left join hashes g on i.conv_id is not distinct from g.conv_id
"""
