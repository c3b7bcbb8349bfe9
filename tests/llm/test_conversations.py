"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from sparkloom.llm import conversations
from sparkloom.llm.conversations import FIRST, cheapest, next_layer, walk

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_edits(signature: str, most_inserts: int = 6) -> tuple[int, str]:
    """All ways of repairing, with up to so many rows inserted, by their cost and then their letters."""
    found = []

    def go(k, cost, edits, roles, inserts):
        if found and cost > min(found)[0]:
            return
        if k == len(signature) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, edits))
        if inserts < most_inserts:
            go_on = "a" if roles.endswith("u") else "u"
            go(k, cost + 2, edits + "I", roles + go_on, inserts + 1)
        if k < len(signature):
            letter = signature[k]
            go(k + 1, cost + 3, edits + "D", roles, inserts)
            if letter != "d":
                more = letter.isupper()
                for to in "ua":
                    if re.fullmatch("s?(ua)*u?", roles + to):
                        go(k + 1, cost + 2 + more, edits + "R", roles + to, inserts)
                if re.fullmatch("s?(ua)*u?", roles + letter.lower()):
                    go(k + 1, cost + more, edits + "K", roles + letter.lower(), inserts)

    go(0, 0, "", "", 0)
    return min(found)


def test_every_short_signature():
    for n in range(5):
        found = sorted("".join(x) for x in itertools.product("dsuaoSUAO", repeat=n)) if n < 4 else sorted({"".join(random.Random(i).choices("dsuaoSUAO", k=n)) for i in range(700)})
        for signature, answer in zip(found, walk(iter(found))):
            assert answer == brute_edits(signature), signature


def test_layers_do_not_depend_on_the_path():
    """The walk over sorted signatures, some repeated and some prefixes of others, equals each one's own program."""
    r = random.Random(3)
    found = sorted(["".join(r.choices("uasdUAo", k=r.randint(0, 40))) for _ in range(300)] * 2 + ["u" * i for i in range(30)])
    for signature, answer in zip(found, walk(iter(found))):
        layers = [FIRST]
        for letter in signature:
            layers.append(next_layer(layers[-1], letter))
        assert answer == cheapest(signature, layers)


def test_long_conversation_in_little_memory():
    cost, audit = next(walk(iter(["sua" + "uad" * 40_000])))
    assert (cost, len(audit)) == (120_000, 120_003)


def brute(rows):
    """The report, by plain code and the brute-force repair."""
    space = lambda x: " " if x is None else str(x)
    talks = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        rows_of = talks.setdefault(conv, [])
        role, text = "user" if kind == 4 else space(role), {1: "", 2: re.sub("[.!?]", "", space(text))}.get(kind, space(text))
        rows_of += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, talk in talks.items():
        talk.sort()
        turns = [t for some, t, _, _ in talk if some]
        seen, letters, count = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in talk:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] and role[0] in "sua" else "o"
            letters += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            if fault:
                count[fault] += 1
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(talk, talk[1:])]
        cost, audit = brute_edits(letters)
        lines, at, due = [], iter(talk), "user"
        for edit in audit:
            role, text = (None, "") if edit == "I" else next(at)[2:]
            if edit != "D":
                lines.append(f"{role if edit == 'K' else due}:{text}")
                due = "assistant" if lines[-1][0] == "u" else "user"
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *count.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_talks():
    r = random.Random(8)
    texts = ["Yes.", "No!", "what", "", "  \n\t", None, "Ends in space. \n", "é ü. ", "a.b", "x" * 30_000 + "."]
    rows = [(c, t, r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]), r.choice(texts)) for c in range(60) for t in r.choices(range(12), k=r.randint(0, 6))]
    rows += [(None, t, "user", "Who?") for t in (1, 2, None, 2)] + [(70, None, "user", "Hi."), (70, None, "assistant", "Hi."), (70, 3, None, None)]
    # every row of a conversation dropped
    lost = next(t for t in range(1000) if zlib.crc32(f"99:{t}".encode()) % 20 == 0)
    return rows + rows[:9] + [(99, lost, "user", "Gone.")]


def test_report_equals_brute_force(spark):
    rows = odd_talks()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'mine' as place", "1 as letter", "2 as cost", "'x' as name", "3 as kind")
    got = conversations.report(df).collect()
    assert {x.conv_id: tuple(x)[1:] for x in got} == brute(rows) and len(got) == len({r[0] for r in rows})
    assert tuple(next(x for x in got if x.conv_id == 99))[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    """Letters are put together in blocks, and rows of one id are streamed."""
    monkeypatch.setattr(conversations, "BLOCK", 7)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(3000)] + [(c, 0, "user", "Hi.") for c in range(2, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    ordered, edits, repaired = conversations.repair(df)
    assert edits.where("conv_id = 1").first().audit == "K" * 3000
    got = [tuple(x) for x in repaired.where("conv_id = 1").orderBy("place").collect()]
    assert got == [(1, t, "K", r, x) for _, t, r, x in rows[:3000]]
    assert {x.audit for x in edits.where("conv_id > 1").collect()} == {"KI"}


@pytest.mark.parametrize("schema", [SCHEMA, "conv_id string, turn int, role string, text string"])
def test_no_rows(spark, schema):
    assert conversations.report(spark.createDataFrame([], schema)).collect() == []
