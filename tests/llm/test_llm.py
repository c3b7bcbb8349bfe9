"""The training-text operators against brute force, round trips and held-out accuracy."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, html_extract, mixing, near_dedup, sentence_spans, shared, simhash, surrogates, token_rollup, toxicity, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "sen", "tor", "val", "wex") for b in ("ba", "der", "fin", "gol", "hum", "jin", "pok", "zat")]


def sentence(r, lo=6, hi=14):
    return " ".join(r.choice(WORDS) for _ in range(r.randint(lo, hi))).capitalize() + "."


def prose(r, n):
    return " ".join(sentence(r) for _ in range(n))


#: Nulls in every column, empty and long texts, repeated rows and ties.
def odd_rows():
    r = random.Random(1)
    long = prose(r, 3000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id at all here", "en", "a", 1), (None, None, None, None, None), (3, long, "en", "b", 1), (4, long, "en", None, 1)]
    rows += [(5, "same text again", "en", "a", 1)] * 3 + [(5, "same id, other text", "de", "b", 1), (6, "!!! ... ???", "fr", "c", 1), (7, "word", "en", "a", 1), (8, "word", "en", "a", 1), (9, "x" * 50_000, "en", "a", 1)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns whose names clash with those used inside
    rows = spark.createDataFrame(odd_rows(), DOC)
    return rows.withColumns({c: F.lit("mine") for c in ("node", "size", "n", "key", "tie", "score", "row", "d", "t", "root", "hits", "item_id", "predicted", "pass")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


# ---------------------------------------------------------------- shared


@pytest.mark.parametrize("descending", [False, True])
def test_even_ranges(spark, descending):
    """Ids that lie dense, far out, repeated and missing: exact weights, in order, none too heavy but by one id."""
    r = random.Random(2)
    ids = [r.randrange(10**6) for _ in range(6000)] + [10**17 + r.randrange(100) * 1000 for _ in range(1000)] + [5] * 700 + [None] * 30
    rows = spark.createDataFrame([(i, 1 + (i or 0) % 3) for i in ids], "k long, w long")
    ranges = shared.even_ranges(rows, F.col("k"), F.col("w"), 300, descending=descending)
    placed = shared.in_ranges(rows.withColumn("p", ranges.column), "p", ranges)
    got, parts_of = defaultdict(list), defaultdict(set)
    for x in placed.withColumn("part", F.spark_partition_id()).collect():
        got[x.p].append(x)
        parts_of[x.p].add(x.part)
    assert {p: sum(x.w for x in v) for p, v in got.items()} == {p: w for p, w in enumerate(ranges.totals) if w}
    assert all(len(v) == 1 for v in parts_of.values()) and {x.k for x in got[ranges.count - 1]} == {None}
    spans_ = [(min(x.k for x in v), max(x.k for x in v)) for _, v in sorted(got.items()) if v[0].k is not None]
    for (a, b), (c, d) in zip(spans_, spans_[1:]):
        assert d < a if descending else b < c
    assert all(w <= 300 or len({x.k for x in got[p]}) == 1 for p, w in enumerate(ranges.totals[:-1]))


def test_shared_folder(spark, tmp_path):
    kept = list(shared.FOLDERS)
    df = shared.stored(spark.range(5).toDF("a"), "x")
    assert df.count() == 5 and len(shared.FOLDERS) == len(kept) + 1
    shared.clean(spark, len(kept))
    assert shared.FOLDERS == kept
    other = shared.stored(spark.range(3).toDF("a"), "y")
    shared.dispose(other)
    assert shared.FOLDERS == kept


def test_words_and_spans():
    texts = ["Hello the World, the", "", None, "é-ü x", "the hello"]
    w = shared.Words(pa.array(texts))
    names = {}
    for h, d, s, e in zip(w.hash.tolist(), w.doc.tolist(), w.start, w.end):
        names.setdefault(w.data[s:e].tobytes().decode(), set()).add(h)
    assert set(names) == {"hello", "the", "world", "é", "ü", "x"} and all(len(v) == 1 for v in names.values())
    assert w.bounds.tolist() == [0, 4, 4, 4, 7, 9]
    h, owner = shared.spans(w, 3)
    assert owner.tolist() == [0, 0, 3, 4]


def test_words_do_not_depend_on_pieces(monkeypatch):
    r = random.Random(2)
    texts = [prose(r, 30), "y" * 500, "", prose(r, 5)] * 3
    whole = shared.Words(pa.array(texts))
    monkeypatch.setattr(shared, "CHUNK", 100)
    cut = shared.Words(pa.array(texts))
    for name in ("hash", "doc", "start", "end", "bounds"):
        assert (getattr(whole, name) == getattr(cut, name)).all(), name


def test_even_ranges_of_few_bins(spark):
    r = random.Random(4)
    keys = [r.randrange(10**6) for _ in range(500)] + [10**12, None, None] + [77] * 300
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for down in (False, True):
        ranges = shared.even_ranges(rows, F.col("k"), F.lit(1), 50, fine=16, descending=down)
        got = [(x.p, x.k) for x in rows.select(ranges.column.alias("p"), "k").collect()]
        assert all(p == ranges.count - 1 for p, k in got if k is None)
        by = defaultdict(list)
        for p, k in got:
            if k is not None:
                by[p].append(k)
        order = sorted(by)
        for a, b in zip(order, order[1:]):
            assert min(by[a]) > max(by[b]) if down else max(by[a]) < min(by[b])
        assert max(len([k for k in v if k != 77]) for v in by.values()) <= 60


def test_components(spark):
    r = random.Random(5)
    edges = [(f"n{r.randrange(80):02d}", f"n{r.randrange(80):02d}") for _ in range(70)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    top = {n: n for e in edges for n in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    want = {n: find(n) for e in edges for n in e if e[0] != e[1]}
    got = {x.node: x.root for x in shared.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == want


# ---------------------------------------------------------------- 1 token counts


def test_rollup(spark, tmp_path):
    rows = [("a", "s", "en", "v1", 5, 20), ("b", "s", "en", "v1", 7, 30), ("c", None, "de", "v1", 1, 2)]
    schema = "key string, source string, lang string, tokenizer string, tokens long, chars long"
    frame = lambda x: spark.createDataFrame(x, schema)
    store = token_rollup.TokenRollup(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    total = lambda: {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens, r.chars) for r in store.totals().collect()}
    assert store.commit("1", frame(rows + rows[:1]))
    assert total() == {("s", "en", "v1"): (2, 12, 50), (None, "de", "v1"): (1, 1, 2)}
    assert not store.commit("1", frame(rows)) and total()[("s", "en", "v1")] == (2, 12, 50)
    assert store.commit("2", frame([("b", "t", "en", "v2", 9, 31)]), spark.createDataFrame([("c",), ("unknown",)], "key string"))
    assert total() == {("s", "en", "v1"): (1, 5, 20), ("t", "en", "v2"): (1, 9, 31)}
    assert store.commit("3", frame([("a", "s", "en", "v1", 5, 20)])) and total()[("s", "en", "v1")] == (1, 5, 20)
    assert store.ledger().count() == 2
    assert token_rollup.TokenRollup(spark, str(tmp_path / "store")).committed().keys() == {"1", "2", "3"}


def test_attempt_that_died_counts_nothing(spark, tmp_path, monkeypatch):
    store = token_rollup.TokenRollup(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("a", "s", "en", "v1", 5, 20)], "key string, source string, lang string, tokenizer string, tokens long, chars long")
    with monkeypatch.context() as m:
        m.setattr(token_rollup.TokenRollup, "_mark", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.commit("1", rows)
    assert store.totals().count() == 0 and store.commit("1", rows) and store.totals().first().tokens == 5


def test_two_writers_count_nothing_twice(spark, tmp_path, monkeypatch):
    schema = "key string, source string, lang string, tokenizer string, tokens long, chars long"
    frame = lambda *x: spark.createDataFrame(list(x), schema)
    store = token_rollup.TokenRollup(spark, str(tmp_path / "store"))
    store.commit("1", frame(("a", "s", "en", "v1", 5, 20)))
    write, others = token_rollup.TokenRollup._write, []

    def late(self, batch, signed, log, replaces=False):
        if not others:  # another writer revises the same document while this one works
            others.append(1)
            assert token_rollup.TokenRollup(spark, self.path).commit("other", frame(("a", "s", "en", "v1", 8, 30)))
        return write(self, batch, signed, log, replaces)

    with monkeypatch.context() as m:
        m.setattr(token_rollup.TokenRollup, "_write", late)
        assert store.commit("2", frame(("a", "s", "en", "v1", 9, 40)))
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v1", 1, 9, 40)] and [e["batch"] for e in store.log()] == ["1", "other", "2"]
    entry = {"number": 2, "batch": "x", "attempt": "y", "replaces": False}
    assert not store._mark(entry)
    assert store.compact()
    store.vacuum()
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v1", 1, 9, 40)] and len(list((tmp_path / "store/ledger").iterdir())) == 1
    assert not store.commit("2", frame(("a", "s", "en", "v1", 1, 1))) and store.commit("3", deletes=spark.createDataFrame([("a",)], "key string"))
    assert store.totals().count() == 0


def test_rollup_query_equals_brute_force(spark, tmp_path):
    import base64

    import tiktoken

    from sparkloom.llm.queries import op1_token_rollup

    def code(name):
        with open(f"{token_rollup.VOCABULARIES}/{name}.tiktoken", "rb") as f:
            return tiktoken.Encoding(name, pat_str=token_rollup.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})

    codes = {n: code(n) for n in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    r = random.Random(4)
    rows = [x for i, x in enumerate(odd_rows()) if x[0] != 5 or i % 2 == 0][:12]
    rows = list({x[0] if x[0] is not None else ("text", x[1]): x for x in rows}.values())
    rows += [(100 + i, r.choice(["same one", "other one", prose(r, 2)]), r.choice(["en", "de", None]), r.choice(["a", None]), 1) for i in range(40)] + [(None, "same one", "de", "a", 1)]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for id, t, lang, source, _ in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        kept.setdefault(t or "", (id, t, lang, source))
    want = defaultdict(lambda: [0, 0, 0])
    for _, t, lang, source in kept.values():
        name = "byte_bpe_50k" if lang == "en" else "byte_bpe_multi_50k"
        for i, n in enumerate((1, len(codes[name].encode_ordinary(t or "")), len(t or ""))):
            want[source, lang, name][i] += n
    got = {(x.source, x.lang, x.tokenizer): [x.documents, x.tokens, x.chars] for x in op1_token_rollup(spark, str(tmp_path)).collect()}
    assert got == dict(want)


def test_token_counts(spark, odd, empty):
    import base64

    import tiktoken

    with open(f"{token_rollup.VOCABULARIES}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    code = tiktoken.Encoding("t", pat_str=token_rollup.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = token_rollup.count_tokens(odd, "byte_bpe_50k").collect()
    assert sorted(r.tokens for r in got) == sorted(len(code.encode_ordinary(t)) if t else 0 for _, t, *_ in odd_rows())
    assert token_rollup.count_tokens(empty, "byte_bpe_50k").count() == 0


# ---------------------------------------------------------------- 2 sentence spans


def brute_spans(rows, run=sentence_spans.RUN, least=sentence_spans.LEAST_WORDS, full=sentence_spans.FULL_RUN):
    """All runs of enough sentences and words, as plain sets and strings; ``rows`` in order."""
    seen, out = set(), []
    for text in rows:
        parts = [p for p in re.findall(r".*?(?:[.!?](?=\s)|[。！？؟।]|\n|\Z)\s*", text, re.S) if re.search(r"\w", p)]
        words = [re.findall(r"\w+", p.lower()) for p in parts]
        n, lost, own = len(parts), set(), set()
        flat = lambda i, j: tuple(w for x in words[i:j] for w in x)  # noqa: E731, B023
        runs = [(i, j) for i in range(n) for j in range(i + run, n + 1) if len(flat(i, j)) >= least or j - i >= full]
        for i, j in runs or ([(0, n)] if n else []):
            key = flat(i, j)
            if key in seen or key in own:
                lost |= set(range(i, j))
            own.add(key)
        seen |= own
        out.append("".join(p for i, p in enumerate(parts) if i not in lost))
    return out


def test_sentence_spans(spark):
    r = random.Random(6)
    shared_passage = " ".join(sentence(r, 8, 12) for _ in range(6))
    rows = []
    for i in range(40):
        parts = [sentence(r, 3, 15) for _ in range(r.randint(1, 12))]
        if i % 3 == 0:
            parts.insert(r.randrange(len(parts) + 1), shared_passage)
        if i % 7 == 0:
            parts += [parts[0], parts[0]]
        rows.append((i, " ".join(parts) if i % 2 else "\n".join(parts)))
    want = dict(zip((i for i, _ in rows), brute_spans([t for _, t in rows])))
    got = {x.doc_id: x for x in sentence_spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v.text.strip() for k, v in got.items()} == {k: v.strip() for k, v in want.items()}
    assert sum(x.n_removed > 0 for x in got.values()) >= 12 and shared_passage[:40] in got[0].text
    assert all(x.text == dict(rows)[k] for k, x in got.items() if not x.n_removed)


def test_sentence_spans_of_short_lines(spark):
    r = random.Random(9)
    lines = lambda n: [r.choice(WORDS) + r.choice(WORDS) for _ in range(n)]
    verse, own = lines(40), [lines(30) for _ in range(4)]
    mixed = [sentence(r, 10, 12), sentence(r, 10, 12), "A b.", "C d."]
    rows = [
        (1, "\n".join([*own[0], *verse])), (2, "\n".join([*own[1], *verse, *own[2]])), (3, "\n".join(verse)),
        (4, "\n".join(verse[:15])), (5, "\n".join(verse[:15])), (6, "\n".join([*own[3], *verse[:15]])),
        (7, " ".join(mixed)), (8, " ".join(mixed)), (9, " ".join([sentence(r), *mixed, sentence(r)])), (10, "Thank you."), (11, "thank you"),
    ]
    got = {x.doc_id: x for x in sentence_spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_removed for i in range(1, 12)] == [0, 40, 40, 15, 15, 15, 0, 4, 4, 0, 1]
    assert got[2].text.split() == [*own[1], *own[2]] and all(got[i].text == "" for i in (3, 5, 8, 11))


def test_sentence_spans_cover_what_any_run_covers():
    r = random.Random(10)
    texts = ["\n".join(" ".join(r.choice(WORDS) for _ in range(r.choice((1, 1, 2, 5, 18)))) for _ in range(r.randrange(1, 20))) for _ in range(60)]
    s = sentence_spans.Sentences(pa.array(texts), True)
    _, at, end = s.runs(2, 16, 4)
    found = set(zip(at.tolist(), end.tolist()))
    n = np.append(s.first, len(s.words.hash))
    for d in range(len(texts)):
        lo, hi = s.bounds[d], s.bounds[d + 1]
        for a in range(lo, hi):
            for b in range(a + 2, hi + 1):
                if n[b] - n[a] >= 16 or b - a >= 4:
                    assert {k for x, y in found if a <= x and y <= b for k in range(x, y)} == set(range(a, b))
        if hi - lo < 2 or n[hi] - n[lo] < 16 and hi - lo < 4:
            assert {(x, y) for x, y in found if lo <= x < hi} == {(lo, hi)}


def test_sentence_spans_of_other_scripts(spark):
    chinese, arabic, hindi = "今天天气很好。我们去公园吧！你来吗？好的。", "كيف حالك؟ أنا بخير۔ شكرا؟ مع السلامة۔", "यह पहला है। यह दूसरा है। यह तीसरा है॥ यह चौथा है।"
    rows = [(1, chinese), (2, f"别的句子。{chinese}最后一句。"), (3, arabic), (4, f"سؤال آخر؟ {arabic}"), (5, hindi), (6, f"अलग वाक्य। {hindi}")]
    got = {x.doc_id: x for x in sentence_spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_removed for i in range(1, 7)] == [0, 4, 0, 4, 0, 4] and got[2].text == "别的句子。最后一句。" and got[6].text == "अलग वाक्य। "


def test_sentence_spans_of_repeated_and_missing_ids(spark):
    r = random.Random(12)
    shared_passage = " ".join(sentence(r, 8, 12) for _ in range(3))
    texts = [f"{sentence(r)} {shared_passage} {sentence(r)}" for _ in range(4)] + [prose(r, 3)]
    rows = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (8, texts[4]), (8, texts[4]), (8, texts[4]), (None, texts[4]), (None, ""), (None, None)]
    got = sentence_spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and sum(shared_passage[:50] in x.text for x in got) == 1 and {x.doc_id for x in got if shared_passage[:50] in x.text} == {7}
    assert sorted(x.text for x in got if x.doc_id == 8) == ["", "", texts[4]] and sum(x.text == texts[4] for x in got) == 1


def test_sentence_spans_odd(odd, empty):
    got = sentence_spans.dedup_spans(odd).collect()
    assert len(got) == len(odd_rows())
    assert {x.doc_id: x.n_chars for x in got if x.doc_id in (3, 4)}[4] < 20_000 and all(x.text == "" for x in got if x.doc_id in (1, 2))
    assert sorted(x.text for x in got if x.doc_id == 5) == ["", "", "same id, other text", "same text again"]
    assert sentence_spans.dedup_spans(empty).count() == 0


# ---------------------------------------------------------------- 3 fingerprints


def brute_print(text):
    w = shared.Words(pa.array([text or ""]))
    term, _ = shared.spans(w, 2)
    votes = np.zeros(simhash.BITS)
    for t, n in zip(*np.unique(term, return_counts=True)):
        weight = 1 + int(np.log2(n))
        for k in range(simhash.BITS // 64):
            h = int(shared.mix64(np.array([t + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & shared.MASK)], np.uint64))[0])
            votes[64 * k : 64 * k + 64] += [weight if h >> (63 - b) & 1 else -weight for b in range(64)]
    return np.packbits(votes > 0).tobytes().hex()


def test_fingerprints_by_vote():
    r = random.Random(7)
    texts = [prose(r, n) for n in (1, 3, 40)] + ["", None, "one", "a b a b a b a b", "x " * 9000]
    assert simhash.hexes(simhash.fingerprints(pa.array(texts))) == [brute_print(t) for t in texts]


def test_successor_and_edits(spark, odd, empty):
    rows = [(id, t or "") for id, t, *_ in odd_rows()]
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    got = simhash.with_successor(odd, rows_each=3).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_chars) for x in got) == sorted((i is None, i or 0, len(t)) for i, t in rows)
    single = [(i, t) for i, t in order if sum(j == i for j, _ in rows) == 1]
    for i, t in single:
        nxt = order[(order.index((i, t)) + 1) % len(order)]
        if sum(j == nxt[0] for j, _ in rows) == 1:
            edited = t[: len(t) - len(t) // 3] + nxt[1][: len(t) // 3]
            x = next(x for x in got if x.doc_id == i)
            assert x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and x.edited_fingerprint == brute_print(edited) and x.fingerprint == brute_print(t)
    assert simhash.with_successor(empty).count() == 0
    one = simhash.with_successor(spark.createDataFrame([(1, "only one here")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_radius_search(spark):
    r = random.Random(8)
    base = [r.getrandbits(128) for _ in range(12)]
    prints = set()
    for b in base:
        for _ in range(25):
            x = b
            for bit in r.sample(range(128), r.randrange(0, 8)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    want = {f"{x:032x}": n for x in prints if (n := sum(0 < (x ^ y).bit_count() <= 6 for y in prints))}
    rows = spark.createDataFrame([(f"{x:032x}",) for x in prints] * 2 + [("0" * 32,)], "fingerprint string")
    for cell in (2048, 5):
        assert {x.fingerprint: x.n_links for x in simhash.within_radius(rows, cell=cell).collect()} == want


# ---------------------------------------------------------------- 4 near duplicates


def brute_classes(rows, shares):
    texts = sorted({t or "" for _, t in rows})
    sh, owner, tf, n = near_dedup.bags(pa.array(texts))
    w = near_dedup.weights(sh, tf, shares)
    bag = [dict(zip(sh[owner == i].tolist(), w[owner == i].tolist())) for i in range(n)]
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(n):
        for j in range(i):
            low = sum(min(v, bag[j][k]) for k, v in bag[i].items() if k in bag[j])
            total = sum(bag[i].values()) + sum(bag[j].values()) - low
            if low and low / total >= near_dedup.THRESHOLD - 1e-9:
                top[find(i)] = find(j)
    at = {t: find(i) for i, t in enumerate(texts)}
    groups = defaultdict(list)
    for id, t in rows:
        groups[at[t or ""]].append(id)
    return {(id, t): min((x for x in groups[at[t or ""]] if x is not None), default=None) for id, t in rows}


def drifting(r, words, steps, rate):
    """Texts edited again and again: neighbours are alike, the ends are not."""
    out, now = [], list(words)
    for _ in range(steps):
        out.append(" ".join(now))
        for _ in range(rate):
            now[r.randrange(len(now))] = r.choice(WORDS) + str(r.randrange(100))
    return out


@pytest.mark.parametrize("cell", [2000, 7])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dedup, "CELL", cell)
    r = random.Random(9)
    texts = [prose(r, r.randint(1, 12)) for _ in range(40)]
    texts += drifting(r, prose(r, 14).split(), 30, 1) + drifting(r, prose(r, 10).split(), 25, 2)
    texts += [texts[3]] * 5 + ["", "", "...", "two words"]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_classes(rows, near_dedup.shingle_shares(docs))
    got = {x.doc_id: x.class_id for x in near_dedup.near_duplicates(docs).collect()}
    wrong = [i for i, t in rows if got[i] != want[i, t]]
    assert len(wrong) <= 2, (wrong, len(rows))  # a link at the very threshold may miss all bands


def test_a_chance_match_of_short_samples_loses_no_link(spark):
    """Samples agree by their 16 bits in a band whose keys differ: the pair still counts where its keys are equal."""
    sig = np.arange(near_dedup.HASHES, dtype=np.uint16).tobytes()
    rows = [(1, 77, n, 10, sig, "a") for n in "ab"] + [(2, 88, n, 10, sig, "a") for n in "ab"]
    members = spark.createDataFrame(rows, "band int, key long, node string, bytes long, sig binary, star string")
    bands = spark.createDataFrame([("a", [5, 77, 88]), ("b", [6, 77, 88])], "node string, bands array<long>")
    roots = spark.createDataFrame([], "node string, root string")
    got = near_dedup.contenders(members, roots, bands).collect()
    assert {(x.band, x.node) for x in got} == {(1, "a"), (1, "b")}


def test_near_duplicates_odd(odd, empty):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows()) and {x.class_id for x in got if x.doc_id in (3, 4)} == {3} and {x.class_id for x in got if x.doc_id in (7, 8)} == {7}
    kept = near_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in kept.collect()) == sorted([(False, 1), (False, 3), (False, 5), (False, 5), (False, 6), (False, 7), (False, 9), (True, 0)])
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.keep_first(empty).count() == 0


def test_consistent_sampling_estimates():
    """Samples of two weighted sets agree as often as their weighted Jaccard similarity."""
    rng = np.random.default_rng(3)
    hits, true = [], []
    for _ in range(60):
        sh = shared.mix64(rng.integers(1, 2**62, 200).astype(np.uint64))
        sh.sort()
        a, b = rng.uniform(0.5, 5, 200), rng.uniform(0.5, 5, 200)
        _, s = near_dedup.signatures(np.concatenate((sh, sh)), np.repeat([0, 1], 200), np.concatenate((a, b)))
        hits.append((s[0] == s[1]).mean())
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(hits) - np.mean(true)) < 0.03


# ---------------------------------------------------------------- 5 HTML


@pytest.fixture(scope="module")
def model():
    return html_extract.fit()


def test_pages_of_unseen_layouts(model):
    maker, exact = html_extract.Maker(4242), 0
    for _ in range(150):
        source = maker.page()
        blocks = defaultdict(list)
        for b, _, t in html_extract.Page(source).pieces:
            blocks[b].append(t)
        gold = (" ".join(html.unescape("".join(v)).replace(maker.MARK, "").split()) for v in blocks.values() if any(maker.MARK in t for t in v))
        exact += html_extract.extract_texts([source.replace(maker.MARK, "")], model)[0] == "\n".join(x for x in gold if x)
    assert exact >= 135


def test_decoding_is_the_best_consistent_choice():
    """Against all ways to call each node main, boilerplate or mixed."""
    rng = np.random.default_rng(1)
    for _ in range(150):
        n = int(rng.integers(2, 9))
        parent = [-1]
        for i in range(1, n):
            chain = [i - 1]
            while parent[chain[-1]] >= 0:
                chain.append(parent[chain[-1]])
            parent.append(int(rng.choice(chain)))
        parent = np.array(parent)
        end = np.array([max([i] + [j for j in range(i + 1, n) if i in ancestors(parent, j)]) + 1 for i in range(n)])
        odds, own = rng.normal(0, 3, n), rng.choice([0, 5, 200], n)
        keep = html_extract.decode(odds, parent, end, own)
        score = np.clip(odds, -6, 6) * np.where(own > 0, 1 + np.log1p(own), 0.5)

        def best(i):
            """Value and kept nodes of the subtree at i."""
            kids = [j for j in range(n) if parent[j] == i]
            whole = float(score[i : end[i]].sum())
            sure = (abs(whole), {j for j in range(i, end[i])} if whole > 0 else set())
            parts = [best(j) for j in kids]
            mixed = (abs(score[i]) * (own[i] > 0) - html_extract.MIXED_COST + sum(v for v, _ in parts), set().union(*(k for _, k in parts), {i} if score[i] > 0 else set()))
            return sure if sure[0] >= mixed[0] - 1e-12 else mixed

        want = best(0)[1]
        text = lambda nodes: {j for j in nodes if own[j] > 0}  # noqa: E731, B023
        assert text(np.flatnonzero(keep).tolist()) == text(want), (parent, odds, own)


def ancestors(parent, j):
    out = set()
    while parent[j] >= 0:
        j = parent[j]
        out.add(j)
    return out


def test_html_cases(spark, model):
    body = "".join(f"<p>{prose(random.Random(i), 4)}</p>" for i in range(4))
    page = f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=1>Home</a> <a href=2>News</a></nav><article><h1>A &lt;title&gt; &#233;</h1>{body}<p>un<b>bro</b>ken\n  word<br>next</p></article><div class='comments'><p>first comment here</p></div><footer>&copy; x</footer><script>var a='<p>no</p>';</script></body></html>"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<"), (5, "u", "plain words only, not a tag in sight, but a sentence."), (6, "u", "<p" * 2000), (None, None, None)]
    got = {x.page_id: x for x in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    lines = got[1].text.split("\n")
    assert lines[0] == "A <title> é" and lines[-1] == "unbroken word next" and len(lines) == 6
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0 and got[1].n_chars == len(got[1].text)


#: Pages as people write them, and what is to come out; none is from a table or from the generator.
LONG = "The river rose by two metres overnight, and the lower fields stood under water until noon."
GOLD = [
    ("just a line of text", "just a line of text"), ("<p>One paragraph, and that is the whole page.</p>", "One paragraph, and that is the whole page."),
    (f"<html><body><h1>Flood</h1>{LONG} Nobody was hurt.</body></html>", f"Flood\n{LONG} Nobody was hurt."),
    ("<div>" * 3000 + "deep down", "deep down"),
    (f"<article><h2>Energy</h2><p>{LONG}</p><p>It holds that <math><mi>E</mi><mo>=</mo><mn>2</mn></math> here.</p></article>", f"Energy\n{LONG}\nIt holds that E=2 here."),
    (f"<!doctype html><body><div id='nav-menu'><a href='/'>Home</a> <a href='/news'>News</a></div><main><h1>Flood</h1><p>{LONG}</p><p>{LONG}</p></main><div class='comment-list'><p>Great read, thanks for it!</p></div><div class='cookie-banner'>We use cookies to improve the site.</div></body>", f"Flood\n{LONG}\n{LONG}"),
    (f"<table><tr><td><ul><li><a href=a>A</a><li><a href=b>B</a></ul></td><td class=content><p>{LONG}<p>A &lt;b&gt; &amp; c&nbsp;d &#8364;5</td></tr></table>", f"{LONG}\nA <b> & c d €5"),
    (f"<section><p>{LONG}</p><!-- <p>hidden</p> --><script>document.write('<p>x</p>')</script><p>  spread over\n\t lines   of the page, as people\nwrite them. </p></section>", f"{LONG}\nspread over lines of the page, as people write them."),
    (f"<body><article><p>{LONG}</p><aside class='newsletter-signup'><form><label>Mail</label><input><button>Join</button></form></aside><p>{LONG}</p></article><footer>© 2024 Example. All rights reserved.</footer></body>", f"{LONG}\n{LONG}"),
    (f"<body><article><h1>List</h1><ul><li>First thing to do today</li><li>Second thing, rather later</li></ul><p>{LONG}</p></article></body>", f"List\nFirst thing to do today\nSecond thing, rather later\n{LONG}"),
    ("<nav><a href=1>Home</a></nav><footer>imprint</footer>", ""), ("", ""), (None, ""),
    ("<body><nav><a href=/a>Home</a> <a href=/b>News</a></nav><article><h1>Further reading on rivers</h1><ul>" + "".join(f"<li><a href=/r{i}>A long title about river number {i} and its banks</a></li>" for i in range(8)) + "</ul></article><footer>&copy; Site</footer></body>", "Further reading on rivers\n" + "\n".join(f"A long title about river number {i} and its banks" for i in range(8))),
    (f"<body><script src=/x/>var a = 1; alert(a);</script><article><h1>Flood</h1><p>{LONG}</p></article><script src='/y'/><p>{LONG}</p></body>", f"Flood\n{LONG}\n{LONG}"),
    (f"<body><div id=page><div class=masthead><a href=/>The Daily</a><p>News since 1890</p></div><div class=story-text><h2>Flood</h2><p>{LONG}</p><ul class=share-buttons><li><a href=t>Tweet</a><li><a href=f>Share</a></ul><p>{LONG}</p></div><div class=related-links><h3>More</h3><ul><li><a href=1>Fire in the harbour</a><li><a href=2>Snow in May</a></ul></div></div></body>", f"Flood\n{LONG}\n{LONG}"),
]


def test_hand_written_pages(spark, model):
    rows = [(i, f"u{i}", h) for i, (h, _) in enumerate(GOLD)] * 2
    docs = spark.createDataFrame(rows, "page_id int, url string, html string").withColumns({"text": F.lit("mine"), "n_chars": F.lit(1)})
    got = html_extract.extract(docs, model).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x.text, x.n_chars) == (GOLD[x.page_id][1], len(GOLD[x.page_id][1])), GOLD[x.page_id][0]


def test_long_pages_are_read_whole(model):
    r = random.Random(5)
    paragraphs = [prose(r, 6) for _ in range(1500)]
    source = f"<body><nav><a href=1>Home</a></nav><article>{''.join(f'<p>{p}</p>' for p in paragraphs)}</article><footer>x</footer></body>"
    assert html_extract.extract_texts([source], model) == ["\n".join(paragraphs)]


# ---------------------------------------------------------------- 6 decontamination


def brute_overlap(doc, item):
    d, i = (re.findall(r"[^\W_]+", x.lower()) for x in (doc, item))
    best = 0
    for shift in range(-len(i), len(d)):
        run = 0
        for k, w in enumerate(i):
            if 0 <= k + shift < len(d):
                run = max(0, run + (1 if d[k + shift] == w else -1))
                best = max(best, run)
    return best, len(i)


def test_contamination(spark):
    r = random.Random(11)
    items = [(i, prose(r, 3)) for i in range(8)] + [(8, "too short"), (9, None)]
    rows = []
    for i in range(60):
        words = prose(r, 8).split()
        if i % 3 == 0:
            item = r.choice(items[:8])[1].split()
            for _ in range(i // 6):
                item[r.randrange(len(item))] = r.choice(WORDS) + "q"
            at = r.randrange(len(words))
            words[at:at] = item[: r.choice((6, 14, 30, 99))]
        rows.append((i, " ".join(words)))
    rows += [(60, None), (61, ""), (None, items[0][1]), (62, f"{rows[1][1]} Too short! kaba"), (63, "short too"), (64, "it is TOO, short")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (500_000, 0):
        got = {x.doc_id: x for x in decontaminate.contamination(docs, bench, most_broadcast=most).collect()}
        assert len(got) == len(rows)
        for id, text in rows:
            scores = {i: brute_overlap(text or "", t or "") for i, t in items}
            # short items count only as a whole
            want = {i: s for i, (s, n) in scores.items() if n and s >= (n if n < 8 else min(decontaminate.NEED, -(-n * 4 // 5)))}
            if got[id].contaminated:
                assert want[got[id].item_id] == got[id].score
            else:  # seeds may miss an overlap that many substitutions barely let pass
                assert not want or 8 not in want and max(want.values()) <= decontaminate.NEED + 4, (id, want)
    kept = {x.doc_id for x in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {k for k, v in got.items() if not v.contaminated}


def test_long_items_and_long_texts(spark):
    """A long item beside short ones: each hit is laid over its own item's length, and a very long text is read whole."""
    r = random.Random(12)
    long, short = prose(r, 900), prose(r, 3)
    filler = prose(r, 9000)
    rows = [(1, f"{filler} {short} {filler}"), (2, f"{filler} {long}"), (3, filler), (4, " ".join(long.split()[4000:4060]))]
    bench = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    got = {x.doc_id: (x.contaminated, x.item_id, x.score) for x in decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    size = lambda t: len(re.findall(r"[^\W_]+", t))
    assert got == {1: (True, 2, size(short)), 2: (True, 1, size(long)), 3: (False, None, None), 4: (True, 1, 60)}


def test_contamination_odd(spark, odd, empty):
    bench = spark.createDataFrame([(1, "same text again"), (2, None)], "item_id long, text string")
    assert decontaminate.contamination(odd, bench).count() == len(odd_rows())
    assert decontaminate.drop_contaminated(odd, bench).columns == odd.columns
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count() == 0


# ---------------------------------------------------------------- 7 WARC


def test_warc_round_trip(spark, tmp_path):
    r = random.Random(12)
    big = prose(r, 20)
    rows = [(i, f"http://x/{i}", prose(r, 10)) for i in range(30)] + [(100, "http://a", big), (50, "http://b", big), (70, None, big), (70, None, big), (8, "http://s", "short"), (9, "http://s", "short"), (11, "u\r\nWARC-Type: bad", None), (None, "n", big), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("mine"))
    folders = [str(tmp_path / n) for n in "ab"]
    entries = [warc.write_archive(p, f, shard_bytes=4000, roll_bytes=1500) for p, f in zip((pages, pages.orderBy(F.rand(3)).repartition(5)), folders)]
    assert entries[0] == entries[1] and len(entries[0]) > 3
    for e in entries[0]:
        data = (tmp_path / "a" / e["file"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == e["sha256"] and len(data) == e["bytes"]
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("tmp-")]
    got = warc.read_archive(spark, folders[0], with_payload=True).collect()
    assert len(got) == len(rows)
    digest = hashlib.sha256(big.encode()).hexdigest()
    same = sorted((x for x in got if x.payload_digest == digest), key=lambda x: (x.page_id is None, x.page_id or 0))
    assert [(x.page_id, x.record_type, x.refers_to) for x in same] == [(50, "response", None), (70, "revisit", 50), (70, "revisit", 50), (100, "revisit", 50), (None, "revisit", 50)]
    assert all(x.payload_bytes == len(big.encode()) for x in same)
    assert all(x.record_type == "response" for x in got if x.payload_digest != digest)
    first = {(x.page_id, bytes(x.payload)) for x in got if x.record_type == "response"}
    assert first == {(i, (t or "").encode()) for i, _, t in rows if t != big} | {(50, big.encode())}
    assert warc.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_warc_damage_is_seen(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 300)], "page_id long, url string, html string")
    e = warc.write_archive(pages, str(tmp_path / "w"))[0]
    path = tmp_path / "w" / e["file"]
    import gzip

    path.write_bytes(warc.member(gzip.decompress(path.read_bytes()).replace(b"xxx", b"yyy", 1)))
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, str(tmp_path / "w")).collect()


# ---------------------------------------------------------------- 8 surrogates


def test_permutations_are_bijections():
    for n in (1, 2, 7, 26, 100, 1000):
        assert sorted(surrogates.permute(b"k", "t", v, n) for v in range(n)) == list(range(n))
    shapes = {surrogates.reshape(b"k", "t", f"{a}{b}") for a in "abcdefghijklmnopqrstuvwxyz" for b in range(10)}
    assert len(shapes) == 260 and all(re.fullmatch("[a-z][0-9]", s) for s in shapes)


PII = "Mail ANN.LEE@Corp-X.de or ann.lee@corp-x.de, +1 (415) 555-1234, 4111 1111 1111 1111, 4111111111111111, 9.8.7.6, 123-45-6789, DE89370400440532013000. Ask Mrs. Anna Müller; Mr Иван Петров; password=hunter2xy end"


def test_every_address_and_number_has_a_surrogate():
    r = random.Random(16)
    heads = [lambda: (r.randrange(224, 256), r.randrange(256)), lambda: (r.choice((0, 10, 127)), r.randrange(256)), lambda: (192, 168), lambda: (169, 254), lambda: (172, r.randrange(256)), lambda: (r.randrange(256), r.randrange(256))]
    seen = {}
    for k in range(3000):
        a = ".".join(map(str, (*heads[k % 6](), r.randrange(256), r.randrange(256))))
        b = surrogates.surrogate(b"k", "ipv4", a, "", 0)
        assert [len(x) for x in a.split(".")] == [len(x) for x in b.split(".")] and all(int(x) < 256 for x in b.split("."))
        kinds = [surrogates.address_class(*map(int, x.split(".")[:2])) for x in (a, b)]
        assert kinds[0] == kinds[1] and seen.setdefault(b, a) == a
    for k in range(500):
        a = f"{r.randrange(1000):03d}-{r.randrange(100):02d}-{r.randrange(10_000):04d}" if k % 5 else r.choice(("000-12-3456", "666-01-0001", "900-00-0000", "123-00-1111", "001-01-0000"))
        b = surrogates.surrogate(b"k", "ssn", a, "", 0)
        good = lambda s: s[:3] in surrogates.AREAS and s[4:6] != "00" and s[7:] != "0000"
        assert good(a) == good(b) and re.fullmatch(r"\d{3}-\d\d-\d{4}", b)
    for a in ("+14155551234", "+10175557713", "+49301234567", "+33012345678", "4155551234", "0155512345"):
        assert re.fullmatch(r"\+?\d+", b := surrogates.surrogate(b"k", "phone", a, "", 0)) and len(a) == len(b)
    # a small class as a whole: a permutation
    small = [f"127.{x}.{y}.1" for x in range(10) for y in range(10)]
    assert len({surrogates.surrogate(b"k", "ipv4", a, "", 0) for a in small}) == 100


V6 = ["2001:db8::8a2e:370:7334", "fe80::1ff:fe23:4567:890a", "2001:0DB8:0000:0042:0000:8A2E:0370:7334", "2620:1ec:c11::200"]


def test_addresses_of_version_six():
    import ipaddress

    for a in V6:
        [(lo, hi, kind, entity, _)] = surrogates.found(f"at {a}, now")
        new = surrogates.dressed(kind, a, surrogates.surrogate(b"k", kind, entity, "", 0))
        assert kind == "ipv6" and new != a and len(new) == len(a) and new.count(":") == a.count(":") and ipaddress.IPv6Address(new) and new.split(":")[0] == a.split(":")[0]
    for t in ("at 12:30:45", "std::dead1 ::", "a::b1", "1:2", "x::1"):
        assert not surrogates.found(t)


def test_names_in_a_text_agree(spark):
    text = "Mr. John Smith called. Smith's car, MR JOHN SMITH, Dr Smith and john smith; Smithers. Г-н Иванов и госпожа Иванова. Prof. J. O'Brien-Lee, Mrs Anna Lee."
    docs = spark.createDataFrame([(1, text), (2, "Dr. Smith and John went; Mr John Brown too."), (3, "Smith alone, John alone.")], "doc_id long, text string")
    out = {x.doc_id: x.text for x in surrogates.replace_pii(docs).collect()}
    m = re.fullmatch(r"Mr\. (\S+) (\S+) called\. (\S+)'s car, MR (\S+) (\S+), Dr (\S+) and john smith; Smithers\. Г-н (\S+) и госпожа (\S+)\. Prof\. [A-Z]\. (\S+), Mrs (\S+) (\S+)\.", out[1])
    given, family = m[1], m[2]
    assert m and family == m[3] == m[6] and (m[4], m[5]) == (given.upper(), family.upper()) and family != "Smith" and given != "John"
    assert [m[7].endswith(e) for e, _ in surrogates.PAIRS["cyrillic"]] == [m[8].endswith(e) for _, e in surrogates.PAIRS["cyrillic"]] and m[7][:4] == m[8][:4]
    assert re.fullmatch(rf"Dr\. {family} and {given} went; Mr {given} \S+ too\.", out[2]) and out[3] == "Smith alone, John alone."


def brute_replace(texts, key=surrogates.KEY):
    """The rule in plain dictionaries: rounds of draws, the smallest entity keeps a contested one."""
    known = {x[2:] for t in texts for x in surrogates.found(t or "")}
    real = {x[:2] for x in known if x[0] != "given"}
    sizes, settled, open_ = Counter((x[0], surrogates.shape_of(*x[:2])[0]) for x in known), {}, dict.fromkeys(known, 0)
    while open_:
        drawn = {x: surrogates.surrogate(key, *x, n) for x, n in open_.items()}
        taken = {(x[0], s) for x, s in settled.items()}
        for x in sorted(drawn, key=lambda x: (x[0], x[1], x[2])):
            shape, room = surrogates.shape_of(*x[:2])
            dense = sizes[x[0], shape] > room * surrogates.DENSE
            rivals = min((y[1], y[2]) for y, s in drawn.items() if y[0] == x[0] and s == drawn[x])
            if dense or (x[0], drawn[x]) not in taken and (x[0], drawn[x]) not in real and rivals == (x[1], x[2]):
                settled[x] = drawn[x]
        open_ = {x: n + 1 for x, n in open_.items() if x not in settled}
    out = []
    for t in texts:
        for lo, hi, kind, entity, gender in reversed(surrogates.found(t or "")):
            t = t[:lo] + surrogates.dressed(kind, t[lo:hi], settled[kind, entity, gender]) + t[hi:]
        out.append(t)
    return out, settled


def test_surrogates_equal_brute_force(spark):
    r = random.Random(17)
    kinds = [
        lambda: f"Mr. {r.choice(WORDS).capitalize()} {r.choice(WORDS).capitalize()}{r.choice(WORDS)}", lambda: f"10.0.{r.randrange(3)}.{r.randrange(10)}", lambda: f"{r.randrange(1, 256)}.{r.randrange(256)}.1.2", lambda: f"{r.choice('ab')}@{r.choice('cd')}.org",
        lambda: f"Frau {r.choice(WORDS).capitalize()}{r.choice(WORDS)}", lambda: f"{r.randrange(100, 999)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}", lambda: f"token={r.randrange(10**9)}", lambda: r.choice(V6), lambda: "plain",
    ]
    texts = [" and ".join(r.choice(kinds)() for _ in range(r.randint(0, 6))) for _ in range(300)] + [None, "", PII]
    want, settled = brute_replace(texts)
    docs = spark.createDataFrame([(i if i % 7 else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, number int")
    got = {x.number: x.text for x in surrogates.replace_pii(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len({(k[0], v) for k, v in settled.items()}) == len(settled)


def test_surrogates_keep_shape_and_reference(spark):
    docs = spark.createDataFrame([(1, PII, 5), (2, "again: ann.lee@corp-x.de and 9.8.7.6", 5), (3, "clean text, 12 of them at 3.5", 5), (4, None, None), (5, "", 0)], "doc_id long, text string, n_chars long")
    out = {x.doc_id: x for x in surrogates.replace_pii(docs).collect()}
    assert out[3].text == "clean text, 12 of them at 3.5" and out[3].n_entities == 0 and out[4].text is None and out[5].text == ""
    t = out[1].text
    for gone in ("ANN.LEE", "555-1234", "4111", "9.8.7.6", "6789", "3704", "Müller", "Петров", "hunter"):
        assert gone not in t, gone
    mails = re.findall(r"\S+@[\w.-]+\w", t)
    assert mails[0].upper() == mails[0].upper() and mails[0].lower() == mails[1].lower() == re.findall(r"\S+@[\w.-]+\w", out[2].text)[0]
    cards = [re.sub(" ", "", c) for c in re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", t)]
    assert cards[0] == cards[1] and surrogates.luhn(cards[0])
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", t) and re.search(r"г|[А-Я][а-я]+ [А-Я][а-я]+", t)
    assert re.search(r"9\.8\.7\.6", out[2].text) is None
    with_n = surrogates.with_surrogates(docs).collect()
    assert {x.doc_id: x.n_chars for x in with_n} == {1: len(t), 2: len(out[2].text), 3: 5, 4: None, 5: 0}


def test_names_stay_distinct(spark):
    docs = spark.createDataFrame([(i, f"Mr. {a}{b} and Herr {a}{b} met Mrs {b.capitalize()} {a}.") for i, (a, b) in enumerate((x.capitalize(), y) for x in WORDS for y in WORDS[:20])], "doc_id long, text string")
    got = surrogates.assign(docs).collect()
    assert len({(x.kind, x.surrogate) for x in got}) == len(got) and max(x.attempt for x in got) >= 1
    assert not {x.surrogate for x in got if x.kind == "family"} & {x.entity for x in got}
    for x in surrogates.replace_pii(docs).limit(200).collect():
        a, b = re.findall(r"(?:Mr\.|Herr) (\S+)", x.text)
        assert a == b


def test_entities_without_digits(spark):
    nbsp, hexed = "\u00a0", "abcdef" * 6
    texts = [f"log {k}=hunter-word end" for k in ("password", "passwd", "secret", "token", "api_key")]
    texts += [f"Bitte Dr.{nbsp}Müller fragen", f"Frau{nbsp}Schmidt kam", f"the '{hexed}' here"]
    assert all([x[:3] for x in surrogates.found(t)] == [x[:3] for x in surrogates.found(f"{t} 1")] and len(surrogates.found(t)) == 1 for t in texts)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "only words here", *(f"{t} 1" for t in texts)])], "doc_id long, text string")
    out = {x.doc_id: x.text for x in surrogates.replace_pii(docs).collect()}
    n = len(texts)
    assert out[n] == "only words here" and all(out[i] + " 1" == out[n + 1 + i] and out[i] != t for i, t in enumerate(texts))
    assert not any(gone in out[i] for i in range(n) for gone in ("hunter", "Müller", "Schmidt", hexed))


SECRET_FORMS = [
    'TOKEN = "{}"', "token={}", "Password : {} end", "passwd: '{}'", '{{"api_key": "{}"}}', "API-KEY={}", "secret := {}", "aws_secret_access_key = {}", "AWS secret access key: {}",
]


@pytest.mark.parametrize("form", SECRET_FORMS)
def test_secrets_after_keys(form):
    for value in ("hunter-word", "Hunter2xy", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"):
        text = form.format(value)
        assert [(text[lo:hi], kind) for lo, hi, kind, *_ in surrogates.found(text)] == [(value, "secret")]


def test_secrets_that_show_by_themselves(spark):
    r = random.Random(12)
    some = lambda n, a="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ": "".join(r.choice(a) for _ in range(n))
    keys = {f"sk-ant-{some(30)}": "sk-ant-", f"sk-proj-{some(24)}": "sk-proj-", f"ghp_{some(36)}": "ghp_", f"AKIA{some(16, 'ABCDEFGHIJ')}": "AKIA", f"eyJ{some(20)}.{some(30)}.{some(5000)}": "eyJ"}
    low, word = "92" + "3a8ecf7c5b09fe5949719b6b82bc439e9329bf", some(40)
    texts = [f"see {k} there" for k in keys] + [f"Authorization: Bearer {k}" for k in keys] + [f'token = "{k}"' for k in keys]
    texts += [f"'{low}' here", f'TOKEN: "{low.upper()}" HERE', f"bearer {word}.", f"token=ann.lee@corp-x.de or {'x'}", f"-----BEGIN RSA PRIVATE KEY-----\n{some(1600)}\n-----END RSA PRIVATE KEY-----", "task-force, tokens: 5, bearer of news", "secret=" + some(6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {x.doc_id: x for x in surrogates.replace_pii(docs).collect()}
    for j, (k, head) in enumerate(keys.items()):
        new = out[j].text.split()[1]
        assert new.startswith(head) and new != k and len(new) == len(k)
        assert out[5 + j].text == f"Authorization: Bearer {new}" and out[10 + j].text == f'token = "{new}"'
    a, b = out[15].text.split("'")[1], out[16].text.split('"')[1]
    assert a != low and re.fullmatch("[0-9a-f]{40}", a) and b == a.upper()
    assert re.fullmatch(r"bearer [A-Za-z]{40}\.", out[17].text) and word not in out[17].text
    assert [x[2] for x in surrogates.found(texts[18])] == ["email"] and out[20].text == texts[20]
    assert out[19].text[:40] != texts[19][:40] and out[19].text.endswith("\n-----END RSA PRIVATE KEY-----") and out[21].text[7:100] != texts[21][7:100]


def test_surrogates_odd(odd, empty):
    got = surrogates.replace_pii(odd)
    assert got.count() == len(odd_rows()) and [c for c in got.columns if c != "n_entities"] == odd.columns
    assert surrogates.replace_pii(empty).count() == 0


# ---------------------------------------------------------------- 9 toxicity


def test_toxicity_learns_and_spells(spark):
    r = random.Random(13)
    bad = ["blorgast", "vexinoid", "krumpfel"]

    def text(toxic):
        words = [r.choice(WORDS) for _ in range(r.randint(5, 120))]
        for _ in range(2 * toxic):
            words.insert(r.randrange(len(words)), r.choice(bad))
        return " ".join(words)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {x.doc_id: x for x in toxicity.toxicity(docs, labels).collect()}
    held = [i for i, _, _ in rows if got[i].held_out]
    assert len(held) > 100 and np.mean([got[i].predicted == dict((a, c) for a, _, c in rows)[i] for i in held]) > 0.95
    odds = lambda t: toxicity.odds(pa.array([t]), model)[0]
    plain = odds("kaba loder mifin rugol")
    assert odds("kaba loder blorgasst rugol") > plain and odds("kaba vexin0id mifin rugol") > plain
    assert {x.doc_id for x in toxicity.drop_toxic(docs, labels).collect()} == {i for i, x in got.items() if not x.predicted}


def test_toxicity_passes_over_a_text_that_does_not_fit(spark):
    texts = {i: f"kaba loder {'blorgast vexinoid' if i % 2 else 'mifin rugol'} {WORDS[i % 60]}" for i in range(80)}
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, toxic int")
    order = [r.doc_id for r in labels.where(~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()]
    frame = lambda t: spark.createDataFrame(list(t.items()), "doc_id long, text string")
    model = toxicity.fit(frame(texts | {order[0]: "x" * 50_000}), labels, most_bytes=20_000)
    toxic, clean = toxicity.odds(pa.array(["kaba blorgast vexinoid", "kaba mifin rugol"]), model)
    assert toxic > 0 > clean
    with pytest.raises(ValueError, match="toxic = .1."):
        toxicity.fit(frame({i: t * (500 if i % 2 else 1) for i, t in texts.items()}), labels, most_bytes=5_000)


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (7, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got)
    none = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert all(x.predicted == 0 for x in none)
    assert toxicity.toxicity(empty, labels).count() == 0 and toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns


def test_scores_equal_brute_force():
    """Every window's mean over its grams' embeddings, from the embeddings themselves."""
    r = random.Random(18)
    texts = [prose(r, 3) for _ in range(12)] + ["", "one", "Ünïcödé wörds, twice; ünïcödé", "a" * 5000, "x y " * 700]
    m = toxicity.train(texts[:12], np.arange(12) % 2, epochs=2)

    def grams(word):
        raw = b"#" + word + b"#"
        parts = [raw[i : i + n] for n in toxicity.GRAMS for i in range(len(raw) - n + 1) if raw[i] & 0xC0 != 0x80]
        code = lambda g: sum(int(shared.BYTE_CODE[b]) * pow(0x100000001B3, len(g) - 1 - k, 1 << 64) for k, b in enumerate(g)) + len(g)
        return [int(shared.mix64(np.array([code(g) & shared.MASK], np.uint64))[0]) % toxicity.BUCKETS for g in parts]

    for t, got in zip(texts, toxicity.odds(pa.array(texts), m)):
        w = shared.Words(pa.array([t]))
        words = [[int(h) % toxicity.BUCKETS, *grams(w.data[s:e].tobytes())] for h, s, e in zip(w.hash.tolist(), w.start, w.end)]
        step, width = toxicity.WINDOW // 2, toxicity.WINDOW
        starts = range(0, max(1, len(words) - step), step) if words else []
        z = [m.bias + m.vectors[[g for x in words[i : i + width] for g in x]].mean(axis=0) @ m.weights for i in starts]
        want = max((float(v[1] - v[0]) for v in z), default=m.offset)
        assert got == pytest.approx(want, abs=1e-4), t[:40]


def test_scores_do_not_depend_on_the_batch():
    r = random.Random(14)
    texts = [prose(r, 5) for _ in range(20)] + ["", "a"]
    m = toxicity.train(texts[:20], np.arange(20) % 2, epochs=2)
    whole = toxicity.odds(pa.array(texts), m)
    assert np.allclose(whole, [toxicity.odds(pa.array([t]), m)[0] for t in texts])


# ---------------------------------------------------------------- 10 mixing


def test_mixing(spark, odd, empty):
    r = random.Random(15)
    rows = [(i, prose(r, r.randint(1, 9)), f"s{min(r.randrange(9), 4)}") for i in range(300)] + [(300, None, "s0"), (301, " \t\n", None), (302, "one  two\x0bthree", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.taken_by_document(docs, rows_each=7).collect()
    again = mixing.taken_by_document(docs.repartition(3), rows_each=50).collect()
    key = lambda x: (x.doc_id, x.size, x.source_size, x.target, x.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    assert {x.doc_id: x.size for x in got} == sizes and all(0 <= x.taken <= 3 * x.size for x in got)
    source = {i: s for i, _, s in rows}
    taken, target = defaultdict(int), {}
    for x in got:
        taken[source[x.doc_id]] += x.taken
        target[source[x.doc_id]] = x.target
    assert all(taken[s] == int(target[s]) for s in target)
    # the rule, step by step: shares by weight, capped, the excess reshared
    total = sum(sizes.values())
    names = sorted({s for s in source.values() if s is not None}) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    cap = {s: 3 * sum(n for i, n in sizes.items() if source[i] == s) for s in names}
    want, free, left = {}, set(names), float(total)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = cap[s]
            left -= cap[s]
        free -= over
    assert all(target[s] == pytest.approx(want[s]) for s in names)
    assert len(mixing.taken_by_document(odd).collect()) == len(odd_rows()) and mixing.taken_by_document(empty).count() == 0
    out = mixing.mix(docs).collect()
    assert [x.mix_finish for x in out] == sorted(x.mix_finish for x in out)
    assert sum(x.mix_words for x in out) == sum(x.taken for x in got)
    assert mixing.mix(odd).columns[: len(odd.columns)] == odd.columns


def test_the_mix_takes_what_the_report_says(spark):
    """Equal rows share a cut document's words exactly, whatever their other columns, and a cut text keeps its space."""
    rows = [(1, "one two\n three", "a", f"x{i % 3}") for i in range(7)] + [(2, "  x\ty  z " * 4, "b", "x"), (3, "w " * 50, "c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more string")
    for budget in (None, 60, 40, 11):
        want, got, texts = Counter(), Counter(), {1: rows[0][1], 2: rows[7][1], 3: rows[8][1]}
        for x in mixing.taken_by_document(docs, budget=budget).collect():
            want[x.doc_id] += x.taken
        for x in mixing.mix(docs, budget=budget).collect():
            got[x.doc_id] += x.mix_words
            assert len(x.text.split()) == x.mix_words > 0 and texts[x.doc_id].startswith(x.text)
        assert +want == +got


def test_the_queue_is_cut_at_the_budget(spark):
    """All sources in one order of finish time, and the first so many words of it."""
    r = random.Random(19)
    rows = [(i, prose(r, r.randint(1, 5)), f"s{i % 3}") for i in range(200)] + [(7, rows_text := prose(r, 2), "s1"), (7, rows_text, "s1"), (None, prose(r, 2), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = mixing.taken_by_document(docs, rows_each=9).collect()
    total = sum(x.size for x in whole)
    units, queue = mixing.fair_queue(docs, rows_each=9)
    order = sorted(queue.collect(), key=lambda x: (min(x.finish, 1.0), x.key))
    assert sorted({x.position for x in order}) == [x for x in range(max(y.position for y in order) + 1)] and [x.position for x in order] == sorted(x.position for x in order)
    assert sum(x.taken for x in order) == sum(x.taken for x in whole) <= total
    for budget in (0, 1, total // 3, total // 2, total - 1, total, 2 * total):
        left, want = budget, {}
        for x in order:
            n = min(x.taken, left)
            left -= n
            if n:
                want[x.key] = n
        _, cut = mixing.fair_queue(docs, rows_each=9, budget=budget)
        got = {x.key: x.taken for x in cut.collect()}
        assert got == want and sum(got.values()) == min(budget, sum(x.taken for x in order))
    # half of the budget is near half of each source's target
    half = mixing.taken_by_document(docs, rows_each=9, budget=total // 2).collect()
    for s in {x.target for x in half}:
        some = [x for x in half if x.target == s]
        assert abs(sum(x.taken for x in some) - s / 2) <= 2 * max(x.size for x in some) + total / 50
