"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A shingle is five words (all words of a shorter text), its weight occurrences times
``idf(share) = ln(e + 1 / (share + 1/8))``, where ``share`` is the share of documents that hold
it.  The idf is gentle on purpose: copies of one text in a large group must not lose their
likeness because the group itself makes their shingles frequent.  Shares come from a count-min
sketch of fixed size over all documents; its error is a share of the corpus, so it acts alike
at every size.

Two different texts are linked when their weighted Jaccard similarity is at least
``THRESHOLD``; a class is a connected component of links.  Equal texts are one node throughout.
A text without words links to nothing but its equals.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import MASK, Words, batches, components, dispose, give_back, mix64, pieces, spans, stored, text_key

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 14, 4
HASHES = BANDS * ROWS
#: Pairs whose signatures agree on a smaller share are not verified: over five standard
#: deviations below the threshold.
SURE = 0.5
DEPTH, WIDTH, BLOCK = 2, 1 << 17, 4096
#: Members, and bytes of their texts, on a side of a cell.
CELL, CELL_BYTES = 2000, 8_000_000


def gamma_quantiles(bits: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1), by Newton's method on its distribution function."""
    u = (np.arange(1 << bits) + 0.5) / (1 << bits)
    x = np.sqrt(2 * u) + 2 * u
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - u) / np.maximum(x * np.exp(-x), 1e-12), 1e-6)
    return x


TABLES: dict[str, np.ndarray] = {}


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not TABLES:
        r = gamma_quantiles(16)
        TABLES["r"], TABLES["ri"] = r.astype(np.float32), (1 / r).astype(np.float32)
        TABLES["lnc"] = np.log(gamma_quantiles(18)).astype(np.float32)
    return TABLES["r"], TABLES["ri"], TABLES["lnc"]


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Distinct shingles of each text in order of text and shingle: hash, text, occurrences; and
    the number of texts."""
    words = Words(texts)
    sh, owner = spans(words, SHINGLE)
    # a stable sort by hash, then by text, in one key where texts are few
    order = np.lexsort((sh, owner))
    sh, owner = sh[order], owner[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return sh[at], owner[at], np.diff(np.append(at, len(sh))), words.n


def cells(sh: np.ndarray) -> list[np.ndarray]:
    return [((sh >> np.uint64(20 * d)) & np.uint64(WIDTH - 1)).astype(np.intp) for d in range(DEPTH)]


def shingle_shares(docs: DataFrame) -> np.ndarray:
    """The sketch as shares of the documents, (DEPTH, WIDTH): about 1 MB whatever the input."""

    def count(source):
        sketch, n = np.zeros((DEPTH, WIDTH), np.int64), 0
        for batch in source:
            for piece in pieces(batch):
                sh, _, _, rows = bags(piece.column(0))
                n += rows
                for d, at in enumerate(cells(sh)):
                    sketch[d] += np.bincount(at, minlength=WIDTH)
        blocks = [(-1, np.array([n], np.int64))] + [(i, b) for i, b in enumerate(sketch.reshape(-1, BLOCK)) if b.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([b.tobytes() for _, b in blocks], pa.binary())], names=["block", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf.counts.iloc[0], np.int64).copy()
        for b in pdf.counts.iloc[1:]:
            total += np.frombuffer(b, np.int64)
        return pd.DataFrame({"block": pdf.block.iloc[:1], "counts": [total.tobytes()]})

    rows = docs.select("text").mapInArrow(count, "block int, counts binary").groupBy("block").applyInPandas(add, "block int, counts binary").collect()
    sketch, n = np.zeros((DEPTH * WIDTH // BLOCK, BLOCK), np.int64), 0
    for block, counts in rows:
        if block < 0:
            n = int(np.frombuffer(counts, np.int64)[0])
        else:
            sketch[block] = np.frombuffer(counts, np.int64)
    return (sketch.reshape(DEPTH, WIDTH) / max(1, n)).astype(np.float32)


def weights(sh: np.ndarray, tf: np.ndarray, shares: np.ndarray) -> np.ndarray:
    share = np.minimum.reduce([shares[d][at] for d, at in enumerate(cells(sh))])
    return tf * np.log(np.e + 1 / (share.astype(np.float64) + 0.125))


def signatures(sh: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and for each HASHES samples (shingle, level) as uint64 names.

    Per hash: r, c ~ Gamma(2, 1), beta ~ U(0, 1) from the shingle; t = floor(ln w / r + beta),
    ln a = ln c - r (t - beta + 1); the sample is the shingle and t of the least a."""
    r_table, ri_table, lnc_table = tables()
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    out = np.zeros((len(begin), HASHES), np.uint64)
    if not len(begin):
        return owner[begin], out
    lnw, key = np.log(weight).astype(np.float32), np.empty(len(sh), np.uint64)
    for k in range(HASHES):
        odd, salt = np.uint64((0xD6E8FEB86659FD93 * (2 * k + 1) + 2 * k * k) & MASK | 1), np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & MASK)
        for lo in range(0, len(sh), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            z = (sh[part] ^ salt) * odd
            at = (z >> np.uint64(48)).astype(np.intp)
            r = r_table[at]
            beta = ((z >> np.uint64(7)) & np.uint64((1 << 23) - 1)).astype(np.float32)
            beta *= np.float32(2.0**-23)
            t = np.floor(lnw[part] * ri_table[at] + beta)
            beta -= t
            beta -= np.float32(1)
            beta *= r
            beta += lnc_table[((z >> np.uint64(30)) & np.uint64((1 << 18) - 1)).astype(np.intp)]
            beta += np.float32(64)  # positive, so that the bits of a float sort like its value
            name = (z ^ (t.astype(np.int32).view(np.uint32) * np.uint64(0x9E3779B97F4A7C15))) & np.uint64(0xFFFFFFFF)
            key[part] = (beta.view(np.uint32).astype(np.uint64) << np.uint64(32)) | name
        out[:, k] = np.minimum.reduceat(key, begin)
    return owner[begin], mix64(out + np.arange(HASHES, dtype=np.uint64))


def weighted_jaccard(left: pa.Array, right: pa.Array, shares: np.ndarray) -> np.ndarray:
    """Exact similarity of each pair of texts."""
    a, ao, at, n = bags(left)
    b, bo, bt, _ = bags(right)
    aw, bw = weights(a, at, shares), weights(b, bt, shares)
    sh, owner = np.concatenate((a, b)), np.concatenate((ao, bo))
    w = np.concatenate((aw, bw))
    order = np.lexsort((sh, owner))
    sh, owner, w = sh[order], owner[order], w[order]
    same = np.flatnonzero((sh[1:] == sh[:-1]) & (owner[1:] == owner[:-1]))
    low = np.bincount(owner[same], np.minimum(w[same], w[same + 1]), minlength=n)
    total = np.bincount(owner, w, minlength=n)
    return np.divide(low, total - low, out=np.zeros(n), where=total > low)


def signed(docs: DataFrame, shares) -> DataFrame:
    """doc_id, node (the text's name), its bytes, sig (16 bits a sample) and bands of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sh, owner, tf, n = bags(batch.column(2))
        who, names = signatures(sh, owner, weights(sh, tf, shares.value))
        sig, bands = [None] * n, [None] * n
        keys = np.zeros((len(who), BANDS), np.uint64)
        for b in range(BANDS):
            for r in range(ROWS):
                keys[:, b] = mix64(keys[:, b] + names[:, b * ROWS + r])
        short, keys = names.astype(np.uint16), keys.view(np.int64)
        for i, d in enumerate(who):
            sig[d], bands[d] = short[i].tobytes(), keys[i]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "node", "bytes", "sig", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("node"), "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"))
    return batches(rows, work, "doc_id long, node string, bytes long, sig binary, bands array<long>")


def likely(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Of pairs ``a``, ``b``, those whose signatures agree well enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in (2, 3))
        keep = pa.array((x == y).mean(axis=1) >= SURE)
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    rows = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a").join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b")
    return batches(rows.select("a", "b", "x", "y"), work, "a string, b string")


def verified(pairs: DataFrame, texts: DataFrame, shares) -> DataFrame:
    """Of pairs ``a``, ``b``, those that are similar by their whole texts."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = pa.array(weighted_jaccard(batch.column(2), batch.column(3), shares.value) >= THRESHOLD - 1e-9)
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return batches(rows.select("a", "b", "x", "y"), work, "a string, b string")


def streamed(rows: DataFrame, keys: list[str], work, schema: str, most: int = 4_000_000) -> DataFrame:
    """Deal rows out by ``keys`` and hand whole groups, many small ones at a time, to ``work``:
    a list of record batches' columns as Arrow table and the first row of each group."""
    names = rows.columns
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(source):
        held: list[pa.RecordBatch] = []
        size = 0

        def key_at(batch: pa.RecordBatch, i: int) -> tuple:
            return tuple(batch.column(k)[i].as_py() for k in keys)

        for batch in source:
            for piece in pieces(batch, most):
                # what is held may end with a group that goes on in this piece
                head = 0
                if held and size + piece.nbytes > most:
                    last = key_at(held[-1], held[-1].num_rows - 1)
                    while head < piece.num_rows and key_at(piece, head) == last:
                        head += 1
                    if head:
                        held.append(piece.slice(0, head))
                    if head < piece.num_rows:
                        yield from work(pa.Table.from_batches(held))
                        held, size = [], 0
                if head < piece.num_rows:
                    held.append(piece.slice(head))
                    size += piece.nbytes
        if held:
            yield from work(pa.Table.from_batches(held))

    assert set(keys) <= set(names)
    return dealt.mapInArrow(run, schema)


def group_edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups of equal keys begin in a sorted table, and its end."""
    n = table.num_rows
    new = np.zeros(n, bool)
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    new[:1] = True
    return np.append(np.flatnonzero(new), n)


CELL_KEYS = ["band", "key", "i", "j"]
CELL_SCHEMA = "band int, key long, i int, j int, seeker boolean, node string, root string"


def contenders(members: DataFrame, roots: DataFrame, bands: DataFrame) -> DataFrame:
    """The members of buckets that may link different components, in cells.

    In each bucket with several components the members outside its largest one (seekers) are
    compared with all members, in cells of about CELL by CELL, and of fewer where their texts are
    long: a worker holds a cell's texts.  A pair counts in its first common band, by the band keys that
    made the buckets (``bands``: node and bands), and only members of a likely pair stay."""
    rows = members.join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    rows = rows.select("band", "key", "node", "bytes", "sig", F.coalesce("root", "node").alias("root"))
    each = rows.groupBy("band", "key", "root").agg(F.count("*").alias("count"), F.sum("bytes").alias("bytes"))
    most = F.max(F.struct("count", "root", "bytes"))
    open_ = each.groupBy("band", "key").agg(F.count("*").alias("roots"), most.alias("most"), F.sum("count").alias("size"), F.sum("bytes").alias("weight")).where("roots > 1")
    open_ = open_.select("band", "key", F.col("most.root").alias("major"), F.col("most.count").alias("top"), F.col("most.bytes").alias("top_weight"), "size", "weight")
    rows = rows.join(open_.withColumnRenamed("band", "bd").withColumnRenamed("key", "ky"), (F.col("band") == F.col("bd")) & (F.col("key") == F.col("ky")))
    rows = rows.join(bands.select(F.col("node").alias("b_node"), "bands"), F.col("node") == F.col("b_node"))
    minor = F.col("root") != F.col("major")
    spot = F.xxhash64("node")
    sides = lambda n, b: F.greatest(F.ceil(n / CELL), F.ceil(b / CELL_BYTES)).cast("int")
    whole, small = sides(F.col("size"), F.col("weight")), sides(F.col("size") - F.col("top"), F.col("weight") - F.col("top_weight"))
    in_all = F.transform(F.sequence(F.lit(0), small - 1), lambda i: F.struct(i.alias("i"), F.pmod(spot, whole).cast("int").alias("j"), F.lit(False).alias("seeker")))
    seeks = F.transform(F.sequence(F.lit(0), whole - 1), lambda j: F.struct(F.pmod(spot, small).cast("int").alias("i"), j.alias("j"), F.lit(True).alias("seeker")))
    # keys of the bands before this one tell whether a pair has met already
    rows = rows.select("band", "key", "node", "sig", F.slice("bands", 1, F.col("band")).alias("bands"), "root", F.explode(F.when(minor, F.concat(in_all, seeks)).otherwise(in_all)).alias("at"))
    rows = rows.select("band", "key", "at.i", "at.j", "at.seeker", "node", "root", "sig", "bands")

    def work(table: pa.Table):
        edges = group_edges(table, CELL_KEYS)
        seeker = table.column("seeker").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
        root = table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        band, earlier = table.column("band").to_numpy(), table.column("bands").combine_chunks()
        at, flat = earlier.offsets.to_numpy(), earlier.values.to_numpy()
        keep = np.zeros(len(seeker), bool)
        for lo, hi in zip(edges[:-1], edges[1:]):
            left, right = lo + np.flatnonzero(seeker[lo:hi]), lo + np.flatnonzero(~seeker[lo:hi])
            keys = flat[at[lo] : at[hi]].reshape(hi - lo, band[lo])
            for part in np.array_split(left, max(1, len(left) * len(right) // 20_000)):
                equal = sig[part][:, None] == sig[right][None]
                a, b = np.nonzero((equal.mean(axis=2) >= SURE) & (root[part][:, None] != root[right][None]))
                if len(a):
                    a, b = part[a], right[b]
                    first = ~(keys[a - lo] == keys[b - lo]).any(axis=1)
                    keep[a[first]] = keep[b[first]] = True
        yield from table.drop_columns(["sig", "bands"]).filter(pa.array(keep)).to_batches()

    return streamed(rows, CELL_KEYS, work, CELL_SCHEMA)


def spanning_links(rows: DataFrame, texts: DataFrame, shares) -> DataFrame:
    """Links between different components, found by the exact similarity of all seekers of a
    cell to all its members; a cell gives no more links than join its components."""
    rows = rows.join(texts.withColumnRenamed("node", "n"), F.col("node") == F.col("n")).select(*[c.split()[0] for c in CELL_SCHEMA.split(", ")], "text")

    def work(table: pa.Table):
        edges = group_edges(table, CELL_KEYS)
        seeker, node = table.column("seeker").to_numpy(), table.column("node").to_pylist()
        root = table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        sh, owner, tf, n = bags(table.column("text"))
        idf = weights(sh, np.ones(len(sh)), shares.value)
        total = np.bincount(owner, tf * idf, n)
        # an occurrence is a feature, so the shared weight is a scalar product
        more = np.repeat(np.arange(len(sh)), tf)
        nth = np.arange(len(more)) - np.repeat(np.cumsum(tf) - tf, tf)
        sh, owner, weight = mix64(sh[more] + nth.astype(np.uint64)), owner[more], np.sqrt(idf[more])
        at = np.searchsorted(owner, np.arange(n + 1))
        a, b = [], []
        for lo, hi in zip(edges[:-1], edges[1:]):
            left, right = np.flatnonzero(seeker[lo:hi]), np.flatnonzero(~seeker[lo:hi])
            part = slice(at[lo], at[hi])
            _, back, counts = np.unique(sh[part], return_inverse=True, return_counts=True)
            place = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[back]
            who, w, common = owner[part] - lo, weight[part], np.zeros((len(left), len(right)))
            order = np.argsort(place, kind="stable")
            for f in range(0, int(place.max(initial=-1)) + 1, 2048):
                use = order[np.searchsorted(place[order], f) : np.searchsorted(place[order], f + 2048)]
                x = np.zeros((hi - lo, 2048))
                x[who[use], place[use] - f] = w[use]
                common += x[left] @ x[right].T
            similar = common / (total[lo:hi][left][:, None] + total[lo:hi][right][None] - common)
            near = np.argwhere((similar >= THRESHOLD - 1e-9) & (root[lo:hi][left][:, None] != root[lo:hi][right][None]))
            top = {r: r for r in root[lo:hi].tolist()}

            def find(r: int) -> int:
                while top[r] != r:
                    r = top[r]
                return r

            for i, k in near.tolist():
                p, q = find(root[lo + left[i]]), find(root[lo + right[k]])
                if p != q:
                    top[p] = q
                    a.append(node[lo + left[i]])
                    b.append(node[lo + right[k]])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return streamed(rows, CELL_KEYS, work, "a string, b string")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, node (name of the text), class_id and class_node of every row of ``docs``.

    ``class_id`` is the smallest doc_id of the class, null only where all its ids are;
    ``class_node`` names the class and the text of ``class_id``.  Needs doc_id and text; null
    texts count as empty ones, repeated rows repeat in the result, an empty table gives no rows.  Texts are read
    whole: a worker holds a few megabytes of them at a time, and a longer one alone."""
    spark = docs.sparkSession
    shares = spark.sparkContext.broadcast(shingle_shares(docs))
    rows = stored(signed(docs, shares), "signed")
    by_node = stored(rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("least"), F.max("bytes").alias("bytes"), F.max("sig").alias("sig"), F.max("bands").alias("bands")), "nodes")
    banded = by_node.where("sig is not null").select("node", "bytes", "sig", F.posexplode("bands").alias("band", "key"))
    stars = banded.groupBy("band", "key").agg(F.min("node").alias("star"), F.count("*").alias("size")).where("size > 1")
    members = stored(banded.join(stars, ["band", "key"]).select("band", "key", "node", "bytes", "sig", "star"), "members")
    pairs = likely(members.where("node <> star").select(F.col("node").alias("a"), F.col("star").alias("b")).distinct(), by_node)
    pairs = stored(pairs, "pairs")
    give_back(spark)
    involved = members.select("node").distinct().join(by_node.select("node", "least.doc_id"), "node").select(F.col("node").alias("n"), F.col("doc_id").alias("d"))
    # one row for each text: its smallest id, so that copies of a text don't meet in one task
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(involved, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi").select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]), "texts")
    links = stored(verified(pairs, texts, shares), "links")
    roots = stored(components(links), "roots")
    give_back(spark)
    rows_left = stored(contenders(members, roots, by_node.select("node", "bands")), "contenders")
    if not rows_left.isEmpty():
        links = stored(links.union(spanning_links(rows_left, texts, shares)), "links")
        roots = stored(components(links), "roots")
    dispose(members, texts, links, pairs, rows_left)
    named = by_node.select("node", "least").join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    heads = named.groupBy("root").agg(F.min(F.struct("least.no_id", "least.doc_id", "node")).alias("head"))
    named = stored(named.join(heads, "root").select("node", F.col("head.doc_id").alias("class_id"), F.col("head.node").alias("class_node")), "classes")
    return rows.select("doc_id", "node").join(named, "node").select("doc_id", "node", "class_id", "class_node")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, the one of the smallest id, with all its columns.  Null ids come last, null and
    empty texts are one class, and of rows that repeat id and text one stays."""
    classes = near_duplicates(docs)
    kept = classes.where("node = class_node and doc_id <=> class_id").groupBy("doc_id", "node").count()
    kept = stored(kept.select(F.col("doc_id").alias("k_id"), F.col("node").alias("k_node"), "count"), "kept")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    rows = rows.join(kept.drop("count"), F.col("row.doc_id").cast("long").eqNullSafe(F.col("k_id")) & (text_key(F.col("row.text")) == F.col("k_node")), "left_semi")
    if not kept.where("count > 1").isEmpty():
        # rows that repeat both id and text: any one of them
        rows = rows.withColumn("key", F.struct(F.col("row.doc_id"), text_key(F.col("row.text")))).dropDuplicates(["key"]).drop("key")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
