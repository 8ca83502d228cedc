"""Near copies by ProbMinHash: weighted word shingles, banding, verification, classes.

1. **Signatures** (no shuffle). A text's lower-case words give runs of five, weighted by how
   often they occur. Each run is a Poisson process whose rate is its weight; every arrival
   goes to a random register, and each register keeps its earliest arrival. A run is done
   with as soon as its next arrival is later than all registers of its text. Two texts agree
   in a register with their probability Jaccard similarity.
2. **Exact copies** collapse to one node per text, with partial aggregation.
3. **Banding.** 25 bands of five registers: two texts at 0.8 miss all bands with a chance of
   5e-5. All rows of a band are range-partitioned and sorted by band key *and the registers
   after it*, so that a large bucket may lie across tasks. Each text is a candidate pair with
   the first of its bucket, which is enough to join a group of copies: more links would only
   be sent along in step 5. Where a bucket crosses tasks, its heads are paired. All other
   pairs are left to step 6.
4. **Verification** on the whole texts' runs: exact probability Jaccard of 0.8 or more.
5. **Classes** are the connected components of the verified links, of which a text keeps one
   (its other heads are linked with that head instead): smallest labels travel along links
   and jump to their label's label, every round in the shared folder.
6. **The rest of the buckets.** A bucket whose texts are of one component by now can add
   nothing. In every other bucket all pairs of texts of different components are compared,
   block against block (blocks by the hash of the node, bounded in rows and runs; the texts
   of the bucket's largest component are never compared with each other). A bound that no
   similar pair is below (the cosine of the roots of the shares) goes before the exact
   similarity. Only links that join two components leave a task; with them the classes are
   made again. So a class is whole whenever its links meet in any bucket.

Texts of one to four words are one run of all of them. A null or empty text (no words) is
like no other: a class of its own, per id. A null id takes part by its text; its class has
the smallest id that is not null, or null. Rows that repeat an id and a text are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subjectflow.llm.common import fresh, kept_by_worker, stored, text_of, whole_texts
from subjectflow.operators.joins import lookup_join

RUN = 5
SIMILAR = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Texts and runs of a block, about, when the rest of a bucket is compared.
BLOCK_TEXTS, BLOCK_RUNS = 1_024, 2_000_000
#: Columns of a dense matrix of shared runs at a time.
_COLUMNS = 4_096
_NO_ID = (1 << 63) - 1

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_PLACE = mixed(np.arange(11, 11 + RUN, dtype=np.uint64) * _BASE) | _U(1)
_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of UTF-8 bytes, from running sums of a polynomial (no loop over words)."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    blank = _BLANK[data]
    edges = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    first, last = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    power, inverse = _powers(len(data) + 1)
    sums = np.concatenate([[_U(0)], np.cumsum(_LETTER[data] * power[: len(data)])])
    return mixed((sums[last] - sums[first]) * inverse[first])


def runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of five words (64-bit hashes, ascending) and how often each occurs."""
    words = word_hashes(np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8))
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    size = max(1, n - RUN + 1)
    total = np.zeros(size, dtype=np.uint64)
    for k in range(min(RUN, n)):
        total += words[k : k + size] * _PLACE[k]
    return np.unique(mixed(total), return_counts=True)


def signatures(items: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """ProbMinHash registers (texts by registers): the run that arrived first, as 64 bits."""
    sizes = np.array([len(u) for u, _ in items])
    texts = len(items)
    out = np.zeros((texts, REGISTERS), dtype=np.uint64)
    if not sizes.sum():
        return out
    row = np.repeat(np.arange(texts), sizes)
    run = np.concatenate([u for u, _ in items])
    rate = np.concatenate([c for _, c in items]).astype(float)
    best = np.full(texts * REGISTERS, np.inf)
    first, time, k = out.reshape(-1), np.zeros(len(run)), 0
    while len(run):
        k += 1
        draw = mixed(run + _U(k * int(_BASE) & _MASK))
        time = time - np.log(((draw >> _U(12)).astype(float) + 0.5) / 2.0**52) / rate
        slot = row * REGISTERS + (mixed(draw) % _U(REGISTERS)).astype(np.int64)
        better = time < best[slot]
        where = slot[better]
        np.minimum.at(best, where, time[better])
        won = best[where] == time[better]
        first[where[won]] = run[better][won]
        latest = best.reshape(texts, REGISTERS).max(axis=1)
        going = time < latest[row]
        row, run, rate, time = row[going], run[going], rate[going], time[going]
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets: the sum over shared i of 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    shared, at, to = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = a[1][at].astype(float), b[1][to].astype(float)
    x_only, y_only = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    ratio = x / y
    total = 0.0
    for r in np.unique(ratio):
        own = x[ratio == r].sum()
        total += own / (np.maximum(x, r * y).sum() + x_only + r * y_only)
    return float(total)


def node_of(doc_id, text: str) -> bytes:
    """128 bits that stand for a text; for a text without words, for its id."""
    return hashlib.md5(text.encode("utf-8", "replace") if text.strip(" \t\n\r\x0b\x0c") else f"\0{doc_id}".encode()).digest()


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``node``, and for texts with words the 25 band keys and the order of each within its bucket; ``size``: its distinct runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("neardup",))
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["_text"].tolist()
            for part in _portions(texts):
                items = [runs(texts[i]) for i in part]
                regs = mixed(signatures(items))
                keys = np.zeros((len(part), BANDS), dtype=np.uint64)
                for r in range(ROWS):
                    keys = mixed(keys + regs[:, r::ROWS] * _PLACE[r])
                # 21 bits of each of the three registers after the band
                after = np.roll(regs, -ROWS, axis=1) >> _U(43)
                order = after[:, 0::ROWS] << _U(42) | after[:, 1::ROWS] << _U(21) | after[:, 2::ROWS]
                some = [len(u) > 0 for u, _ in items]
                yield pd.DataFrame({
                    "doc_id": [ids[i] for i in part], "node": [node_of(ids[i], texts[i]) for i in part],
                    "keys": [k if s else None for k, s in zip(keys.astype(np.int64), some, strict=True)],
                    "orders": [o if s else None for o, s in zip(order.astype(np.int64), some, strict=True)],
                    "size": [len(u) for u, _ in items],
                })

    source = whole_texts(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text_of().alias("_text"))
    return source.mapInPandas(run, "doc_id long, node binary, keys array<long>, orders array<long>, size long")


def _portions(texts: list[str], chars: int = 1_000_000) -> Iterator[range]:
    """Consecutive texts of about so many characters together; a longer one alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield range(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield range(start, len(texts))


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs of nodes (``a`` < ``b``) of the linear pass, and the buckets (``band``, ``key``) that have other pairs.

    ``member``: which of the two met the other as a head. A text is in one bucket of each band, so it is the member of at most 25 pairs.
    """
    rows = nodes.filter(F.col("keys").isNotNull()).select("node", F.posexplode(F.arrays_zip("keys", "orders")).alias("band", "_p"))
    rows = rows.select(F.col("band").cast("int").alias("band"), F.col("_p.keys").alias("key"), F.col("_p.orders").alias("place"), "node")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "band", "key", "place", "node").sortWithinPartitions("band", "key", "place", "node")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 0
        head = None
        heads: list[tuple] = []
        for batch in batches:
            band, key, node = batch["band"].tolist(), batch["key"].tolist(), batch["node"].tolist()
            left, right, large = [], [], []
            for b, k, v in zip(band, key, node, strict=True):
                if head is None or head[0] != b or head[1] != k:
                    if head is None:
                        heads.append((b, k, v))
                    head, size = (b, k, v), 1
                    continue
                size += 1
                if size == 3:  # up to here every pair of the bucket is made
                    large.append((b, k))
                left.append(head[2])
                right.append(v)
            yield pd.DataFrame({"a": left, "b": right, "band": None, "key": None})
            yield pd.DataFrame({"a": None, "b": None, "band": [x[0] for x in large], "key": [x[1] for x in large]})
        if head is not None:  # a bucket may go on in the task before or after: its heads meet below
            heads.append(head)
        yield pd.DataFrame({"a": [h[2] for h in heads], "b": None, "band": [h[0] for h in heads], "key": [h[1] for h in heads]})

    met = stored(rows.mapInPandas(run, "a binary, b binary, band int, key long"), "near-met")
    heads = met.filter(F.col("a").isNotNull() & F.col("b").isNull()).select("band", "key", "a").distinct()
    least = heads.groupBy("band", "key").agg(F.min("a").alias("b"), F.count("*").alias("n")).filter(F.col("n") > 1).drop("n")
    large = met.filter(F.col("a").isNull()).select("band", "key").union(least.select("band", "key")).distinct()
    crossing = heads.join(least, ["band", "key"]).select("a", "b", F.col("a").alias("member"))
    pairs = met.filter(F.col("b").isNotNull()).select("a", "b", F.col("b").alias("member")).unionByName(crossing).filter(F.col("a") != F.col("b"))
    return pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("member").alias("member")), large


def _packed(text: str) -> bytes:
    """Runs and counts of a text for verification: 32 bits of each hash."""
    hashes, counts = runs(text)
    short, place = np.unique((hashes >> _U(32)).astype("<u4"), return_inverse=True)
    total = np.bincount(place, counts, len(short)).astype("<u4") if len(short) else np.zeros(0, "<u4")
    return short.tobytes() + total.tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, dtype="<u4")
    return both[: len(both) // 2], both[len(both) // 2 :]


def packed_runs(docs: DataFrame, nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """``node``, ``runs`` (packed) of the distinct nodes ``needed``."""
    reps = nodes.select("node", F.col("doc_id").alias("_id")).join(needed, "node").select("_id").distinct()
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"), text_of().alias("_text")).join(reps, "_id", "left_semi")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["_id"], batch["_text"]
            yield pd.DataFrame({"node": [node_of(i, t) for i, t in zip(ids, texts, strict=True)], "runs": [_packed(t) for t in texts]})

    # copies of one text under one id: one row per node
    return stored(texts.mapInPandas(pack, "node binary, runs binary").dropDuplicates(["node"]), "near-runs")


def links(docs: DataFrame, nodes: DataFrame, threshold: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Verified pairs of nodes of the linear pass with their ``similarity``, and the buckets that have other pairs."""
    pairs, large = candidates(nodes)
    pairs = stored(pairs, "near-pairs")
    packed = packed_runs(docs, nodes, pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sims = [similarity(_unpacked(x), _unpacked(y)) for x, y in zip(batch.pop("x"), batch.pop("y"), strict=True)]
            batch["similarity"] = np.array(sims, dtype=float)
            yield batch

    both = lookup_join(pairs, packed.select(F.col("node").alias("a"), F.col("runs").alias("x")), ["a"], "inner")
    both = lookup_join(both, packed.select(F.col("node").alias("b"), F.col("runs").alias("y")), ["b"], "inner")
    checked = both.select("a", "b", "member", "x", "y").mapInPandas(verify, "a binary, b binary, member binary, similarity double")
    return stored(checked.filter(F.col("similarity") >= threshold), "near-links"), large


def _products(items: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each pair of texts (places ``first`` by ``second``): the sum over shared runs of the root of the counts' product."""
    sizes = [len(u) for u, _ in items]
    _, column, often = np.unique(np.concatenate([u for u, _ in items]), return_inverse=True, return_counts=True)
    row, root = np.repeat(np.arange(len(items)), sizes), np.sqrt(np.concatenate([c for _, c in items]).astype(np.float32))
    shared = often[column] > 1
    number = np.cumsum(often > 1) - 1
    row, column, root = row[shared], number[column[shared]], root[shared]
    order = np.argsort(column, kind="stable")
    row, column, root = row[order], column[order], root[order]
    out = np.zeros((len(first), len(second)), dtype=np.float32)
    for start in range(0, int(number[-1]) + 1, _COLUMNS):
        low, high = np.searchsorted(column, [start, start + _COLUMNS])
        dense = np.zeros((len(items), _COLUMNS), dtype=np.float32)
        dense[row[low:high], column[low:high] - start] = root[low:high]
        out += dense[first] @ dense[second].T
    return out


def joining(items: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, second: np.ndarray, groups: list, threshold: float) -> list[tuple[int, int]]:
    """Pairs of places (``first`` by ``second``) at the threshold that join groups not joined before; all pairs are looked at."""
    names: dict = {}
    group = np.array([names.setdefault(g, len(names)) for g in groups])
    if len(names) < 2:
        return []
    parent = list(range(len(names)))

    def top(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    total = np.array([c.sum() for _, c in items], dtype=float)
    flat = np.array([(c == 1).all() for _, c in items])
    product = _products(items, first, second).astype(float)
    bound = product / np.sqrt(total[first][:, None] * total[second][None, :])
    # the similarity is at most the sum of the smaller shares, and that at most this cosine (kept in 32 bits, hence the margin)
    x, y = np.nonzero((bound >= threshold - 1e-3) & (group[first][:, None] != group[second][None, :]))
    a, b, bound, product = first[x], second[y], bound[x, y], np.rint(product[x, y])
    plain = flat[a] & flat[b]
    # without repeated runs the product is the number of shared ones
    similar = plain & (product / np.maximum(total[a] + total[b] - product, 1) >= threshold)
    out = []
    for i in [*np.flatnonzero(similar), *(j := np.flatnonzero(~plain))[np.argsort(-bound[j], kind="stable")]]:
        g, h = top(group[a[i]]), top(group[b[i]])
        if g != h and (similar[i] or similarity(items[a[i]], items[b[i]]) >= threshold):
            parent[g] = h
            out.append((int(a[i]), int(b[i])))
    return out


def rest(docs: DataFrame, nodes: DataFrame, large: DataFrame, labels: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """Verified pairs ``a``, ``b`` by which the buckets ``large`` join components; ``labels``: those of the linear pass."""
    bucket = ["band", "key"]
    places = nodes.filter(F.col("keys").isNotNull()).select("node", "size", F.posexplode("keys").alias("band", "key"))
    rows = places.withColumn("band", F.col("band").cast("int")).join(large, bucket, "left_semi")
    rows = lookup_join(rows, labels.select("node", F.col("label.node").alias("comp")), ["node"]).withColumn("comp", F.coalesce("comp", "node"))
    rows = stored(rows.select(*bucket, "node", "size", "comp"), "near-large")
    parts = rows.groupBy(*bucket, "comp").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    whole = parts.groupBy(*bucket).agg(F.count("*").alias("comps"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "size", "comp")).alias("main"))

    def blocks(n, size):
        return F.greatest(F.ceil(n / BLOCK_TEXTS), F.ceil(size / BLOCK_RUNS), F.lit(1)).cast("int")

    main_blocks = blocks(F.col("main.n"), F.col("main.size")).alias("main_blocks")
    other_blocks = blocks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size")).alias("other_blocks")
    split = stored(whole.filter("comps > 1").select(*bucket, F.col("main.comp").alias("main"), main_blocks, other_blocks), "near-open")
    rows = lookup_join(rows, split, bucket, "inner").withColumn("h", F.xxhash64("node"))
    # blocks 0 .. other_blocks - 1: outside the largest component, compared with all blocks from their own on
    outside = F.col("comp") != F.col("main")
    rows = rows.withColumn("block", F.when(outside, F.pmod("h", F.col("other_blocks"))).otherwise(F.col("other_blocks") + F.pmod("h", F.col("main_blocks"))).cast("int"))
    last = F.when(outside, F.col("other_blocks") + F.col("main_blocks")).otherwise(F.col("other_blocks")) - 1
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select(*bucket, F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), (F.col("block") <= F.col("with")).alias("first"), "node", "comp")
    packed = packed_runs(docs, nodes, rows.select("node").distinct())

    def run(group: pd.DataFrame) -> pd.DataFrame:
        items, node = [_unpacked(r) for r in group["runs"]], group["node"].tolist()
        of_first = group["first"].to_numpy(dtype=bool)
        first = np.flatnonzero(of_first)
        second = first if group["i"].iloc[0] == group["j"].iloc[0] else np.flatnonzero(~of_first)
        found = joining(items, first, second, group["comp"].tolist(), threshold) if len(second) else []
        return pd.DataFrame({"a": [node[a] for a, _ in found], "b": [node[b] for _, b in found]})

    rows = lookup_join(rows, packed, ["node"], "inner")
    return stored(rows.groupBy(*bucket, "i", "j").applyInPandas(run, "a binary, b binary"), "near-links")


def starred(edges: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` that join the same texts as the links ``a``, ``b``, ``member``, as a rule far fewer.

    A member (of at most 25 links) keeps the link to the least of its heads, and that head is
    linked with the member's other heads: the members of a large group share theirs, so those
    pairs are few and the group has about one link a text.
    """
    head = F.when(F.col("member") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    heads = edges.groupBy("member").agg(F.sort_array(F.collect_set(head)).alias("heads"))
    to_least = F.transform("heads", lambda h, i: F.struct(F.col("heads")[0].alias("a"), F.when(i == 0, F.col("member")).otherwise(h).alias("b")))
    pairs = heads.select(F.inline(to_least))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node``, ``label``: (smallest id, its node) of the component, for nodes that have a link."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    own = both.select("v").distinct().join(nodes.select(F.col("node").alias("v"), "doc_id"), "v")
    labels = stored(own.select("v", F.struct(F.col("doc_id").alias("id"), F.col("v").alias("node")).alias("label")), "near-labels")
    both = stored(both, "near-both")
    while True:
        sent = lookup_join(both, labels.select(F.col("v").alias("u"), "label"), ["u"], "inner").select("v", "label")
        least = sent.groupBy("v").agg(F.min("label").alias("heard"))
        heard = labels.join(least, "v").select("v", F.col("label").alias("was"), F.least("label", "heard").alias("near"))
        heard = heard.withColumn("at", F.col("near.node"))
        jumped = lookup_join(heard, labels.select(F.col("v").alias("at"), F.col("label").alias("far")), ["at"], "inner")
        new = stored(jumped.select("v", F.least("near", "far").alias("label"), (F.least("near", "far") != F.col("was")).alias("changed")), "near-labels")
        labels = new.select("v", "label")
        if new.filter("changed").isEmpty():
            return labels.select(F.col("v").alias("node"), "label")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``node``, ``class_id``, ``class_node`` for every row."""
    rows = stored(signed(docs), "near-signed")
    nodes = stored(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"), F.first("orders").alias("orders"), F.first("size").alias("size")), "near-nodes")
    edges, large = links(docs, nodes)
    edges = stored(starred(edges), "near-stars")
    labels = components(nodes, edges)
    large = stored(large, "near-buckets")
    if not large.isEmpty():
        more = rest(docs, nodes, large, labels)
        if not more.isEmpty():
            labels = components(nodes, edges.union(more))
    per_node = nodes.select("node", F.col("doc_id").alias("rep")).join(labels, "node", "left")
    per_node = per_node.select("node", F.coalesce("label.id", "rep").alias("class_id"), F.coalesce("label.node", "node").alias("class_node"))
    return lookup_join(rows.select("doc_id", "node"), per_node, ["node"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``kept`` (it stands for its class)."""
    found = classes(docs)
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    kept = (F.col("doc_id") == F.col("class_id")) & (F.col("node") == F.col("class_node"))
    return found.select(known("doc_id"), known("class_id"), kept.alias("kept"))


def keep(docs: DataFrame) -> DataFrame:
    """One document of each class; columns unchanged."""
    key, node, key_, node_ = fresh(docs, "key", "node", "key_kept", "node_kept")
    found = classes(docs)
    first = found.filter((F.col("doc_id") == F.col("class_id")) & (F.col("node") == F.col("class_node"))).select(F.col("doc_id").alias(key_), F.col("node").alias(node_)).distinct()
    first = stored(first, "near-kept")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    words = F.length(F.regexp_replace(text_of(), r"[ \t\n\x0B\f\r]", "")) > 0
    stand_in = F.when(words, text_of()).otherwise(F.concat(F.lit("\0"), id_.cast("string")))
    rows = docs.withColumn(key, id_).withColumn(node, F.unhex(F.md5(stand_in.cast("binary"))))
    rows = rows.join(first, (F.col(key) == F.col(key_)) & (F.col(node) == F.col(node_)), "left_semi")
    return rows.dropDuplicates([key, node]).select(*docs.columns)
