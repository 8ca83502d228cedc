"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes. Where both have a boundary the text falls into groups, and
every token of the one is linked to every token of the other that shares its group. How well a
pair of ids belongs together is told by the number of documents that hold it linked.

* **Encoding.** Spark tasks encode and align whole texts. If no piece of either tokenizer
  reaches over a single blank or line feed between two characters that aren't blank, both have
  a boundary there, so groups never cross it: such words are aligned once per worker and texts
  put together from them. Any other text is aligned in one go.
* **Index.** A task gathers up to ``BLOCK_DOCS`` documents into a block: per pair of ids the
  bitmap of the block's documents that hold it, and planes with the bits of (links - 1). A
  bitmap or plane is a sorted list of 16-bit places, or a bit set where that is smaller. A block
  is a container of the whole bitmaps: places of different blocks never meet, so a pair's whole
  bitmap is the union of its containers and its popcount the sum of theirs.
* **Counts and scores.** Popcounts are added up per pair (pre-aggregated in each task) and each
  block gets back the counts of its own pairs by a join on the pair; its postings, with the
  multiplicities that the planes spell, return a score to every document.

Nothing is gathered whole: a block is bounded in documents and postings, a join key (pair)
occurs once per block, and only the best count per id of the first tokenizer is broadcast, when
it is counted to be within its vocabulary. Null and empty texts, and texts that either tokenizer
doesn't give back byte by byte, have no tokens. Rows are documents: rows that repeat an id or a
text each count and each get a row. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectflow.llm.common import kept_by_worker, stored, whole_texts
from subjectflow.operators.joins import lookup_join

#: Documents of a block, raw postings after which a block is closed, words a worker remembers.
BLOCK_DOCS, BLOCK_POSTINGS, WORDS_KEPT = 4096, 2_000_000, 400_000
#: Distinct pairs that a task adds up before it hands them on.
PAIRS_HELD = 2_000_000
#: Characters above which a word isn't remembered (a group of it might have very many links): its text is aligned in one go.
LONG_WORD = 200
#: Rows of the table of best counts that may be broadcast: far above any vocabulary.
BROADCAST_IDS = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write the 256 bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Aligned words and texts of two tokenizers: a byte-level BPE file (A) and a sentencepiece model (B)."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(definition), SentencePieceProcessor()
        self.a.encode_special_tokens = True  # their strings in a text are text
        self.b.LoadFromSerializedProto(model)
        letters = byte_letters()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values(), default=-1) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.blank = next((i for i, p in enumerate(pieces) if p == "▁"), None)
        parsed = json.loads(definition)
        before = parsed.get("pre_tokenizer") or {}
        self.by_word = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not parsed.get("normalizer") and not any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        )
        self.a_names, self.b_names = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(self.b_bytes))]
        self.a_sizes, self.b_sizes = np.array([len(x) for x in self.a_bytes]), np.array([len(x) for x in self.b_bytes])
        # ids with what may follow them: A "," "|", B "," ";" and nothing
        self.marked = [f"{n}{c}" for names, marks in ((self.a_names, ",|"), (self.b_names, (",", ";", ""))) for c in marks for n in names]
        self.pair_numbers: dict[int, int] = {}
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words (pairs keep their numbers)."""
        self.numbers: dict[str, int] = {}
        self.texts: list[str] = []
        self.sizes = [array("q") for _ in range(4)]  # by word: tokens of A, of B, groups, links
        self.first, self.pairs = array("q", [0]), array("q")  # by word: its links, as pair numbers
        self.bad: set[str] = set()  # words that a tokenizer doesn't give back

    def align(self, a: list[int], b: list[int], data: bytes) -> tuple[int, int, str, Counter] | None:
        """(groups, links, groups as text, links by pair of ids) of one text, or None if the tokens' bytes aren't ``data``."""
        if b"".join([self.a_bytes[i] for i in a]) != data or b"".join([self.b_bytes[i] for i in b]) != data:
            return None
        size_a, size_b = [len(self.a_bytes[i]) for i in a], [len(self.b_bytes[i]) for i in b]
        groups, linked, links, i, j = [], Counter(), 0, 0, 0
        while i < len(a):
            from_i, from_j, x, y = i, j, size_a[i], size_b[j]
            i, j = i + 1, j + 1
            while x != y:
                if x < y:
                    x, i = x + size_a[i], i + 1
                else:
                    y, j = y + size_b[j], j + 1
            in_a, in_b = a[from_i:i], b[from_j:j]
            groups.append(",".join([self.a_names[t] for t in in_a]) + "|" + ",".join([self.b_names[t] for t in in_b]))
            links += len(in_a) * len(in_b)
            if len(in_a) == 1 == len(in_b):
                linked[in_a[0] << 32 | in_b[0]] += 1
                continue
            many = Counter(in_b).items()
            for t, n in Counter(in_a).items():
                for u, m in many:
                    linked[t << 32 | u] += n * m
        return len(groups), links, ";".join(groups), linked

    def _pair(self, key: int) -> int:
        return self.pair_numbers.setdefault(key, len(self.pair_numbers))

    def learn(self, cuts: list[list[str]]) -> set[str]:
        """Align the words that aren't known; return those that don't stand between clean blanks or are too long."""
        odd, new = set(), []
        for word in set().union(*cuts).difference(self.numbers, self.bad):
            body = word[1:] if word[:1] == "\n" else word
            if not body or body[0].isspace() or body[-1].isspace() or len(word) > LONG_WORD:
                odd.add(word)
            else:
                new.append(word)
        found_a = self.a.encode_batch_fast([w if w[0] == "\n" else " " + w for w in new], add_special_tokens=False)
        words, a_ids, b_ids = [], [], []
        for word, a, b in zip(new, found_a, self.b.encode(new, num_threads=1), strict=True):
            if word[0] == "\n":  # the model put a blank before it
                if b[:1] != [self.blank]:
                    odd.add(word)
                    continue
                b = b[1:]
            words.append(word)
            a_ids.append(a.ids)
            b_ids.append(b)
        self._remember(words, a_ids, b_ids)
        return odd

    def _remember(self, words: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> None:
        """Align many words at once: one after another they are one run of bytes that both sides cut."""
        data = [(w if w[0] == "\n" else " " + w).encode() for w in words]
        if not data:
            return
        n_a, n_b = (np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(n.sum())) for ids, n in ((a_ids, n_a), (b_ids, n_b)))
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        whole, ends = b"".join(data), np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))
        last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
        given_back = (
            n_a.all() and n_b.all() and np.array_equal(end_a[last_a], ends) and np.array_equal(end_b[last_b], ends)
            and b"".join([self.a_bytes[i] for i in a.tolist()]) == whole and b"".join([self.b_bytes[i] for i in b.tolist()]) == whole
        )
        if not given_back:
            good = []
            for i, expected in enumerate(data):
                same = all(b"".join([table[t] for t in ids[i]]) == expected for table, ids in ((self.a_bytes, a_ids), (self.b_bytes, b_ids)))
                good += [i] if same else []
                self.bad.update([] if same else [words[i]])
            return self._remember([words[i] for i in good], [a_ids[i] for i in good], [b_ids[i] for i in good])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
        word = np.repeat(np.arange(len(words)), n_a)
        of_group = word[upto_a - 1]
        links = np.bincount(of_group, weights=in_a * in_b, minlength=len(words)).astype(np.int64)
        wide = in_b[group_a]  # every token of A meets all of B in its group
        partner = np.repeat((upto_b - in_b)[group_a] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
        keys, inverse = np.unique(np.repeat(a, wide) << 32 | b[partner], return_inverse=True)
        numbers = np.array([self._pair(k) for k in keys.tolist()], dtype=np.int64)[inverse]
        marked = np.empty(len(a) + len(b), dtype=np.int64)
        closes_a, closes_b = np.arange(len(a)) == upto_a[group_a] - 1, (np.arange(len(b)) == upto_b[group_b] - 1).astype(np.int64)
        closes_b[last_b] = 2
        marked[np.arange(len(a)) + (upto_b - in_b)[group_a]] = a + closes_a * len(self.a_names)
        marked[np.arange(len(b)) + upto_a[group_b]] = b + closes_b * len(self.b_names) + 2 * len(self.a_names)
        pieces, edges = [self.marked[i] for i in marked.tolist()], [0, *np.cumsum(n_a + n_b).tolist()]
        self.numbers.update(zip(words, range(len(self.texts), len(self.texts) + len(words)), strict=True))
        self.texts += ["".join(pieces[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
        for kept, n in zip(self.sizes, (n_a, n_b, np.bincount(of_group, minlength=len(words)), links), strict=True):
            kept.frombytes(n.astype(np.int64).tobytes())
        self.first.frombytes((np.cumsum(links) + self.first[-1]).tobytes())
        self.pairs.frombytes(numbers.tobytes())

    def documents(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """((n_a, n_b, n_groups, n_links, sha256) of each text; postings as place, pair number, links)."""
        if len(self.numbers) + len(self.bad) > WORDS_KEPT:
            self.forget()
        cuts = [t.replace("\n", " \n").split(" ") if t and self.by_word else [] for t in texts]
        odd = self.learn(cuts)
        sizes = [np.array(kept, dtype=np.int64) for kept in self.sizes]
        rows, places, numbers, whole = [], [], [], []
        for place, (text, words) in enumerate(zip(texts, cuts, strict=True)):
            row = (0, 0, 0, 0, "")
            if words and odd.isdisjoint(words):
                if self.bad.isdisjoint(words):
                    mine = [self.numbers[w] for w in words]
                    at = np.array(mine)
                    digest = hashlib.sha256(";".join([self.texts[i] for i in mine]).encode()).hexdigest()
                    row = (*[int(kept[at].sum()) for kept in sizes], digest)
                    numbers.append(at)
                    places.append(np.full(len(at), place))
            elif text:
                a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text, num_threads=1)
                got = self.align(a, b, (" " + text).encode())
                if got:
                    n_groups, n_links, groups, linked = got
                    row = (len(a), len(b), n_groups, n_links, hashlib.sha256(groups.encode()).hexdigest())
                    whole += [(place, self._pair(k), n) for k, n in linked.items()]
            rows.append(row)
        postings = [np.array(whole, dtype=np.int64).reshape(-1, 3).T]
        if numbers:
            known = len(self.texts)
            keys, times = np.unique(np.concatenate(places) * known + np.concatenate(numbers), return_counts=True)
            at, word = np.divmod(keys, known)
            first = np.array(self.first, dtype=np.int64)
            wide = first[word + 1] - first[word]
            index = np.repeat(first[word] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
            postings.append(np.stack([np.repeat(at, wide), np.array(self.pairs, dtype=np.int64)[index], np.repeat(times, wide)]))
        place, pair, links = np.concatenate(postings, axis=1)
        return rows, place, pair, links


# ---- bitmaps of one block ------------------------------------------------------------------

_DENSE = 0xFFFF


def pack(pair: np.ndarray, place: np.ndarray, pairs: int, places: int = BLOCK_DOCS) -> tuple[bytes, bytes, bytes]:
    """Bitmaps of ``pairs`` pairs: (16-bit counts, sorted 16-bit places of the sparse, bit sets of the dense).

    ``pair``, ``place`` ascend. A pair with more places than a bit set has 16-bit cells is dense.
    """
    counts = np.bincount(pair, minlength=pairs)
    dense = counts > places // 16
    on = dense[pair]
    bits = np.zeros((int(dense.sum()), places), dtype=bool)
    bits[(np.cumsum(dense) - 1)[pair[on]], place[on]] = True
    return np.where(dense, _DENSE, counts).astype("<u2").tobytes(), place[~on].astype("<u2").tobytes(), np.packbits(bits, axis=1).tobytes()


def popcounts(packed: tuple[bytes, bytes, bytes], places: int = BLOCK_DOCS) -> np.ndarray:
    """Documents of each pair."""
    counts = np.frombuffer(packed[0], dtype="<u2").astype(np.int64)
    sets = np.frombuffer(packed[2], dtype=np.uint8).reshape(-1, places // 8)
    counts[counts == _DENSE] = np.bitwise_count(sets).sum(axis=1, dtype=np.int64)
    return counts


def unpack(packed: tuple[bytes, bytes, bytes], places: int = BLOCK_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """(pair, place) of every set bit; sparse pairs first."""
    counts = np.frombuffer(packed[0], dtype="<u2").astype(np.int64)
    dense = np.flatnonzero(counts == _DENSE)
    counts[dense] = 0
    sets = np.unpackbits(np.frombuffer(packed[2], dtype=np.uint8).reshape(-1, places // 8), axis=1)
    row, place = np.nonzero(sets)
    sparse = np.frombuffer(packed[1], dtype="<u2").astype(np.int64)
    return np.concatenate([np.repeat(np.arange(len(counts)), counts), dense[row]]), np.concatenate([sparse, place])


def bitmaps(place: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, list[tuple[bytes, bytes, bytes]]]:
    """(pair numbers of a block; the document bitmap of each, then planes of its links - 1)."""
    keys, inverse = np.unique(pair * BLOCK_DOCS + place, return_inverse=True)
    total = np.zeros(len(keys), dtype=np.int64)
    np.add.at(total, inverse, links)
    pair, place = np.divmod(keys, BLOCK_DOCS)
    known, rank = np.unique(pair, return_inverse=True)
    planes, rest = [pack(rank, place, len(known))], total - 1
    while rest.any():
        on = (rest & 1).astype(bool)
        planes.append(pack(rank[on], place[on], len(known)))
        rest = rest >> 1
    return known, planes


_BLOCK = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "pairs binary, counts array<binary>, sparse array<binary>, dense array<binary>"
)
_ROWS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def index(docs: DataFrame, tokenizer_path: str, model_path: str) -> DataFrame:
    """The blocks: documents with what they hold, and the bitmaps of their pairs."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as one, open(model_path, "rb") as two:  # vocabularies have a fixed size
        files = spark.sparkContext.broadcast((one.read(), two.read()))
    key = ("align", tokenizer_path, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        aligner = kept_by_worker(key, lambda: Aligner(*files.value))
        block, ids, rows, held, postings = TaskContext.get().partitionId() << 32, [], [], [], 0

        def closed() -> pd.DataFrame:
            known, planes = bitmaps(*np.concatenate(held, axis=1))
            keys = np.fromiter(aligner.pair_numbers, dtype=np.int64, count=len(aligner.pair_numbers))
            columns = [list(c) for c in zip(*rows, strict=True)]
            return pd.DataFrame([(block, ids, *columns, keys[known].tobytes(), *[list(c) for c in zip(*planes, strict=True)])],
                                columns=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            texts, keys, at = batch["_text"].tolist(), [None if pd.isna(i) else int(i) for i in batch["doc_id"].astype(object)], 0
            while at < len(texts):
                some = min(256, BLOCK_DOCS - len(ids))
                found, place, pair, links = aligner.documents([t or "" for t in texts[at : at + some]])
                held.append(np.stack([place + len(ids), pair, links]))
                ids += keys[at : at + some]
                rows += found
                postings, at = postings + len(place), at + some
                if len(ids) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield closed()
                    block, ids, rows, held, postings = block + 1, [], [], [], 0
                    if len(aligner.pair_numbers) > PAIRS_HELD:
                        aligner.pair_numbers.clear()
                        aligner.forget()
        if ids:
            yield closed()

    # ids as text: a null among longs would turn them into floats on the way
    texts = whole_texts(docs, F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    return stored(texts.mapInPandas(run, _BLOCK), "align-index")


def _planes(row) -> list[tuple[bytes, bytes, bytes]]:
    return list(zip(row.counts, row.sparse, row.dense, strict=True))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair`` (A id << 32 | B id), ``docs``: popcount of each pair's bitmap over all blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = popcounts((row.counts, b"", row.dense))
                keys, inverse = np.unique(np.concatenate([keys, np.frombuffer(row.pairs, dtype=np.int64)]), return_inverse=True)
                total = np.zeros(len(keys), dtype=np.int64)
                np.add.at(total, inverse, np.concatenate([counts, found]))
                counts = total
                if len(keys) > PAIRS_HELD:
                    yield pd.DataFrame({"pair": keys, "docs": counts})
                    keys, counts = keys[:0], counts[:0]
        yield pd.DataFrame({"pair": keys, "docs": counts})

    documents = blocks.select("pairs", F.col("counts")[0].alias("counts"), F.col("dense")[0].alias("dense"))
    return documents.mapInPandas(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def _with_best(counts: DataFrame) -> DataFrame:
    """``pair``, ``docs``, ``best``: whether no pair of the same A id is held by more documents."""
    first = F.shiftright("pair", 32)
    top = counts.groupBy(first.alias("_a")).agg(F.max("docs").alias("_top"))
    if top.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        top = F.broadcast(top)
    return counts.join(top, first == F.col("_a")).select("pair", "docs", (F.col("docs") == F.col("_top")).alias("best"))


def scores(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document of the index: what it holds, ``n_best`` and ``count_sum`` by its postings."""
    spark: SparkSession = blocks.sparkSession

    def keys_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame({"block": row.block, "pair": np.frombuffer(row.pairs, dtype=np.int64)})

    asked = blocks.select("block", "pairs").mapInPandas(keys_of, "block long, pair long")
    told = lookup_join(asked, _with_best(stored(counts, "align-counts")), ["pair"], "inner").select(F.col("block").alias("to"), "pair", "docs", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def scored(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        row = next(block.itertuples(index=False))
        known = known.sort_values("pair")
        at = np.searchsorted(known["pair"].to_numpy(), np.frombuffer(row.pairs, dtype=np.int64))
        docs, best = known["docs"].to_numpy()[at], known["best"].to_numpy(dtype=np.int64)[at]
        n = len(row.doc_ids)
        count_sum, n_best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for plane, packed in enumerate(_planes(row)):
            pair, place = unpack(packed)
            times = 1 << max(0, plane - 1)  # the bitmap stands for one link, plane i for 2^(i-1) more
            np.add.at(count_sum, place, docs[pair] * times)
            np.add.at(n_best, place, best[pair] * times)
        ids = pd.array([None if pd.isna(i) else int(i) for i in row.doc_ids], dtype="Int64")
        columns = {name: list(getattr(row, name)) for name in _ROWS}
        return pd.DataFrame({"doc_id": ids, **columns, "n_best": n_best, "count_sum": count_sum})

    ids = F.transform("doc_ids", lambda i: i.cast("string"))
    return blocks.withColumn("doc_ids", ids).groupBy("block").cogroup(told.groupBy("to")).applyInPandas(scored, schema)


def report(docs: DataFrame, tokenizer_path: str, model_path: str) -> DataFrame:
    """Per document its tokens, groups and links, and the scores of its links over the whole corpus."""
    blocks = index(docs, tokenizer_path, model_path)
    return scores(blocks, pair_counts(blocks))
