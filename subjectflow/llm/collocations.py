"""Phrase collocation mining with mergeable Misra-Gries summaries.

A phrase of ``MIN_WORDS`` to ``MAX_WORDS`` words is a candidate if it occurs ``THRESHOLD`` times
in its language. Counting all phrases to find the few frequent ones would shuffle the text of
every one of them, so there are two passes over the texts:

* **First pass.** Words and phrases are dealt out over hash partitions as 32-bit keys (a part of
  a 64-bit hash of language and words). Tasks add up what they meet in a packed form and hand
  on, per partition, keys with counts: summaries that have dropped nothing. Their masses are
  known once they are written, and each partition merges its own into one Misra-Gries summary
  with a capacity above mass / threshold: whenever it holds more keys than that, the count of the
  first that doesn't fit is taken off all and those at zero go. What has been taken off is below
  the threshold, so every frequent key is left with a count that, with what was taken off,
  reaches the threshold. Keys that share a hash only add survivors.
* **Second pass.** The survivors become a Bloom filter of bounded size (``FILTER_BITS``). Tasks
  count exactly, by words, what passes it; counts are added up by language and phrase, and what
  stays below the threshold goes. A filter that fills up lets more through, nothing less.

Scores, containment and ranks are joins and a rank limit over the counted candidates. Products
are decimals of 38 digits, exact for counts up to 10^14. A frequent word is one key of each task
and a language is no key of any shuffle but the last, whose rank limit comes first; partitions
follow the size of the input. Null texts are empty, a null language is ``und``; repeated rows
count each; an empty table gives no phrases.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.llm.common import kept_by_worker, small_join, stored, text_of, whole_texts
from subjectflow.operators.joins import lookup_join

MIN_WORDS, MAX_WORDS, THRESHOLD, SHARE, TOP = 2, 3, 10, 50, 2000
#: Characters of text per hash partition; entries of a row; bits of the filter, at most, and per survivor.
PART_CHARS, ROW_ENTRIES, FILTER_BITS, BITS_PER_KEY = 1 << 24, 1 << 13, 1 << 27, 16
#: Occurrences that a task gathers before it adds them up, distinct ones and words that it holds.
RAW, HELD, WORDS_HELD = 1 << 20, 1 << 20, 400_000
#: Bytes of text taken apart at once; bytes of a slice of the filter; partitions up to which masses are broadcast; shares of a language.
SEGMENT, SLICE, BROADCAST_PARTS, SALTS = 1 << 20, 1 << 17, 100_000, 32

#: A-Z to a-z; everything that ends a piece to a point.
_LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b",;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)
_U = np.uint64
_BITS = 21  # of a word's number in a packed phrase


def stirred(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads them."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Words(dict):
    """Numbers of words, from 1 (0 ends a piece), with the words and their hashes."""

    def __init__(self):
        super().__init__({b".": 0})
        self.names, self.hashes = [b""], array("Q", [0])

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def segments(text: str) -> Iterator[tuple[list[bytes], int]]:
    """(words and points, how many of them the segment before had already) of a whole text."""
    data, at, before = text.encode("utf-8", "replace").translate(_LETTERS), 0, []
    while at < len(data):
        end = data.find(b" ", at + SEGMENT)
        end = len(data) if end < 0 else end
        words = before + data[at:end].replace(b".", b" . ").split()
        yield words, len(before)
        at, before = end, words[-MAX_WORDS + 1 :]


class Grams:
    """Words and phrases of a task, by language, packed into 64 bits and added up."""

    def __init__(self):
        self.words = _Words()
        self.raw: dict[str, list[np.ndarray]] = defaultdict(list)
        self.held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.waiting, self.mass = 0, defaultdict(int)

    def packed(self, lang: str, words: list[bytes], known: int) -> np.ndarray:
        """Every word and phrase that ends behind the first ``known`` words; the words are added to the ``mass``."""
        at = np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))
        parts = []
        for n in range(1, MAX_WORDS + 1):
            first = max(0, known - n + 1)
            own = [at[first + i : len(at) - n + 1 + i] for i in range(n)]
            if not len(own[0]):
                break
            inside = own[0] > 0
            keys = own[0] << 2 * _BITS
            for i in range(1, n):
                inside &= own[i] > 0
                keys = keys | own[i] << (2 - i) * _BITS
            parts.append(keys[inside])
        self.mass[lang] += len(parts[0]) if parts else 0
        return np.concatenate(parts) if parts else at[:0]

    def hashes(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """64 bits of language and words."""
        of_word, mask = np.array(self.words.hashes, dtype=_U), (1 << _BITS) - 1
        h = np.full(len(keys), xxhash.xxh3_64_intdigest(lang), dtype=_U)
        for shift in (2 * _BITS, _BITS, 0):
            h = stirred(h + of_word[keys >> shift & mask])
        return h

    def add(self, lang: str, keys: np.ndarray) -> None:
        self.raw[lang].append(keys)
        self.waiting += len(keys)

    def add_up(self) -> None:
        """Bring what was gathered together with what is held."""
        for lang, waiting in self.raw.items():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            if lang in self.held:
                both, inverse = np.unique(np.concatenate([self.held[lang][0], keys]), return_inverse=True)
                total = np.zeros(len(both), dtype=np.int64)
                np.add.at(total, inverse, np.concatenate([self.held[lang][1], counts]))
                keys, counts = both, total
            self.held[lang] = keys, counts
        self.raw.clear()
        self.waiting = 0

    def full(self) -> bool:
        return len(self.words) > WORDS_HELD or sum(len(k) for k, _ in self.held.values()) > HELD

    def clear(self) -> None:
        self.held.clear()
        if len(self.words) > WORDS_HELD:
            self.words = _Words()

    def phrase(self, key: int) -> tuple[int, str]:
        """(number of words, words joined by blanks)."""
        mask = (1 << _BITS) - 1
        words = [self.words.names[i] for i in (key >> 2 * _BITS, key >> _BITS & mask, key & mask) if i]
        return len(words), b" ".join(words).decode()


class Summary:
    """Misra-Gries summary of weighted keys: counts are too small by ``taken`` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self._waiting, self._n = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._n += len(keys)
        if self._n > max(self.capacity, ROW_ENTRIES):
            self.settle()

    def merge(self, other: Summary) -> None:
        """Take in a summary of other rows; what was taken off there may be lacking here too."""
        other.settle()
        self.add(other.keys, other.counts)
        self.taken += other.taken

    def settle(self) -> None:
        """Add up what waits; if there are too many keys, take off all what the first that doesn't fit has."""
        keys = np.concatenate([self.keys, *[k for k, _ in self._waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self._waiting]])
        self._waiting, self._n = [], 0
        self.keys, inverse = np.unique(keys, return_inverse=True)
        self.counts = np.zeros(len(self.keys), dtype=np.int64)
        np.add.at(self.counts, inverse, counts)
        if len(self.keys) > self.capacity:
            off = np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1]
            left = self.counts > off
            self.keys, self.counts, self.taken = self.keys[left], self.counts[left] - off, self.taken + int(off)

    def reaching(self, threshold: int) -> np.ndarray:
        """All keys that may have ``threshold`` occurrences."""
        self.settle()
        return self.keys[self.counts + self.taken >= threshold]


def capacity(mass: int, threshold: int) -> int:
    """Keys that a summary needs so that less than the threshold is ever taken off."""
    return mass // threshold + 1


def _texts(docs: DataFrame) -> DataFrame:
    return whole_texts(docs, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("_lang"), text_of().alias("_text"))


def _gathered(grams: Grams, batches: Iterator[pd.DataFrame], chosen=None) -> Iterator[None]:
    """Feed all texts; stop whenever ``grams`` has to be emptied, and at the end."""
    for batch in batches:
        for lang, text in zip(batch["_lang"], batch["_text"], strict=True):
            for words, known in segments(text):
                keys = grams.packed(lang, words, known)
                grams.add(lang, keys if chosen is None else keys[chosen(grams.hashes(lang, keys))])
                if grams.waiting > RAW or len(grams.words) > WORDS_HELD:
                    grams.add_up()
                    if chosen is None or grams.full():
                        yield
                        grams.clear()
    grams.add_up()
    yield


def _in_parts(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(partition, 32-bit key) of 64-bit hashes."""
    return ((h >> _U(32)) % _U(parts)).astype(np.int64), (h & _U(0xFFFFFFFF)).astype(np.uint32)


def summaries(docs: DataFrame, parts: int) -> DataFrame:
    """First pass: ``part``, ``keys``, ``counts``, ``mass``; what tasks have added up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("collocations",))
        grams = Grams()
        for _ in _gathered(grams, batches):
            if not grams.held:
                continue
            h = np.concatenate([grams.hashes(lang, keys) for lang, (keys, _) in grams.held.items()])
            counts = np.concatenate([c for _, c in grams.held.values()]).astype("<u4")
            part, key = _in_parts(h, parts)
            order = np.lexsort((key, part))
            part, key, counts = part[order], key[order], counts[order]
            edges = np.searchsorted(part, np.arange(parts + 1)).tolist()
            for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                for at in range(a, b, ROW_ENTRIES):
                    own = slice(at, min(b, at + ROW_ENTRIES))
                    yield pd.DataFrame([(p, key[own].tobytes(), counts[own].tobytes(), int(counts[own].sum(dtype=np.int64)))], columns=["part", "keys", "counts", "mass"])

    return stored(_texts(docs).mapInPandas(run, "part int, keys binary, counts binary, mass long"), "collocations-summaries")


def survivors(rows: DataFrame, parts: int, threshold: int = THRESHOLD) -> DataFrame:
    """``part``, ``keys``, ``n``: keys that may be frequent, by one Misra-Gries summary of each partition."""
    masses = rows.groupBy("part").agg(F.sum("mass").alias("whole"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("collocations",))
        part, summary = None, None

        def told() -> Iterator[pd.DataFrame]:
            keys = summary.reaching(threshold)
            for at in range(0, len(keys), ROW_ENTRIES):
                own = keys[at : at + ROW_ENTRIES]
                yield pd.DataFrame([(part, own.tobytes(), len(own))], columns=["part", "keys", "n"])

        for batch in batches:  # a partition's rows come one after another
            for row in batch.itertuples(index=False):
                if row.part != part:
                    if summary:
                        yield from told()
                    part, summary = row.part, Summary(capacity(int(row.whole), threshold))
                summary.add(np.frombuffer(row.keys, dtype="<u4"), np.frombuffer(row.counts, dtype="<u4").astype(np.int64))
        if summary:
            yield from told()

    dealt = small_join(rows.drop("mass"), masses, ["part"], BROADCAST_PARTS).repartition(4 * parts, "part").sortWithinPartitions("part")
    return stored(dealt.mapInPandas(run, "part int, keys binary, n long"), "collocations-survivors")


def _places(part: np.ndarray, key: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of each key in a filter (``bits``: a power of two)."""
    h = stirred(part.astype(_U) << _U(32) | key.astype(_U))
    return [(h & _U(bits - 1)).astype(np.int64), (h >> _U(32) & _U(bits - 1)).astype(np.int64)]


def bloom(found: DataFrame) -> np.ndarray:
    """The filter, as bytes; tasks set bits and slices of them are merged by OR."""
    n = found.agg(F.sum("n")).first()[0] or 0
    bits = 1 << 16
    while bits < min(FILTER_BITS, n * BITS_PER_KEY):
        bits *= 2
    width = min(SLICE, bits // 8)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            for part, keys in zip(batch["part"], batch["keys"], strict=True):
                key = np.frombuffer(keys, dtype="<u4")
                for place in _places(np.full(len(key), part), key, bits):
                    np.bitwise_or.at(table, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
        for i, own in enumerate(table.reshape(-1, width)):
            if own.any():
                yield pd.DataFrame([(i, own.tobytes())], columns=["slice", "bits"])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, own in zip(batch["slice"], batch["bits"], strict=True):
                slices.setdefault(i, np.zeros(width, dtype=np.uint8))
                slices[i] |= np.frombuffer(own, dtype=np.uint8)
        yield pd.DataFrame([(i, x.tobytes()) for i, x in slices.items()], columns=["slice", "bits"])

    rows = found.select("part", "keys").mapInPandas(run, "slice int, bits binary").repartition("slice").mapInPandas(merge, "slice int, bits binary")
    table = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows.collect():  # FILTER_BITS / 8 bytes at most
        table.reshape(-1, width)[row["slice"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return table


def counted(docs: DataFrame, table: np.ndarray, parts: int, threshold: int = THRESHOLD) -> DataFrame:
    """Second pass: ``lang``, ``words`` (0: all words of the language), ``phrase``, ``f`` of everything frequent, exactly."""
    sent = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("collocations",))
        bits, grams = np.frombuffer(sent.value, dtype=np.uint8), Grams()

        def chosen(h: np.ndarray) -> np.ndarray:
            one, two = _places(*_in_parts(h, parts), len(bits) * 8)
            return ((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1).astype(bool)

        for _ in _gathered(grams, batches, chosen):
            for lang, (keys, counts) in grams.held.items():
                for at in range(0, len(keys), ROW_ENTRIES):
                    rows = [(lang, *grams.phrase(k)) for k in keys[at : at + ROW_ENTRIES].tolist()]
                    yield pd.DataFrame(rows, columns=["lang", "words", "phrase"]).assign(f=counts[at : at + ROW_ENTRIES])
        yield pd.DataFrame([(lang, 0, "", n) for lang, n in grams.mass.items()], columns=["lang", "words", "phrase", "f"])

    rows = _texts(docs).mapInPandas(run, "lang string, words int, phrase string, f long")
    sums = rows.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return stored(sums.filter((F.col("f") >= threshold) | (F.col("words") == 0)), "collocations-counts")


def _joined(words: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def _scored(counts: DataFrame) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``a``, ``l``, ``r``, ``score``: every candidate by its lowest cut."""
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = counts.filter(F.col("words") >= MIN_WORDS).select("lang", "words", "phrase", F.col("f").alias("a"), cut.alias("k"))
    cuts = cuts.withColumn("left", _joined(words, 1, F.col("k"))).withColumn("right", _joined(words, F.col("k") + 1, F.col("words") - F.col("k")))
    known = counts.filter((F.col("words") > 0) & (F.col("words") < MAX_WORDS))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = lookup_join(cuts, known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side], "inner")
    exact = cuts.withColumn("_aa", F.lit(1_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(14,0)") * F.col("a").cast("decimal(14,0)"))
    exact = exact.withColumn("score", F.expr("_aa div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
    lowest = exact.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_m"))
    return lowest.select("lang", "words", "phrase", "a", "_m.l", "_m.r", "_m.score")


def _covered(counts: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``most``: the most frequent longer candidate that holds a phrase (none holds the longest)."""
    words = F.split("phrase", " ")
    parts = None
    for n in range(MIN_WORDS, MAX_WORDS):
        longer = counts.filter(F.col("words") > n)
        starts = longer.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(1), F.col("words") - n + 1)).alias("i"))
        part = starts.select("lang", _joined(words, F.col("i"), n).alias("phrase"), "f")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def mine(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's first ``top`` phrases."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-int(chars) // PART_CHARS))
    counts = counted(docs, bloom(survivors(summaries(docs, parts), parts)), parts)
    scored = lookup_join(_scored(counts), _covered(counts), ["lang", "phrase"])
    scored = scored.filter(~F.coalesce(100 * F.col("most") >= SHARE * F.col("a"), F.lit(False)))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # first within shares of a language, so that no more than SALTS * top rows of it ever meet
    share = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order))
    first = scored.withColumn("rank", share).filter(F.col("rank") <= top).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    whole = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return lookup_join(ranked, whole, ["lang"], "inner").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same report in DuckDB's SQL.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT rid, lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]'), 1) AS pno FROM d),
w AS (SELECT rid, lang, pno, unnest(regexp_extract_all(piece, '[^\\x20\\x09]+')) AS x, generate_subscripts(regexp_extract_all(piece, '[^\\x20\\x09]+'), 1) AS pos FROM p),
t AS (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM w WINDOW o AS (PARTITION BY rid, pno ORDER BY pos)),
f1 AS (SELECT lang, x, count(*) AS f FROM t GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM t WHERE y IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM t WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
c AS (SELECT f2.lang, f2.x, f2.y, NULL AS z, f2.f AS a, 1 AS k, i.f AS l, j.f AS r FROM f2 JOIN f1 i ON i.lang = f2.lang AND i.x = f2.x JOIN f1 j ON j.lang = f2.lang AND j.x = f2.y WHERE f2.f >= {THRESHOLD}
  UNION ALL SELECT f3.lang, f3.x, f3.y, f3.z, f3.f, 1, i.f, j.f FROM f3 JOIN f1 i ON i.lang = f3.lang AND i.x = f3.x JOIN f2 j ON j.lang = f3.lang AND j.x = f3.y AND j.y = f3.z
  UNION ALL SELECT f3.lang, f3.x, f3.y, f3.z, f3.f, 2, i.f, j.f FROM f3 JOIN f2 i ON i.lang = f3.lang AND i.x = f3.x AND i.y = f3.y JOIN f1 j ON j.lang = f3.lang AND j.x = f3.z),
s AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM c
  QUALIFY row_number() OVER (PARTITION BY lang, x, y, z ORDER BY 1000000::HUGEINT * a * a // (l::HUGEINT * r), k) = 1),
h AS (SELECT lang, x, y, max(f) AS most FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
e AS (SELECT s.lang, concat_ws(' ', s.x, s.y, s.z) AS phrase, a, l, r, score FROM s LEFT JOIN h ON s.z IS NULL AND h.lang = s.lang AND h.x = s.x AND h.y = s.y
  WHERE most IS NULL OR 100 * most < {SHARE} * a),
k AS (SELECT e.*, n.n, row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM e JOIN n USING (lang))
SELECT lang, rank, phrase, a, l, r, n, score FROM k WHERE rank <= {TOP}
"""
