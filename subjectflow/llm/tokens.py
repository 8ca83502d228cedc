"""Token ids as shards of raw binary payload, with a minimal perfect hash index by document.

**Format** (a folder with two Parquet tables, so that any file system Spark knows will do):

* ``shards``: consecutive documents in ascending id order. ``part``, ``seq`` order the
  shards; ``payload`` is nothing but their ids, little-endian, 16 bits each if the
  vocabulary allows, else 32; ``doc_ids`` and ``lengths`` list the documents.
* ``index``: keys (id, occurrence) are dealt out over buckets by hash. A bucket has a minimal
  perfect hash of its keys: bit arrays by level, where a key that is alone in its place at a
  level is settled there and the others go on to the next. The number of set bits before a
  key's bit is its slot, and the slot holds a 32-bit fingerprint of the key, the shard, the
  offset in ids and the length. A lookup is a few hashes and one slot, whatever the size; a
  key that was never stored is refused by its fingerprint (but for one in 2^32).

Null ids sort first and are found as null; rows that repeat an id are its occurrences 0, 1,
2 ...; null texts have the end id only. An empty table makes an empty store.
"""

from __future__ import annotations

import json
import os
import re
import string
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subjectflow.llm.align import byte_letters
from subjectflow.llm.common import kept_by_worker, text_of, whole_texts
from subjectflow.llm.neardup import mixed

#: Ids of a shard and keys of an index bucket, about; words whose ids a worker remembers (twice).
SHARD_IDS = 1_000_000
BUCKET_KEYS = 16_384
WORDS_KEPT = 400_000
#: Bytes of text that are cut into words at once, about.
TEXT_BYTES = 8_000_000
NO_ID = -(1 << 63)

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


#: A single blank, or the place before a single line feed, between characters that aren't blank.
_CLEAN = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")


class TextEncoder:
    """Ids of whole texts from a tokenizer file.

    A byte-level tokenizer without normalizer starts a new piece at a single blank and at a
    single line feed between two characters that aren't blank, and at a mark of punctuation
    behind a letter or digit. Texts may be cut there and equal words encoded once: Arrow cuts
    the texts and numbers their different words, the library encodes those that are new, and
    the ids are put together by number. A word of letters alone is one piece and goes to the
    library's model at once. A text with any other blank is cut at the clean ones only. For any
    other tokenizer texts are encoded whole.
    """

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        parsed = json.loads(definition)
        before, added = parsed.get("pre_tokenizer") or {}, parsed.get("added_tokens", [])
        self.by_word = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not any(parsed.get(k) for k in ("normalizer", "truncation", "padding"))
            and not any(t.get("lstrip") or t.get("rstrip") or any(map(str.isspace, t["content"])) for t in added)
        )
        # added tokens are found before texts are cut to pieces: no cut at a mark that one holds
        self.marks = "".join(sorted(set(string.punctuation).difference("_", *(t["content"] for t in added))))
        self.spelled = not any(t["content"].isalpha() for t in added)
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        largest = max(end_id, self.tokenizer.get_vocab_size() - 1)
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.end = self._packed([end_id])
        self.feed = self._encoded(["\n"])[0]
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        if sys.byteorder == "little":
            return array(self.kind.char, ids).tobytes()
        return np.array(ids, dtype=self.kind).tobytes()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [self._packed(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Packed ids of each text, with the end id."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not self.by_word or not len(texts):
            return [x + self.end for x in self._encoded(texts.to_pylist())]
        if len(self.words) > WORDS_KEPT:
            self.older, self.words = self.words, {}
        if len(self.tails) > WORDS_KEPT:
            self.tails = {}
        cuts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        starts, cut = cuts.offsets.to_numpy().astype(np.int64), cuts.flatten()
        firsts, pieces = starts[:-1] - starts[0], np.diff(starts)
        behind = np.ones(len(cut), dtype=bool)
        behind[firsts] = False
        heads, coded = cut.take(pa.array(firsts)).to_pylist(), cut.filter(pa.array(behind)).dictionary_encode()
        packed = self._words(coded.dictionary)
        codes = np.empty(len(cut), dtype=np.int64)
        codes[behind], codes[firsts] = coded.indices.to_numpy(), len(packed) + np.arange(len(heads))
        odd = np.array([x is None for x in packed] + [False] * len(heads), dtype=bool)
        # blanks that aren't clean: the text apart, by its clean ones
        apart = np.logical_or.reduceat(odd[codes], firsts) | (pieces > 1) & np.array([not h or h[-1].isspace() for h in heads])
        rest = [()] * len(heads)
        if apart.any():
            for i in np.flatnonzero(apart).tolist():
                heads[i], *rest[i] = _CLEAN.split(texts[i].as_py())
            found = list(set().union(*rest))
            found = dict(zip(found, self._words(pa.array(found, texts.type)), strict=True))
            ends = [word for word, ids in found.items() if ids is None]  # blanks end a text
            found.update(zip(ends, self._learn(ends), strict=True))
            rest = [[found[word] for word in words] for words in rest]
            kept = ~np.repeat(apart, pieces)
            kept[firsts] = True
            codes, pieces = codes[kept], np.where(apart, 1, pieces)
        joined = pa.array([*packed, *self._encoded(heads)], pa.large_binary()).take(pa.array(codes))
        at = np.frombuffer(joined.buffers()[1], dtype=np.int64, count=len(joined) + 1)[np.append(0, np.cumsum(pieces))].tolist()
        ids = memoryview(joined.buffers()[2] or b"")
        return [b"".join((ids[a:b], *more, self.end)) for (a, b), more in zip(pairwise(at), rest, strict=True)]

    def _words(self, words: pa.Array) -> list[bytes | None]:
        """Packed ids of different words; None for those that don't stand between clean blanks.

        A word that begins a line has its line feed, any other stands for itself behind a blank.
        """
        odd = _judged(pc.utf8_slice_codeunits(words, 0, 2), lambda x: not x.removeprefix("\n") or x.removeprefix("\n")[0].isspace())
        odd |= _judged(pc.utf8_slice_codeunits(words, -1), str.isspace)
        stems = pc.ascii_rtrim(words, characters=self.marks)
        closed = _judged(pc.utf8_slice_codeunits(stems, -1), str.isalnum) & ~odd
        stems = pc.if_else(pa.array(odd), None, pc.if_else(pa.array(closed), stems, words)).dictionary_encode()
        known = [*self._learn(stems.dictionary.to_numpy(zero_copy_only=False).tolist()), None]
        packed = [known[i] for i in stems.indices.fill_null(len(known) - 1).to_numpy().tolist()]
        sizes = [pc.binary_length(x).fill_null(0).to_numpy().astype(np.int64) for x in (words, stems.cast(words.type))]
        closed = np.flatnonzero(closed & (sizes[0] > sizes[1])).tolist()
        behind = [w[-n:] for w, n in zip(words.take(pa.array(closed, pa.int64())).to_numpy(zero_copy_only=False).tolist(), (sizes[0] - sizes[1])[closed].tolist(), strict=True)]
        new = list(set(behind).difference(self.tails))
        self.tails.update(zip(new, self._encoded(new), strict=True))
        for i, tail in zip(closed, behind, strict=True):
            packed[i] += self.tails[tail]
        return packed

    def _learn(self, words: list[str]) -> list[bytes]:
        """Packed ids of different words that stand between clean blanks and aren't cut."""
        known, older = self.words, self.older
        found = list(map(known.get, words))
        blank, tokenize = self.letters[0x20], self.model.tokenize
        mixed = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = older.get(word)
            if ids is None:
                body = word.removeprefix("\n")
                if not (self.spelled and body.isalpha()):
                    mixed.append(i)
                    continue
                if not body.isascii():
                    body = body.encode().decode("latin-1").translate(self.letters)
                if word[0] == "\n":
                    ids = self.feed + self._packed([x.id for x in tokenize(body)])
                else:
                    ids = self._packed([x.id for x in tokenize(blank + body)])
            known[word] = found[i] = ids
        spelled = [words[i] if words[i][0] == "\n" else " " + words[i] for i in mixed]
        for i, ids in zip(mixed, self._encoded(spelled), strict=True):
            known[words[i]] = found[i] = ids
        return found


def _judged(strings: pa.Array, test: Callable[[str], bool]) -> np.ndarray:
    """``test`` of each string, called once for each different one."""
    coded = strings.dictionary_encode()
    return np.array([test(x) for x in coded.dictionary.to_pylist()], dtype=bool)[coded.indices.to_numpy()]


def _encoder(key: tuple, definition: str, end_id: int) -> TextEncoder:
    """The encoder of this Python worker: made once, used by all its tasks."""
    return kept_by_worker(("tokens", *key), lambda: TextEncoder(definition, end_id))


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], pa.Array]]:
    """Ids and texts of rows with about ``TEXT_BYTES`` of text together, one row at least."""
    held, room = [], TEXT_BYTES

    def joined() -> tuple[list[int], pa.Array]:
        return [x for b in held for x in b.column(0).to_pylist()], pa.concat_arrays([b.column(1) for b in held])

    for batch in batches:
        ends = np.append(0, np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + room, "right")) - 1)
            held.append(batch.slice(at, to - at))
            room -= int(ends[to] - ends[at])
            at = to
            if at < len(batch) or room <= 0:
                yield joined()
                held, room = [], TEXT_BYTES
    if held:
        yield joined()


_SHARD = {"part": pa.int32(), "seq": pa.int32(), "n_ids": pa.int64(), "width": pa.int32(), "doc_ids": pa.binary(), "lengths": pa.binary(), "payload": pa.binary()}


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, bucket_keys: int = BUCKET_KEYS) -> None:
    """Encode ``doc_id``, ``text`` of all rows and write the two tables."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:  # read where the driver runs; a vocabulary has a fixed size
        definition = spark.sparkContext.broadcast(file.read())
    key = (tokenizer_path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(key, definition.value, end_id)
        part, seq = TaskContext.get().partitionId(), 0
        ids, lengths, payload, held = [], [], [], 0

        def shard() -> pa.RecordBatch:
            cells = [part, seq, held, encoder.kind.itemsize, np.array(ids, dtype="<i8").tobytes(), np.array(lengths, dtype="<i8").tobytes(), b"".join(payload)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, _SHARD.values(), strict=True)], list(_SHARD))

        for keys, texts in _portions(batches):
            for doc, packed in zip(keys, encoder.encode(texts), strict=True):
                n = len(packed) // encoder.kind.itemsize
                ids.append(doc)
                lengths.append(n)
                payload.append(packed)
                held += n
                if held >= SHARD_IDS:
                    yield shard()
                    seq, ids, lengths, payload, held = seq + 1, [], [], [], 0
        if ids:
            yield shard()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = whole_texts(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text_of().alias("_text"))
    # the hash only spreads rows that repeat an id
    ordered = rows.repartitionByRange(parts, "doc_id", F.xxhash64("_text")).sortWithinPartitions("doc_id", "_text")
    ordered.mapInArrow(run, "part int, seq int, n_ids long, width int, doc_ids binary, lengths binary, payload binary").write.mode("overwrite").parquet(f"{path}/shards")
    _write_index(spark, path, bucket_keys)


def shards(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The shards; and ``part``, ``seq``, ``base``: ids of all shards before. Window rows: one per part, one per shard of a part."""
    table = spark.read.parquet(f"{path}/shards")
    sizes = table.select("part", "seq", "n_ids")
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before_seq = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    per_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before_part), F.lit(0)).alias("_p"))
    bases = sizes.withColumn("_s", F.coalesce(F.sum("n_ids").over(before_seq), F.lit(0))).join(per_part, "part")
    return table, bases.select("part", "seq", (F.col("_p") + F.col("_s")).alias("base"))


def _entries(table: DataFrame) -> DataFrame:
    """``doc_id``, ``occurrence``, ``part``, ``seq``, ``offset``, ``n`` of every document; payloads aren't read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, ids, lengths in zip(batch["part"], batch["seq"], batch["doc_ids"], batch["lengths"], strict=True):
                n = np.frombuffer(lengths, dtype="<i8")
                yield pd.DataFrame({"doc_id": np.frombuffer(ids, dtype="<i8"), "part": part, "seq": seq, "offset": np.cumsum(n) - n, "n": n})

    entries = table.select("part", "seq", "doc_ids", "lengths").mapInPandas(run, "doc_id long, part int, seq int, offset long, n long")
    return entries.withColumn("occurrence", F.row_number().over(Window.partitionBy("doc_id").orderBy("part", "seq", "offset")).cast("long") - 1)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("occurrence").cast("long")), F.lit(buckets)).cast("int").alias("bucket")


def key_hash(ids: np.ndarray, occurrences: np.ndarray, level: int) -> np.ndarray:
    """Hash number ``level`` of keys; fingerprints use level -1."""
    salt = _U((level + 2) * _STEP & (1 << 64) - 1)
    return mixed(mixed(ids.astype(np.int64).view(_U) ^ salt) + mixed(occurrences.astype(np.int64).view(_U) + salt))


def perfect_hash(ids: np.ndarray, occurrences: np.ndarray) -> tuple[list[bytes], list[int], np.ndarray]:
    """(bits of each level, places of each level, slot of each key) of distinct keys."""
    bits, sizes, slots = [], [], np.zeros(len(ids), dtype=np.int64)
    left, settled, level = np.arange(len(ids)), 0, 0
    while len(left):
        size = max(8, len(left) * 3 // 2)
        place = (key_hash(ids[left], occurrences[left], level) % _U(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        mine = alone[place]
        slots[left[mine]] = settled + np.cumsum(alone)[place[mine]] - 1
        bits.append(np.packbits(alone).tobytes())
        sizes.append(size)
        settled += int(mine.sum())
        left, level = left[~mine], level + 1
    return bits, sizes, slots


def find(bits: list[bytes], sizes: list[int], ids: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    """Slots of keys; -1 for keys that no level settles."""
    slots, left, settled = np.full(len(ids), -1, dtype=np.int64), np.arange(len(ids)), 0
    for level, (packed, size) in enumerate(zip(bits, sizes, strict=True)):
        alone = np.unpackbits(np.frombuffer(packed, dtype=np.uint8))[:size].astype(bool)
        place = (key_hash(ids[left], occurrences[left], level) % _U(size)).astype(np.int64)
        hit = alone[place]
        before = np.cumsum(alone)
        slots[left[hit]] = settled + before[place[hit]] - 1
        settled += int(before[-1])
        left = left[~hit]
    return slots


_INDEX = "bucket int, buckets int, bits array<binary>, sizes array<int>, fingerprints binary, parts binary, seqs binary, offsets binary, lengths binary"


def _write_index(spark: SparkSession, path: str, bucket_keys: int) -> None:
    table = spark.read.parquet(f"{path}/shards")
    n = table.agg(F.sum(F.length("doc_ids") / 8)).first()[0] or 0
    buckets = max(1, -(-int(n) // bucket_keys))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        ids, occurrences = rows["doc_id"].to_numpy(), rows["occurrence"].to_numpy()
        bits, sizes, slots = perfect_hash(ids, occurrences)
        placed = rows.iloc[np.argsort(slots)]
        marks = key_hash(placed["doc_id"].to_numpy(), placed["occurrence"].to_numpy(), -1).astype("<u4")
        packed = [placed[c].to_numpy().astype(t).tobytes() for c, t in (("part", "<i4"), ("seq", "<i4"), ("offset", "<i8"), ("n", "<i8"))]
        return pd.DataFrame([(int(rows["bucket"].iat[0]), buckets, bits, sizes, marks.tobytes(), *packed)], columns=[c.split()[0] for c in _INDEX.split(", ")])

    entries = _entries(table).select("*", _bucket(buckets))
    entries.groupBy("bucket").applyInPandas(build, _INDEX).write.mode("overwrite").parquet(f"{path}/index")


def locate(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``occurrence``, ``part``, ``seq``, ``offset``, ``n`` of the keys that are stored.

    A key meets only the index row of its bucket; a bucket's keys are looked up together.
    """
    index = spark.read.parquet(f"{path}/index")
    buckets = max(1, int(index.agg(F.max("buckets")).first()[0] or 1))
    names = ["part", "seq", "offset", "n"]

    def probe(asked: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(row):
            return pd.DataFrame({c: [] for c in ("doc_id", "occurrence", *names)}, dtype="int64")
        r = row.iloc[0]
        ids, occurrences = asked["doc_id"].to_numpy(), asked["occurrence"].to_numpy()
        slots = find(list(r["bits"]), list(r["sizes"]), ids, occurrences)
        marks = np.frombuffer(r["fingerprints"], dtype="<u4")
        good = (slots >= 0) & (marks[slots] == key_hash(ids, occurrences, -1).astype("<u4"))
        at = slots[good]
        out = {"doc_id": ids[good], "occurrence": occurrences[good]}
        for name, column, kind in zip(names, ("parts", "seqs", "offsets", "lengths"), ("<i4", "<i4", "<i8", "<i8"), strict=True):
            out[name] = np.frombuffer(r[column], dtype=kind)[at].astype("int64")
        return pd.DataFrame(out)

    asked = keys.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("occurrence").cast("long").alias("occurrence"))
    asked = asked.select("*", _bucket(buckets))
    schema = "doc_id long, occurrence long, part long, seq long, offset long, n long"
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(probe, schema)


def read_documents(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``occurrence``, ``ids`` (array) of some keys: located by the index, cut out of their shards' payloads."""
    found = locate(spark, path, keys)
    table = spark.read.parquet(f"{path}/shards").select("part", "seq", "width", "payload")
    cut = F.substring(F.col("payload"), (F.col("offset") * F.col("width") + 1).cast("int"), (F.col("n") * F.col("width")).cast("int"))
    rows = found.join(table, ["part", "seq"]).select("doc_id", "occurrence", "width", cut.alias("raw"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["ids"] = [np.frombuffer(x, dtype=f"<u{w}").astype("int32") for x, w in zip(batch.pop("raw"), batch.pop("width"), strict=True)]
            yield batch

    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return rows.mapInPandas(run, "doc_id long, occurrence long, ids array<int>").select(known, "occurrence", "ids")


def slots(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``seq``, ``offset``, ``start``, ``n_tokens``, ``ids_crc32`` of every piece of payload, read shard by shard."""
    table, bases = shards(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, width, lengths, payload in zip(batch["part"], batch["seq"], batch["width"], batch["lengths"], batch["payload"], strict=True):
                n = np.frombuffer(lengths, dtype="<i8")
                offsets = np.cumsum(n) - n
                data = memoryview(np.frombuffer(payload, dtype=f"<u{width}").astype("<u4").tobytes())
                crc = [zlib.crc32(data[a * 4 : (a + k) * 4]) for a, k in zip(offsets.tolist(), n.tolist(), strict=True)]
                yield pd.DataFrame({"part": part, "seq": seq, "offset": offsets, "n_tokens": n, "ids_crc32": crc})

    read = table.select("part", "seq", "width", "lengths", "payload").mapInPandas(run, "part int, seq int, offset long, n_tokens long, ids_crc32 long")
    return read.join(bases, ["part", "seq"]).withColumn("start", F.col("base") + F.col("offset")).drop("base")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """For every row of ``docs``: its place by the index, and what the payload holds there."""
    spark = docs.sparkSession
    keys = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"))
    keys = keys.withColumn("occurrence", F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id")) - 1)
    found = locate(spark, path, keys)
    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return found.join(slots(spark, path), ["part", "seq", "offset"]).select(known, "start", "n_tokens", "ids_crc32")
