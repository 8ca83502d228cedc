"""Byte-level BPE: merges as a lazily determinised transducer, and a streaming decoder.

**Encoding.** Let ``enc(s)`` be the tokens of a byte string. Two facts make a left to right
machine possible: every piece of an encoding encodes to itself, and a sequence of tokens is
an encoding exactly if each adjacent pair is (``enc(a + b) == [a, b]``). So ``enc`` of a
prefix ending at byte *i* is ``enc`` of some shorter prefix plus one token, and that token
is the only one whose pair with its predecessor is stable. A state of the transducer is the
set of prefixes that a later token may still start from, each with its last token. A prefix
leaves the state as soon as no token of the vocabulary continues the bytes after it, so what
is open is bounded by the longest token. Tokens that all prefixes of the state share are
final; they are emitted at the end of a piece and, within a long one, after each stretch of
bytes. States and their arcs are made when first met (subset construction by need) and
dropped when they exceed a bound, as regular expression engines do.

**Decoding.** ``StreamDecoder`` takes token ids in any portions and runs a UTF-8 automaton
over their bytes: text is handed out up to the last complete character, ill-formed bytes
become U+FFFD (one per maximal ill-formed part), and the state is one small integer and at
most three bytes.

Texts that are null encode like the empty text: no ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

from subjectflow.llm.common import kept_by_worker, text_of, whole_texts

#: Words, and pieces, whose ids a worker remembers (twice: lately used, and before), and states
#: of the transducer before it starts anew. Both only bound memory; results don't depend on them.
WORDS_KEPT = 150_000
STATES_KEPT = 220_000
#: Bytes of a long piece after which its final tokens are emitted.
STRETCH = 1_024


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and number on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merges:
    """Stable pairs of tokens, by undoing the merges of the two that touch the place where they meet."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.token = ranks, {r: t for t, r in ranks.items()}
        self.never = max(ranks.values(), default=0) + 1
        self.stable: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, piece: bytes, parts_left: int = 1) -> list[bytes]:
        """The plain definition: join the adjacent pair of lowest rank until none is left (or so few parts are)."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        rank = self.ranks.get
        none = len(self.ranks) + 1_000_000
        costs = [rank(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while len(costs) >= parts_left and (best := min(costs)) < none:
            at = costs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at < len(costs):
                costs[at] = rank(parts[at] + parts[at + 1], none)
            if at:
                costs[at - 1] = rank(parts[at - 1] + parts[at], none)
        return parts

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that a token's last merge joins; None for a single byte."""
        if token not in self.halves:
            data = self.token[token]
            self.halves[token] = None if len(data) < 2 else tuple([self.ranks[x] for x in self.merged(data, 2)])
        return self.halves[token]

    def pair(self, left: int, right: int) -> bool:
        """True if the two tokens side by side are an encoding."""
        key = left << 32 | right
        known = self.stable.get(key)
        if known is None:
            if len(self.stable) > 100_000:
                self.stable.clear()
            known = self.stable[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        """True if no merge joins bytes of both tokens.

        Backwards in time: the parts that meet are the tokens, then the halves of whichever
        was made later, and so on to single bytes. Two parts are joined if their merge comes
        before the merges that use up either of them; of equal merges the left one is first.
        """
        token, rank, never = self.token, self.ranks.get, self.never
        left_used = right_used = never
        while True:
            joined = rank(token[left] + token[right], never)
            if joined < left_used and joined <= right_used:
                return False
            left_halves, right_halves = self.split(left), self.split(right)
            if left_halves and (left > right or not right_halves):
                left_used, left = left, left_halves[1]
            elif right_halves:
                right_used, right = right, right_halves[0]
            else:
                return True


class Transducer:
    """Encodes one pre-tokenised piece at a time; output is packed 32-bit ids.

    A state is a tuple of paths, one for each prefix that may still matter: the trie node of
    the bytes after it, and above 32 bits the number of the last token of the prefix (its id
    plus one, 0: the prefix is empty). The last path is the whole input read so far. An arc is
    kept under its state and byte as one integer: the next state, and above 32 bits the number
    of the last token of the input up to there. Tokens of input that has not been emitted yet
    are found from those, from its end backwards.
    """

    def __init__(self, ranks: dict[bytes, int], states_kept: int = STATES_KEPT, stretch: int = STRETCH):
        self.merges, self.states_kept, self.stretch = Merges(ranks), states_kept, stretch
        # the vocabulary as a trie: node and byte -> node; the number of the token that ends at a node
        self.step: dict[int, int] = {}
        self.ends, self.inner, self.depth = [0], [True], [0]
        self.length, self.packed = [0] * (self.merges.never + 1), [b""] * (self.merges.never + 1)
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                if key not in self.step:
                    self.step[key] = len(self.ends)
                    self.ends.append(0)
                    self.inner.append(False)
                    self.depth.append(self.depth[node] + 1)
                node = self.step[key]
            self.ends[node] = rank + 1
            self.length[rank + 1], self.packed[rank + 1] = len(token), rank.to_bytes(4, "little")
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        self.arcs: dict[int, int] = {}
        self._state((0,))

    def _state(self, paths: tuple[int, ...]) -> int:
        n = self.number.setdefault(paths, len(self.states))
        if n == len(self.states):
            self.states.append(paths)
        return n

    def _arc(self, state: int, byte: int) -> int:
        """Make the arc of a state over one byte."""
        step, ends, inner, pair = self.step.get, self.ends, self.inner, self.merges.pair
        alive, whole = [], 0
        for path in self.states[state]:
            node = step((path & 0xFFFFFFFF) << 8 | byte)
            if node is None:
                continue
            last = path >> 32
            if not whole and (end := ends[node]) and (not last or pair(last - 1, end - 1)):
                whole = end
            if inner[node]:
                alive.append(last << 32 | node)
        if not whole:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        alive.append(whole << 32)
        arc = self.arcs[state << 8 | byte] = whole << 32 | self._state(tuple(alive))
        return arc

    def _final(self, state: int, lasts: list[int]) -> int:
        """How many bytes of the input that is held have tokens which all paths share."""
        length, places = self.length, {len(lasts) - self.depth[path & 0xFFFFFFFF] for path in self.states[state]}
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(last - length[lasts[last - 1]])
        return places.pop()

    def _tokens(self, lasts: list[int], at: int) -> bytes:
        """Packed ids of the first ``at`` bytes that are held."""
        out, length, packed = [], self.length, self.packed
        while at:
            token = lasts[at - 1]
            out.append(packed[token])
            at -= length[token]
        out.reverse()
        return b"".join(out)

    def encode(self, piece: bytes) -> bytes:
        """Packed ids of one piece."""
        state, lasts, out = 0, [], []
        for at in range(0, len(piece), self.stretch):
            if at:
                done = self._final(state, lasts)
                out.append(self._tokens(lasts, done))
                del lasts[:done]
            if len(self.states) > self.states_kept:
                paths = self.states[state]
                self._reset()
                state = self._state(paths)
            get = self.arcs.get
            for byte in piece[at : at + self.stretch]:
                arc = get(state << 8 | byte) or self._arc(state, byte)
                state = arc & 0xFFFFFFFF
                lasts.append(arc >> 32)
        out.append(self._tokens(lasts, len(lasts)))
        return b"".join(out)


class Encoder:
    """Whole texts: cut at clean blanks, split by the pattern, run the transducer.

    A single blank or line feed between two characters that are not blank always begins a
    piece (the line feed is one), so the text may be cut there and equal words, and equal
    pieces of them, encoded once. A word that is empty or begins or ends with a blank is never
    kept, so a text with such a blank is noticed and cut by a search for the clean blanks
    instead.
    """

    _clean = re.compile(r"(?<=\S)[ \n](?=\S)")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.pieces = Transducer(ranks), regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}

    def _cut(self, cut: str) -> bytes:
        get, make = self.parts.get, self._part
        return b"".join([get(p) or make(p) for p in self.pieces(cut)])

    def _part(self, piece: str) -> bytes:
        """Ids of a piece of the pattern."""
        # surrogates can't come out of Spark; "replace" keeps direct callers safe as well
        ids = self.older_parts.get(piece) or self.transducer.encode(piece.encode("utf-8", "replace"))
        if len(piece) < 200:
            self.parts[piece] = ids
            if len(self.parts) > WORDS_KEPT:
                self.older_parts, self.parts = self.parts, {}
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a word after a clean blank; one that begins a line has its line feed."""
        body = word[1:] if word[:1] == "\n" else word
        if not body or body[0].isspace() or body[-1].isspace():
            raise KeyError(word)
        ids = self.older.get(word) or (self._cut(" " + word) if body is word else self._cut("\n") + self._cut(body))
        if len(word) < 200:
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Packed 32-bit ids of a whole text."""
        if not text:
            return b""
        if len(self.words) > WORDS_KEPT:
            self.older, self.words = self.words, {}
        get, make = self.words.get, self._word
        parts = text.replace("\n", " \n").split(" ")
        first = parts.pop(0)
        if parts and (not first or first[-1].isspace()):
            return self._slow(text)
        try:
            return self._cut(first) + b"".join([get(w) or make(w) for w in parts])
        except KeyError:
            return self._slow(text)

    def _slow(self, text: str) -> bytes:
        starts = [0, *[m.start() for m in self._clean.finditer(text)], len(text)]
        return b"".join([self._cut(text[a:b]) for a, b in zip(starts, starts[1:], strict=False)])


# UTF-8 automaton: 0 is between characters; the other states name what must follow.
_ANY1, _ANY2, _ANY3, _AFTER_E0, _AFTER_ED, _AFTER_F0, _AFTER_F4 = range(1, 8)
_BAD = 8


def _utf8_table() -> list[list[int]]:
    """Next state by state and byte, from the ranges of well-formed UTF-8."""
    table = [[_BAD] * 256 for _ in range(8)]

    def fill(state: int, first: int, last: int, after: int) -> None:
        table[state][first : last + 1] = [after] * (last - first + 1)

    fill(0, 0x00, 0x7F, 0)
    fill(0, 0xC2, 0xDF, _ANY1)
    fill(0, 0xE0, 0xEF, _ANY2)
    fill(0, 0xF0, 0xF4, _ANY3)
    table[0][0xE0], table[0][0xED], table[0][0xF0], table[0][0xF4] = _AFTER_E0, _AFTER_ED, _AFTER_F0, _AFTER_F4
    fill(_ANY1, 0x80, 0xBF, 0)
    fill(_ANY2, 0x80, 0xBF, _ANY1)
    fill(_ANY3, 0x80, 0xBF, _ANY2)
    fill(_AFTER_E0, 0xA0, 0xBF, _ANY1)
    fill(_AFTER_ED, 0x80, 0x9F, _ANY1)
    fill(_AFTER_F0, 0x90, 0xBF, _ANY2)
    fill(_AFTER_F4, 0x80, 0x8F, _ANY2)
    return table


UTF8 = _utf8_table()


def _run(state: int, token: bytes) -> tuple[int, int]:
    """State after the bytes of a token, and how many of its last bytes are in no whole character."""
    tail = 0
    for byte in token:
        after = UTF8[state][byte]
        if after == _BAD and state:  # what was open is ill formed; the byte may start anew
            after, tail = UTF8[0][byte], 0
        if after == _BAD:
            after = 0
        tail = tail + 1 if after else 0
        state = after
    return state, tail


class Vocabulary:
    """Bytes of each id, and the moves of the automaton over whole tokens.

    From between two characters the moves are in an array over all ids, so a run of tokens
    that end where a character ends is passed in one step; other moves are looked up.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.opens = np.array([_run(0, t)[0] != 0 for t in self.token])


class StreamDecoder:
    """Text of a stream of ids; ``feed`` hands out whole characters only."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.state, self.held = vocabulary, 0, b""

    def feed(self, ids: np.ndarray) -> str:
        """Text that is complete after these ids."""
        token, n = self.vocabulary.token, len(ids)
        listed = ids.tolist()
        state, tail, at = self.state, len(self.held), 0
        opening = np.flatnonzero(self.vocabulary.opens[ids])
        while at < n:
            if state == 0:
                nxt = np.searchsorted(opening, at)
                if nxt == len(opening):
                    tail = 0
                    break
                at, tail = int(opening[nxt]), 0
            data = token[listed[at]]
            was, state_tail = state, _run(state, data)
            state = state_tail[0]
            tail = state_tail[1] + (tail if was and state_tail[1] == len(data) and _stays_open(was, data) else 0)
            at += 1
        data = self.held + b"".join([token[i] for i in listed])
        cut = len(data) - (tail if state else 0)
        self.state, self.held = state, data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        """What an unfinished character at the end stands for."""
        rest, self.state, self.held = self.held, 0, b""
        return rest.decode("utf-8", "replace")


def _stays_open(state: int, data: bytes) -> bool:
    """True if the character that was open before the bytes is still the open one."""
    for byte in data:
        state = UTF8[state][byte]
        if state in (0, _BAD):
            return False
    return True


def _worker(key: str, ranks: dict[bytes, int], pattern: str) -> tuple[Encoder, Vocabulary]:
    """The encoder of this Python worker: made once, used by all its tasks."""
    return kept_by_worker(("bpe", key, pattern), lambda: (Encoder(ranks, pattern), Vocabulary(ranks)))


def broadcast_ranks(spark: SparkSession, path: str):
    """The rank file, read where the driver runs; a vocabulary has a fixed size."""
    return spark.sparkContext.broadcast((path, load_ranks(path)))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` (packed little-endian 32-bit) and ``n_tokens`` of every text.

    A null or empty text has no ids. Rows stay where they are: no shuffle.
    """
    ranks = broadcast_ranks(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, _ = _worker(ranks.value[0], ranks.value[1], pattern)
        for batch in batches:
            ids = [coder.encode(t) for t in batch.pop("_text")]
            batch["ids"], batch["n_tokens"] = ids, np.array([len(x) // 4 for x in ids], dtype="int64")
            yield batch

    fields = docs.select(*keep).schema
    schema = fields.add("ids", "binary").add("n_tokens", "long")
    return whole_texts(docs, *keep, text_of(text).alias("_text")).mapInPandas(run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded``: the text of the packed ``ids``, portion by portion."""
    ranks = broadcast_ranks(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, vocabulary = _worker(ranks.value[0], ranks.value[1], pattern)
        for batch in batches:
            batch["decoded"] = [decoded(vocabulary, x) for x in batch.pop("ids")]
            yield batch

    schema = encoded.select(*keep).schema.add("decoded", "string")
    return whole_texts(encoded, *keep, "ids").mapInPandas(run, schema)


def decoded(vocabulary: Vocabulary, packed: bytes | None, portion: int = 65_536) -> str:
    """The text of packed ids, fed in portions."""
    stream = StreamDecoder(vocabulary)
    ids = np.frombuffer(packed or b"", dtype="<u4")
    parts = [stream.feed(ids[i : i + portion]) for i in range(0, len(ids), portion)]
    return "".join(parts) + stream.finish()


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), ids: bool = False) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every text; with ``ids`` the packed ids too."""
    ranks = broadcast_ranks(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, vocabulary = _worker(ranks.value[0], ranks.value[1], pattern)
        for batch in batches:
            coded = [coder.encode(t) for t in batch.pop("_text")]
            batch["n_tokens"] = np.array([len(x) // 4 for x in coded], dtype="int64")
            batch["ids_sha256"] = [hashlib.sha256(x).hexdigest() for x in coded]
            batch["decoded_sha256"] = [hashlib.sha256(decoded(vocabulary, x).encode()).hexdigest() for x in coded]
            if ids:
                batch["ids"] = coded
            yield batch

    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if ids:
        schema = schema.add("ids", "binary")
    return whole_texts(docs, *keep, text_of().alias("_text")).mapInPandas(run, schema)
