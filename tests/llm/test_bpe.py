"""Byte-level BPE against the reference library, and the streaming decoder."""

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from subjectflow.llm import bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER, VOCABULARY = bpe.Encoder(RANKS, public_tokenizers.PATTERN), bpe.Vocabulary(RANKS)


def ids(text):
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aab  \n\t'sthe rein.,!0123 éß中😀\x1c²\xa0　", max_size=40))
def test_equals_the_library_and_comes_back(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert bpe.decoded(VOCABULARY, ENCODER.encode(text), 3) == text


def test_random_letters_and_long_runs():
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choice("etaoinshrdlu") for _ in range(60))
        assert ids(text) == LIBRARY.encode_ordinary(text)
    for text in ("a" * 3000, " " * 500, "\n\n \n" * 50, "=" * 777, "", "x" + " " * 9):
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_small_state_bound_changes_nothing():
    small = bpe.Transducer(RANKS, states_kept=5)
    for word in (b" thanedble", b" worthless", "größe".encode(), b"xyzzy") * 3:
        assert np.frombuffer(small.encode(word), "<u4").tolist() == LIBRARY.encode_ordinary(word.decode())


def test_short_stretches_change_nothing():
    short = bpe.Transducer(RANKS, states_kept=50, stretch=3)
    draw = random.Random(5)
    for letters in ("a", "ab", "etaoinshrdlu", "é中"):
        for n in (1, 2, 3, 4, 40, 700):
            word = "".join(draw.choice(letters) for _ in range(n))
            assert np.frombuffer(short.encode(word.encode()), "<u4").tolist() == [RANKS[x] for x in short.merges.merged(word.encode())]


def test_stable_pairs_equal_the_merging_of_both_tokens():
    merges, draw = bpe.Merges(RANKS), random.Random(6)
    runs = [r for t, r in RANKS.items() if len(set(t)) == 1]
    for some in (runs, list(RANKS.values())[:2000], list(RANKS.values())):
        for _ in range(4000):
            left, right = draw.choice(some), draw.choice(some)
            both = [merges.token[left], merges.token[right]]
            assert merges.pair(left, right) == (merges.merged(both[0] + both[1]) == both)


def test_line_feeds_and_words_met_again():
    texts = ["one\ntwo,\nthree", "two, three\ntwo", "a \nb", "a\n b", "a\n\nb two,", "\none two", "one two\n", "one\r\ntwo", "x\xa0\ny z", "one\n's two's"]
    for text in texts * 2:
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_stream_of_broken_bytes_equals_replacement():
    draw = random.Random(2)
    odd = [i for i, t in enumerate(VOCABULARY.token) if any(b > 127 for b in t)]
    for _ in range(2000):
        some = [draw.choice(odd) for _ in range(8)]
        stream = bpe.StreamDecoder(VOCABULARY)
        out = "".join(stream.feed(np.array([i])) for i in some) + stream.finish()
        assert out == b"".join(VOCABULARY.token[i] for i in some).decode("utf-8", "replace")


def test_frames(spark, docs):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (None, "ähm"), (1, "Hello  world")]
    df = docs(rows, ("ids", "n_tokens", "_text"))
    got = bpe.round_trip(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True).collect()
    for r, (key, text) in zip(got, rows, strict=True):
        want = LIBRARY.encode_ordinary(text or "")
        assert r.doc_id == key and r.n_tokens == len(want) and np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    coded = bpe.encode(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    back = bpe.decode(coded, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert [r.decoded for r in back] == [t or "" for _, t in rows]
    assert bpe.round_trip(docs([]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
