"""Cross-tokenizer alignment against a plain version that holds everything in dictionaries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from subjectflow.llm import align
from tests.llm.conftest import CLASHING

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    with open(A, encoding="utf-8") as one, open(B, "rb") as two:
        known = align.Aligner(one.read(), two.read())

    def groups(text):
        a, b, data = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids, model.encode(text or ""), (" " + (text or "")).encode()
        a_bytes, b_bytes = [known.a_bytes[i] for i in a], [known.b_bytes[i] for i in b]
        if not text or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return [], 0, 0
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (a_bytes, b_bytes)]
        cuts = np.array(sorted(ends[0] & ends[1]))
        out = [([], []) for _ in cuts]
        for ids, pieces, side in ((a, a_bytes, 0), (b, b_bytes, 1)):
            for i, n in zip(ids, np.searchsorted(cuts, np.cumsum([len(x) for x in pieces])).tolist(), strict=True):
                out[n][side].append(i)
        return out, len(a), len(b)

    def report(rows):
        found = [(i, *groups(text)) for i, text in rows]
        linked = [Counter((x, y) for a, b in g for x in a for y in b) for _, g, _, _ in found]
        docs, best = Counter(), defaultdict(int)
        for pairs in linked:
            docs.update(pairs.keys())
        for (x, _), n in docs.items():
            best[x] = max(best[x], n)
        out = []
        for (i, g, n_a, n_b), pairs in zip(found, linked, strict=True):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append((i, n_a, n_b, len(g), sum(pairs.values()), sum(n for p, n in pairs.items() if docs[p] == best[p[0]]),
                        sum(n * docs[p] for p, n in pairs.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return sorted(out, key=str)

    return report


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

TEXTS = [
    None, "", " ", "\n", "  ", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \n b", "\nstart", "end\n", "tab\there", "carriage\r\nreturn", ";\r next",
    "<|endoftext|> and </s> <s> <unk>", "▁ low line ▁x", "a▁b", "ﬁne", "é combined ́ alone", "日本語 テキスト", "don't we'll I'M", " no break ",
    "Unwahrscheinlichkeitsüberlegungen und Größe", "number 1234567 3.14", "\x00 zero \x1f unit", "😀 emoji 👩‍👩‍👧", "thhaing ndble, thhaing ndble.",
]


def test_equals_the_plain_version(spark, docs, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a thhaing"), (3, "a thhaing"), (3, "a thhaing"), (-(1 << 63), "ndble"), ((1 << 63) - 1, "x")]
    frame = docs(rows, CLASHING).repartition(3)
    found = align.report(frame, A, B)
    assert tuple(sorted(found.columns)) == tuple(sorted(COLUMNS))
    assert sorted([tuple(r) for r in found.select(*COLUMNS).collect()], key=str) == plain(rows)


def test_long_text_and_small_blocks(spark, docs, plain, monkeypatch):
    chance = random.Random(3)
    words = ["the", "ing", "thhaing", "über", "x\ty", "\n", "", "naïve", "1,000", "日本"]
    rows = [(i, " ".join(chance.choices(words, k=chance.randint(1, 40)))) for i in range(60)] + [(99, " ".join(chance.choices(words, k=60_000)))]
    expected = plain(rows)
    with open(A, encoding="utf-8") as one, open(B, "rb") as two:
        aligner = align.Aligner(one.read(), two.read())
    monkeypatch.setattr(align, "WORDS_KEPT", 3)  # words are forgotten all the time
    for text in (rows[0][1], rows[1][1], rows[0][1]):
        got = aligner.documents([text])[0][0]
        assert got == next(tuple([*r[1:5], r[7]]) for r, (i, t) in ((x, y) for x in expected for y in rows if x[0] == y[0]) if t == text)
    found = align.report(docs(rows).repartition(5), A, B)
    assert sorted([tuple(r) for r in found.select(*COLUMNS).collect()], key=str) == expected


def test_no_rows(spark, docs):
    assert align.report(docs([(1, "a")]).limit(0), A, B).collect() == []
    only = align.report(docs([(1, None), (2, "")]), A, B).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_bitmaps_and_planes_keep_every_link():
    chance = np.random.default_rng(5)
    place, pair = chance.integers(0, align.BLOCK_DOCS, 60_000), chance.choice([3, 7, 8, 11], 60_000, p=[0.9, 0.09, 0.009, 0.001])
    links = chance.integers(1, 9, 60_000)
    known, planes = align.bitmaps(place, pair, links)
    counted = Counter()
    for p, i, n in zip(pair.tolist(), place.tolist(), links.tolist(), strict=True):
        counted[p, i] += n
    back = Counter()
    for plane, packed in enumerate(planes):
        for p, i in zip(*unpacked(packed), strict=True):
            back[int(known[p]), i] += 1 << max(0, plane - 1)
    assert back == counted
    assert align.popcounts(planes[0]).tolist() == [sum(k == p for k, _ in counted) for p in known.tolist()]


def unpacked(packed):
    return [x.tolist() for x in align.unpack(packed)]
