"""Collocation mining against a plain version over dictionaries, and its summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from subjectflow.llm import collocations
from tests.llm.conftest import CLASHING

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, top=collocations.TOP):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= 10}
        for p, a in frequent.items():
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            inside = [b for q, b in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= 50 * a for b in inside):
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def frame(spark, rows):
    extra = [*CLASHING, "f", "l", "r", "a", "phrase", "_lang"]
    extra = [c for c in dict.fromkeys(extra) if c not in ("_text",)]
    filled = [(i, t, lang, "s", None, *[0] * len(extra)) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(filled, "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} int" for c in extra))


def corpus(seed=1):
    chance = random.Random(seed)
    words = ["New", "new", "York", "city", "é", "the", "a", "of", "état", "\x00", "日本", "x y"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "!\n", " ;x "]
    rows = [("".join(w for _ in range(chance.randint(1, 60)) for w in (chance.choice(words), chance.choice(ends))), chance.choice(["en", "en", "fr", None])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" \n.", "xx"), ("lone", "yy")] + [("New York city hall is here", "en")] * 25 + [("a a a a a a a a a a a a a", "rr")] * 2
    return rows


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_equals_the_plain_version(spark):
    rows = corpus()
    assert found(collocations.mine(frame(spark, rows).repartition(5))) == plain(rows)
    assert found(collocations.mine(frame(spark, rows).repartition(2), top=3)) == plain(rows, 3)


def test_no_phrases(spark):
    assert collocations.mine(frame(spark, [("a b", "en")]).limit(0)).collect() == []
    assert collocations.mine(frame(spark, [(None, None), ("once upon", "en")])).collect() == []


@pytest.mark.parametrize("segment", [1, 7, 64])
def test_segments_lose_no_phrase(segment, monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", segment)
    chance, grams = random.Random(segment), collocations.Grams()
    text = "".join(chance.choice(["ab", "cd ", "ef\t", "g.", "\n", " h ", "Ä"]) for _ in range(3000))
    for words, known in collocations.segments(text):
        grams.add("en", grams.packed("en", words, known))
    grams.add_up()
    keys, counts = grams.held["en"]
    got = Counter({tuple(grams.phrase(k)[1].split(" ")): n for k, n in zip(keys.tolist(), counts.tolist(), strict=True)})
    expected = Counter()
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
        words = [w.encode().lower().decode() for w in re.findall("[^ \t]+", piece)]
        for k in (1, 2, 3):
            expected.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    assert got == expected
    assert grams.mass["en"] == sum(n for p, n in expected.items() if len(p) == 1)


def test_long_text_and_tasks_that_hand_on_often(spark, monkeypatch):
    rows = corpus(2) + [(" ".join(random.Random(9).choices(["one", "two", "three", "four.", "Five"], k=150_000)), "en")]
    for name, value in (("RAW", 500), ("HELD", 50), ("WORDS_HELD", 6), ("ROW_ENTRIES", 16), ("SEGMENT", 100), ("PART_CHARS", 100_000)):
        monkeypatch.setattr(collocations, name, value)
    grams, told = collocations.Grams(), Counter()
    for _ in collocations._gathered(grams, iter([frame_of(rows[:40])])):
        for lang, (keys, counts) in grams.held.items():
            for k, n in zip(keys.tolist(), counts.tolist(), strict=True):
                told[lang, grams.phrase(k)[1]] += n
        grams.clear()
    expected = Counter()
    for text, lang in rows[:40]:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text or ""):
            words = [w.encode().lower().decode() for w in re.findall("[^ \t]+", piece)]
            for k in (1, 2, 3):
                expected.update((lang or "und", " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    assert told == expected
    assert found(collocations.mine(frame(spark, rows).repartition(3))) == plain(rows)


def frame_of(rows):
    import pandas as pd

    return pd.DataFrame({"_lang": [lang or "und" for _, lang in rows], "_text": [t or "" for t, _ in rows]})


@pytest.mark.parametrize("seed", range(5))
def test_summaries_keep_every_frequent_key(seed):
    chance = np.random.default_rng(seed)
    stream = np.concatenate([np.repeat(np.arange(30, dtype=np.uint32), chance.integers(8, 40, 30)), chance.integers(100, 5000, 4000).astype(np.uint32)])
    chance.shuffle(stream)
    true, threshold = Counter(stream.tolist()), 10
    size = collocations.capacity(len(stream), threshold)
    whole, halves = collocations.Summary(size), [collocations.Summary(size) for _ in range(2)]
    for at in range(0, len(stream), 37):
        part, half = stream[at : at + 37], halves[at // 37 % 2]
        for s in (whole, half):
            s.add(part, np.ones(len(part), dtype=np.int64))
            s.settle()
    halves[0].merge(halves[1])
    for s in (whole, halves[0]):
        kept = set(s.reaching(threshold).tolist())
        assert {k for k, n in true.items() if n >= threshold} <= kept
        assert len(s.keys) <= size and s.taken < threshold
        assert all(true[k] - s.taken <= c <= true[k] for k, c in zip(s.keys.tolist(), s.counts.tolist(), strict=True))


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000
    counts = spark.createDataFrame([("en", 1, "x", 3 * big), ("en", 1, "y", 2 * big), ("en", 2, "x y", big)], "lang string, words int, phrase string, f long")
    row = collocations._scored(counts).first()
    assert row["score"] == 1_000_000 * big * big // (6 * big * big)
