"""Divergence rules against a plain version over lists, and what they keep and reject."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

from subjectflow.llm import divergence
from tests.llm.conftest import CLASHING

BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    out, now = [], ""
    for c in text + " ":
        if c in BLANKS:
            out += [now] if now else []
            now = ""
        else:
            now += c
    return out


def base(text):
    words = words_of(text)
    covered = set()
    for i in range(len(words) - 2):
        if sum(words[j : j + 3] == words[i : i + 3] for j in range(len(words) - 2)) > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words_of(x)]
    return words, (len(words), sum(len(w) for w in words), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def classes(text):
    out = [0] * 9
    for c in text:
        named = [i for i, letters in enumerate(divergence.CLASSES.values()) if c in letters]
        out[named[0] if named else 7 if ord(c) < 128 else 8] += 1
    return out


def js(p, q):
    p, q, out = [x / sum(p) for x in p], [x / sum(q) for x in q], 0.0
    for a, b in zip(p, q, strict=True):
        out += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x)
    return math.sqrt(max(0, out / 2))


def plain(rows):
    judged, of_class, of_word, docs = [], defaultdict(lambda: [0] * 9), defaultdict(Counter), Counter()
    for i, text, lang in rows:
        text, lang = text or "", lang or "und"
        words, counts = base(text)
        failed = counts[0] < 50 or Fraction(counts[4], counts[0]) > Fraction(1, 2)
        judged.append((i, text, lang, words, counts, failed))
        if not failed:
            docs[lang] += 1
            of_class[lang] = [a + n * 1_000_000 // len(text) for a, n in zip(of_class[lang], classes(text), strict=True)]
            for w, n in Counter(words).items():
                of_word[lang][w] += n * 1_000_000 // len(words)
    out = []
    for i, text, lang, words, counts, failed in judged:
        kept = not failed
        if kept and docs[lang] >= divergence.MIN_DOCUMENTS:
            common = sorted(of_word[lang].items(), key=lambda x: (-x[1], x[0].encode()))[: divergence.COMMON]
            own = [words.count(w) for w, _ in common]
            away = js([*own, len(words) - sum(own)], [*(n for _, n in common), sum(of_word[lang].values()) - sum(n for _, n in common)])
            n = len(words)
            kept = js(classes(text), of_class[lang]) <= math.sqrt(0.04 + 4 / n) and away <= math.sqrt(0.07 + 8 / n)
        out.append((i, *counts, failed, kept))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def prose(chance, n):
    return " ".join(chance.choice(["the", "of", "and", "to", "in"]) if chance.random() < 0.4 else "".join(chance.choices("abcdeèß", k=6)) + chance.choice(["", "", ",", ".\n"]) for _ in range(n))


def frame(spark, rows):
    extra = [c for c in CLASHING if c not in ("n", "words")] + ["kept", "lang_", "reference_", "verdict"]
    filled = [(i, t, lang, "s", None, *[0] * len(extra)) for i, t, lang in rows]
    return spark.createDataFrame(filled, "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} int" for c in extra))


def test_equals_the_plain_version(spark):
    chance = random.Random(11)
    rows = [(i, prose(chance, chance.randint(20, 160)), "en") for i in range(60)]
    rows += [(100 + i, prose(chance, 80), None) for i in range(10)]  # no reference: no verdict
    shout = " ".join("".join(chance.choices("ABCDE", k=6)) + "!!" for _ in range(120))
    table = " | ".join("".join(chance.choices("abcde", k=6)) for _ in range(120))
    repeated = "one two three four " * 30
    rows += [(200, shout, "en"), (201, table, "en"), (202, repeated, "en"), (203, shout, None), (204, None, "en"), (205, "", None), (206, " \n\t ", "en")]
    rows += [(None, rows[0][1], "en"), (0, rows[1][1], "en"), (0, rows[1][1], "en"), (207, "x\n\nx\n x\nx\r\n", "en"), (208, "a b c a b c a", "en")]
    rows += [(209, prose(chance, 700) + "\n" + "## ** " * 900, "en")]
    found = divergence.judge(frame(spark, rows).repartition(4))
    got = sorted([tuple(r) for r in found.select(*COLUMNS).collect()], key=str)
    assert got == plain(rows)
    kept = {r[0]: r[-1] for r in got}
    assert not kept[200] and not kept[201] and not kept[202] and kept[203] and not kept[204] and not kept[205]
    clean = [r[-1] for r in got if r[0] is not None and r[0] < 100 and not r[-2]]
    assert len(clean) > 40 and sum(clean) >= 0.95 * len(clean)


def test_keep_leaves_columns_alone(spark):
    chance = random.Random(2)
    docs = frame(spark, [(i, prose(chance, 90), "en") for i in range(35)] + [(99, "short", "en")])
    left = divergence.keep(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(35))
    assert divergence.judge(docs.limit(0)).collect() == []


def test_tasks_that_hand_on_often(spark, monkeypatch):
    chance = random.Random(4)
    docs = frame(spark, [(i, prose(chance, 70), "en") for i in range(40)]).coalesce(1)
    whole = divergence.references(docs).collect()
    monkeypatch.setattr(divergence, "WORDS_HELD", 5)  # closures take the module's value when they are made
    assert divergence.references(docs).collect() == whole


def test_very_long_text():
    text = "the same few words and again " * 40_000
    assert divergence.Counts.of(text).base() == (240_000, 920_000, 0, 0, 240_000)
