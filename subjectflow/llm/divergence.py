"""Quality rules by distribution divergence.

Every text has some counts (words, symbols, repeated lines, words in repeated three-word
windows) and two plain rules on them (``base_failed``). A text that passes these is compared
with the reference of its language: two histograms, one over character classes and one over
the language's ``COMMON`` most common words and all others together. The distance is
Jensen-Shannon's, with logarithms to base 2 and the root taken, so it lies between 0 and 1.
A short text is far from any reference by chance: the expected square of the distance falls
with the reciprocal of its length, and so do the limits (``limit``). A text is kept if both
distances are within their limits.

A reference is the mean over all documents of a language that pass the plain rules: each
counts alike, whatever its length, in whole millionths, so that sums are exact in any order.
Languages with fewer than ``MIN_DOCUMENTS`` of them have no reference, and their documents no
verdict: they are kept. Null is the language ``und``. Null and empty texts have no words and
fail. Words are added up in every task before they are shuffled by language and word, and no
language is gathered anywhere; what comes to a language's row are its ``COMMON`` words. Rows
with the same id, and repeated rows, are judged each for itself; an empty table gives none.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.llm.common import WORD, fresh, kept_by_worker, small_join, stored, text_of, whole_texts

MIN_WORDS, MIN_DOCUMENTS, COMMON = 50, 30, 64
#: Limits of the squared distances: a part for every text and a part for each word that it lacks.
CLASS_LIMIT, WORD_LIMIT = (0.04, 4.0), (0.07, 8.0)
#: A share of 1 in the references' sums; words that a task adds up before it hands them on.
UNIT, WORDS_HELD = 1_000_000, 500_000
#: Languages up to which references (some 2 KB each) are broadcast; more are joined by a shuffle.
BROADCAST_LANGUAGES = 2_000

#: Character classes: a name and the ASCII characters; all characters beyond ASCII are the last class.
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "blank": " \t\n\x0b\x0c\r",
    "point": ".,", "mark": "!?;:", "symbol": "#*$%&|<>",
}
_BLANK, _SYMBOL = list(CLASSES).index("blank"), list(CLASSES).index("symbol")


def _class_of_bytes() -> np.ndarray:
    """Class of each byte of UTF-8: the named ones, other ASCII, beyond ASCII (first bytes), none (bytes that continue)."""
    named = list(CLASSES.values())
    out = np.full(256, len(named))
    for i, letters in enumerate(named):
        out[[ord(c) for c in letters]] = i
    out[128:192], out[192:] = len(named) + 2, len(named) + 1
    return out


_CLASS = _class_of_bytes()
BINS = len(CLASSES) + 2


@dataclass
class Counts:
    """What the rules need of one text. Words are bytes: blanks are all ASCII, so splitting UTF-8 is splitting the text."""

    words: list[bytes]
    classes: np.ndarray
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @classmethod
    def of(cls, text: str) -> Counts:
        data = text.encode("utf-8", "replace")
        by_byte = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
        classes = np.bincount(_CLASS, weights=by_byte, minlength=BINS + 1)[:BINS].astype(np.int64)
        words = data.split()  # at the six ASCII blanks, as WORD has them
        lines = [x for x in data.split(b"\n") if x.strip()]
        return cls(words, classes, len(text) - int(classes[_BLANK]), int(classes[_SYMBOL]), len(lines) - len(set(lines)), repeated(words))

    def base(self) -> tuple[int, int, int, int, int]:
        return len(self.words), self.word_chars, self.n_symbols, self.n_dup_lines, self.n_repeat_words

    def failed(self) -> bool:
        """The plain rules."""
        return len(self.words) < MIN_WORDS or 100 * self.n_repeat_words > 50 * len(self.words)


def repeated(words: list[bytes]) -> int:
    """Words in windows of three words that occur twice or more.

    Hashes tell at once whether any window may occur twice; only then windows are compared.
    """
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    h = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + (h[1:-1] ^ h[1:-1] >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + h[2:]
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    times, covered, upto = Counter(windows), 0, 0  # words before ``upto`` are counted
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + 3 - max(at, upto)
            upto = at + 3
    return covered


def limit(part: tuple[float, float], n_words: int) -> float:
    """The largest distance of a text of so many words."""
    return float(np.sqrt(part[0] + part[1] / n_words))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts."""
    p, q = p / max(1, p.sum()), q / max(1, q.sum())
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / middle), 0) + np.where(q > 0, q * np.log2(q / middle), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def _language(lang: str):
    return F.coalesce(F.col(lang).cast("string"), F.lit("und"))


def references(docs: DataFrame) -> DataFrame:
    """``lang`` and its ``reference``, as text: documents, class shares, common words, their shares and that of the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by_worker(("divergence",))
        docs_of, classes_of = Counter(), defaultdict(lambda: np.zeros(BINS, dtype=np.int64))
        words_of: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        held = 0

        def told() -> Iterator[pd.DataFrame]:
            rows = [(lang, 0, "", n) for lang, n in docs_of.items()]
            rows += [(lang, 1, str(i), n) for lang, shares in classes_of.items() for i, n in enumerate(shares.tolist())]
            yield pd.DataFrame(rows, columns=["lang", "kind", "key", "n"])
            for lang, words in words_of.items():
                yield pd.DataFrame({"lang": lang, "kind": 2, "key": [w.decode() for w in words], "n": list(words.values())})

        for batch in batches:
            for lang, text in zip(batch["_lang"], batch["_text"], strict=True):
                counts = Counts.of(text)
                if counts.failed():
                    continue
                docs_of[lang] += 1
                classes_of[lang] += counts.classes * UNIT // counts.classes.sum()
                n_words, words = len(counts.words), words_of[lang]
                held -= len(words)
                for word, n in Counter(counts.words).items():
                    words[word] += n * UNIT // n_words
                held += len(words)
                if held > WORDS_HELD:
                    yield from told()
                    docs_of.clear(), classes_of.clear(), words_of.clear()
                    held = 0
        yield from told()

    rows = whole_texts(docs, _language("lang").alias("_lang"), text_of().alias("_text"))
    sums = stored(rows.mapInPandas(run, "lang string, kind int, key string, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "divergence-sums")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    words = sums.filter("kind = 2").withColumn("place", place).filter(F.col("place") <= COMMON)
    listed = F.sort_array(F.collect_list(F.struct("place", "key", "n")))  # COMMON entries at most
    common = words.groupBy("lang").agg(listed.alias("common"))
    classes = F.array(*[F.sum(F.when((F.col("kind") == 1) & (F.col("key") == str(i)), F.col("n"))) for i in range(BINS)])
    whole = sums.groupBy("lang").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("docs"), classes.alias("classes"), F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("words"),
    )
    reference = F.to_json(F.struct(
        "docs", "classes", F.col("common.key").alias("common"), F.col("common.n").alias("shares"),
        (F.col("words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x["n"])).alias("others"),
    ))
    return whole.join(common, "lang").select("lang", reference.alias("reference"))


@lru_cache(maxsize=256)
def _parsed(reference: str) -> tuple[np.ndarray, dict[bytes, int], np.ndarray] | None:
    known = json.loads(reference)
    if known["docs"] < MIN_DOCUMENTS:
        return None
    shares = np.array([*known["shares"], known["others"]], dtype=float)
    return np.array(known["classes"], dtype=float), {w.encode(): i for i, w in enumerate(known["common"])}, shares


def distances(counts: Counts, reference: str) -> tuple[float, float] | None:
    """(of the class histogram, of the word histogram) to a reference; None if it has too few documents."""
    known = _parsed(reference)
    if known is None:
        return None
    classes, common, shares = known
    own = np.zeros(len(shares))
    for word, n in Counter(filter(common.__contains__, counts.words)).items():
        own[common[word]] = n
    own[-1] = len(counts.words) - own.sum()
    return distance(counts.classes.astype(float), classes), distance(own, shares)


_JUDGED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean"


def _judge(texts: pd.Series, references: pd.Series) -> pd.DataFrame:
    kept_by_worker(("divergence",))
    rows = []
    for text, reference in zip(texts, references, strict=True):
        counts = Counts.of(text)
        failed, n = counts.failed(), len(counts.words)
        away = None if failed or reference is None else distances(counts, reference)
        kept = not failed and (away is None or (away[0] <= limit(CLASS_LIMIT, n) and away[1] <= limit(WORD_LIMIT, n)))
        rows.append((*counts.base(), failed, *(away or (None, None)), kept))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _JUDGED.split(", ")])


def _with_verdict(docs: DataFrame, verdict: str) -> DataFrame:
    lang, reference = fresh(docs, "lang_", "reference_")
    known = references(docs).select(F.col("lang").alias(lang), F.col("reference").alias(reference))
    rows = whole_texts(docs, "*", _language("lang").alias(lang))
    joined = small_join(rows, stored(known, "divergence-references"), [lang], BROADCAST_LANGUAGES, "left")
    return joined.withColumn(verdict, F.pandas_udf(_judge, _JUDGED)(text_of(), F.col(reference))).drop(lang, reference)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of its text, ``base_failed``, both distances (null if not compared) and ``kept``."""
    (verdict,) = fresh(docs, "verdict")
    return _with_verdict(docs, verdict).select("doc_id", f"{verdict}.*")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that are kept, their columns unchanged."""
    (verdict,) = fresh(docs, "verdict")
    return _with_verdict(docs, verdict).filter(F.col(f"{verdict}.kept")).select(*docs.columns)


def _sql() -> str:
    def count(letters: str) -> str:
        quoted = "".join(f"\\x{ord(c):02X}" for c in letters)
        return f"length(text) - length(regexp_replace(text, '[{quoted}]', '', 'g'))"

    named = [count(c) for c in CLASSES.values()]
    beyond = "length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))"

    def away(p: str, q: str) -> str:
        pairs = f"list_zip(list_transform({p}, lambda x: x / list_sum({p})), list_transform({q}, lambda x: x / list_sum({q})))"
        half = "CASE WHEN x[{0}] > 0 THEN x[{0}] * log2(2 * x[{0}] / (x[1] + x[2])) ELSE 0 END"
        return f"sqrt(greatest(0, list_sum(list_transform({pairs}, lambda x: {half.format(1)} + {half.format(2)})) / 2))"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words, [{", ".join(named)}] AS named, {beyond} AS beyond FROM d),
c AS (SELECT *, list_append(list_append(named, length(text) - beyond - list_sum(named)), beyond) AS classes FROM s),
w AS (SELECT rid, lang, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM c),
t AS (SELECT rid, pos, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
r AS (SELECT rid, pos FROM t WHERE third IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, word, second, third) > 1),
n AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS p FROM r) GROUP BY rid),
l AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}') GROUP BY rid),
b AS (SELECT c.rid, doc_id, lang, classes, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  classes[{list(CLASSES).index("symbol") + 1}]::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM c LEFT JOIN l USING (rid) LEFT JOIN n USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
k AS (SELECT lang, i, sum(classes[i]::BIGINT * {UNIT} // list_sum(classes)::BIGINT) AS n FROM f, range(1, {BINS + 1}) AS z(i) WHERE NOT base_failed GROUP BY ALL),
kl AS (SELECT lang, list(n::DOUBLE ORDER BY i) AS class_shares FROM k GROUP BY lang),
dw AS (SELECT rid, lang, word, count(*) AS n FROM w GROUP BY ALL),
v AS (SELECT dw.lang, word, sum(n * {UNIT} // n_words) AS n FROM dw JOIN f USING (rid) WHERE NOT base_failed GROUP BY ALL),
vt AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, encode(word)) AS place, sum(n) OVER (PARTITION BY lang) AS total FROM v),
vl AS (SELECT lang, list(word ORDER BY place) AS common, list_append(list(n::DOUBLE ORDER BY place), (max(total) - sum(n))::DOUBLE) AS word_shares
  FROM vt WHERE place <= {COMMON} GROUP BY lang),
ref AS (SELECT * FROM kl JOIN vl USING (lang) JOIN (SELECT lang, count(*) AS docs FROM f WHERE NOT base_failed GROUP BY lang) USING (lang) WHERE docs >= {MIN_DOCUMENTS}),
o AS (SELECT q.rid, list(coalesce(dw.n, 0)::DOUBLE ORDER BY place) AS counts
  FROM (SELECT rid, place, word FROM f JOIN vt USING (lang) WHERE place <= {COMMON} AND NOT base_failed) AS q LEFT JOIN dw ON dw.rid = q.rid AND dw.word = q.word GROUP BY q.rid),
m AS (SELECT f.*, ref.lang AS known, class_shares, word_shares, list_append(counts, n_words - list_sum(counts)) AS counts
  FROM f LEFT JOIN ref USING (lang) LEFT JOIN o USING (rid)),
x AS (SELECT *, CASE WHEN known IS NOT NULL AND NOT base_failed THEN {away("list_transform(classes, lambda y: y::DOUBLE)", "class_shares")} END AS class_distance,
  CASE WHEN known IS NOT NULL AND NOT base_failed THEN {away("counts", "word_shares")} END AS word_distance FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(class_distance <= sqrt({CLASS_LIMIT[0]} + {CLASS_LIMIT[1]} / n_words), true)
  AND coalesce(word_distance <= sqrt({WORD_LIMIT[0]} + {WORD_LIMIT[1]} / n_words), true) AS kept FROM x
"""


#: The same rules in DuckDB's SQL.
ORACLE_SQL = _sql()
