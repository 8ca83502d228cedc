"""ProbMinHash near copies against brute force."""

import numpy as np

from subjectflow.llm import neardup
from subjectflow.llm.common import table

from .conftest import CLASHING


def brute(texts):
    """Class (smallest id) of each id, comparing all pairs that share a run."""
    runs = {i: neardup.runs(t or "") for i, t in texts.items()}
    where = {}
    for i, (u, _) in runs.items():
        for x in u.tolist():
            where.setdefault(x, []).append(i)
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in {(a, b) for v in where.values() for n, a in enumerate(v) for b in v[n + 1 :]}:
        if neardup.similarity(runs[a], runs[b]) >= neardup.SIMILAR:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in texts}


def words(n, seed):
    draw = np.random.default_rng(seed)
    return [f"w{x}" for x in draw.integers(0, 10**9, n)]


def test_registers_agree_as_often_as_the_similarity_says():
    off = []
    for seed in range(40):
        a = words(300, seed)
        b = [w if i % 20 else "x" + w for i, w in enumerate(a)]
        x, y = neardup.runs(" ".join(a + a[:80])), neardup.runs(" ".join(b + b[:40]))
        s = neardup.signatures([x, y])
        off.append((s[0] == s[1]).mean() - neardup.similarity(x, y))
    assert abs(np.mean(off)) < 0.02


def test_similarity_by_definition():
    draw = np.random.default_rng(5)
    for _ in range(30):
        a, b = (dict(zip(draw.choice(12, 8, replace=False).tolist(), draw.integers(1, 5, 8).tolist(), strict=True)) for _ in range(2))
        want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
        as_arrays = [(np.array(sorted(d), dtype=np.uint64), np.array([d[k] for k in sorted(d)])) for d in (a, b)]
        assert abs(neardup.similarity(*as_arrays) - want) < 1e-12


def test_word_hashes_do_not_depend_on_place():
    h = neardup.word_hashes(np.frombuffer(b"  one two\tone\ntwo  three", dtype=np.uint8))
    assert h[0] == h[2] and h[1] == h[3] and len(set(h.tolist())) == 3


def test_classes_on_the_given_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r.class_id for r in neardup.report(docs).collect()}
    assert got == brute({r.doc_id: r.text for r in docs.collect()})


def test_large_group_chain_and_odd_rows(spark, docs):
    base = words(120, 1)
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :])) for i, k in enumerate(range(5, 105))]
    rows += [(200, "A b C"), (201, "a B c"), (202, None), (203, ""), (204, " \n"), (205, "same text of words"), (205, "same text of words"), (None, "same text of words")]
    rows += [(300 + i, " ".join(words(60, 50 + i) + base[:40])) for i in range(30)]
    got = neardup.report(docs(rows)).collect()
    want = brute({i: t for i, t in rows if i is not None and i != 205})
    found = {r.doc_id: r.class_id for r in got}
    assert len(got) == len(rows)
    assert {i: c for i, c in found.items() if i in want and i not in (200, 201)} == {i: c for i, c in want.items() if i not in (200, 201)}
    assert found[201] == 200 and found[205] == 205 and found[202] == 202 and found[204] == 204


def test_keep_one_of_each_group(spark, docs):
    rows = [(3, "x y z"), (1, "x y z"), (1, "x y z"), (None, "x y z"), (7, None), (8, ""), (9, "other words entirely here now")]
    df = docs(rows, CLASHING)
    kept = neardup.keep(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, "x y z"), (7, ""), (8, ""), (9, "other words entirely here now")]
    assert neardup.keep(docs([])).count() == 0 and neardup.report(docs([])).count() == 0


def test_star_of_copies_that_are_similar_to_the_original_only(spark, docs):
    original = words(304, 1)
    draw = np.random.default_rng(2)
    rows = [(10_000, " ".join(original))]
    for i in range(600):
        text = list(original)
        for k in draw.choice(np.arange(5, 299, 5), 5, replace=False):
            text[k] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    found = {r.doc_id: r.class_id for r in neardup.report(docs(rows)).collect()}
    assert found == brute(dict(rows))


def test_rest_of_a_bucket_finds_every_join_of_components():
    draw = np.random.default_rng(3)
    texts = []
    for g in range(12):
        base = words(60, g % 4)
        for _ in range(6):
            text = [w if draw.random() > 0.02 else f"z{draw.integers(10**9)}" for w in base]
            texts.append(" ".join(text + text[: g * 2]))
    items = [neardup._unpacked(neardup._packed(t)) for t in texts]
    every = np.arange(len(items))
    got = neardup.joining(items, every, every, list(range(len(items))), neardup.SIMILAR)
    assert all(neardup.similarity(items[a], items[b]) >= neardup.SIMILAR for a, b in got)
    want = brute(dict(enumerate(texts)))
    assert len(got) == len(items) - len(set(want.values()))
    assert all(want[a] == want[b] for a, b in got)
    assert not neardup.joining(items, every, every, [0] * len(items), neardup.SIMILAR)


def test_stars_join_what_the_links_join(spark):
    draw = np.random.default_rng(8)
    name = lambda kind, i: f"{kind}{i}".encode()
    links = [(name("h", h), name("m", m)) for m in range(400) for h in draw.choice(25, size=int(draw.integers(10, 25)), replace=False)]
    links += [(name("x", 1), name("m", 401)), (name("m", 401), name("m", 402)), (name("y", 1), name("y", 2))]
    rows = [(min(a, b), max(a, b), b) for a, b in links]
    stars = [(r.a, r.b) for r in neardup.starred(spark.createDataFrame(rows, "a binary, b binary, member binary")).collect()]

    def groups(pairs):
        top = {v: v for p in links for v in p}
        for _ in range(len(top)):
            before = dict(top)
            for a, b in pairs:
                top[a] = top[b] = min(top[a], top[b])
            if top == before:
                return {v: bytes(t) for v, t in top.items()}

    assert groups([(bytes(a), bytes(b)) for a, b in stars]) == groups(links)
    assert len(stars) <= 403 + 25 * 24 / 2 < len(links) / 4
