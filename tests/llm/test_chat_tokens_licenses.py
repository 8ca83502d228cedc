"""Chat formatting, token store and licence scan."""

import hashlib
import json
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from subjectflow.llm import chat, licenses, tokens
from subjectflow.llm.common import scratch

from .conftest import CLASHING

FILE = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------- chat
@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "\\", "</s>", "[INST]", "<<SYS>>", "s>", "|end|>", "<|", "a", "[/", "INST]", "<|end|>", "\n", "é"]), max_size=9).map("".join))
def test_escaping_is_exact(text):
    coded = chat.escape(text)
    assert chat.unescape(coded) == text and not any(c in coded for c in chat.CONTROL)


def test_conversations_come_back(spark):
    rows = [(1, 0, "user", "</s>[INST] ok \\"), (1, 1, "assistant", "<|end|>fine"), (1, 2, "assistant", None), (2, None, None, "x" * 50), (None, 0, "assistant", "é<s>"), (1, 1, "assistant", "<|end|>fine")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, piece int")
    for size in (10, chat.PIECE):  # pieces smaller than a turn, and whole conversations
        got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df, piece=size)).collect()}
        one = "user\n</s>[INST] ok \\\n" + "assistant\n<|end|>fine\n" * 2 + "assistant\n\n"
        assert got[1].turns_sha256 == hashlib.sha256(one.encode()).hexdigest() and got[1].n_turns == 4
        assert got[1].loss_sha256 == hashlib.sha256(b"<|end|>fine<|end|>fine").hexdigest() and got[1].loss_chars == 22
        assert got[None].loss_chars == 4 and got[2].loss_chars == 0
    assert chat.format_conversations(df.filter("conv_id = 99")).count() == 0


def test_typed_parts(spark):
    part = lambda **k: {n: k.get(n) for n in ("type", "text", "ref", "width", "height", "seconds", "pages")}
    turns = [(5, 0, "user", [part(type="text", text="see <|image|>"), part(type="image", ref="a.png", width=56, height=29), part(type="audio", ref="b.wav", seconds=1.5)]),
             (5, 1, "assistant", [part(type="text", text="ok "), part(type="document", ref="c.pdf", pages=2)]), (5, 2, "user", None)]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_conversations(df).first()
    assert [(a.kind, a.ref, a.number, a.tokens) for a in row.attachments] == [("image", "a.png", 0, 4), ("audio", "b.wav", 1, 38), ("document", "c.pdf", 2, 512)]
    assert all(row.formatted[a["at"] :].startswith(chat.PLACEHOLDERS[a.kind]) for a in row.attachments) and row.expanded_tokens == 554
    contents = [chat.parts_of(c) for _, c, _ in chat.turns_of(row.formatted)]
    assert contents == [[("text", "see <|image|>"), ("image", ""), ("audio", "")], [("text", "ok "), ("document", "")], []]
    bad = spark.createDataFrame([(1, 0, "user", [part(type="video")])], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    with pytest.raises(Exception, match="unknown kind of part"):
        chat.format_conversations(bad).collect()


# ------------------------------------------------------------------- token store
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aab  \n\t'sthe rein.,!0123 éß中😀\x1c²\xa0", max_size=30), max_size=5))
def test_texts_encode_like_the_library(texts):
    coder, library = ENCODER
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(packed, coder.kind).tolist() == library.encode(text, add_special_tokens=False).ids + [2]


ENCODER = (tokens.TextEncoder(open(FILE, encoding="utf-8").read(), 2), Tokenizer.from_file(FILE))


def like_the_library(coder, texts):
    found = [np.frombuffer(x, coder.kind).tolist() for x in coder.encode(pa.array(texts, pa.string()))]
    return found == [coder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_equal_words_are_encoded_once():
    coder = tokens.TextEncoder(open(FILE, encoding="utf-8").read(), 2)
    texts = [f"The river{a} (lehrt){b} über{a}\nRiver{b} x2{a}" for a in ("", ".", "!", "%%%", "?)", "';-") for b in (",", "$$$", ":", "]")]
    assert like_the_library(coder, texts)
    assert set(coder.words) == {"river", "(lehrt", "über", "\nRiver", "x2"}
    texts += ["", "one", "one.", " river", "river  river.", "a\n\nriver!", "<|endoftext|>. a<|endoftext|>! |.", "river_ river|"]
    assert like_the_library(coder, texts) and like_the_library(coder, ["one", ""]) and coder.encode([]) == []
    assert "one" not in coder.words


def test_texts_with_other_blanks_are_cut_at_clean_ones():
    coder = tokens.TextEncoder(open(FILE, encoding="utf-8").read(), 2)
    texts = ["  The sea is.\n\nA hill is!\nOld  sea.\t", "One\r\nold sea\n", "no blank", "\n", "a\x1c b\xa0 c d", "\n\nb"]
    assert like_the_library(coder, texts) and like_the_library(coder, texts[::-1])
    assert {"sea", "is.\n\nA", "hill", "is", "\nOld  sea.\t", "sea\n", "blank"} <= set(coder.words)


def test_added_tokens_of_letters_and_marks():
    definition = json.loads(open(FILE, encoding="utf-8").read())
    one = definition["added_tokens"][0]
    definition["added_tokens"] += [one | {"id": 50257 + i, "content": t, "special": False, "single_word": t == "hill"} for i, t in enumerate(("river", "l!", "hill"))]
    texts = ["a river rivers. the hill! hills, hill. hill_ hill", "still! river! l! all!? \nriver.\nhill:"]
    assert like_the_library(tokens.TextEncoder(json.dumps(definition), 2), texts)


def test_pieces_end_where_words_are_cut():
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]):
        if c.isalnum():
            assert len(cut(c + "!")) == 2
        if c.isalpha():
            assert len(cut(f" a{c}a")) == 1


def test_portions_keep_all_rows(monkeypatch):
    monkeypatch.setattr(tokens, "TEXT_BYTES", 10)
    texts = ["", "four", "fours", "x" * 30, "", "1", "é" * 5, "22", "x" * 11]
    for size in (1, 2, 4, 9):
        batches = [pa.RecordBatch.from_arrays([pa.array(range(at, min(at + size, 9))), pa.array(texts[at : at + size])], ["doc_id", "_text"]) for at in range(0, 9, size)]
        got = list(tokens._portions(iter([batches[0].slice(0, 0), *batches])))
        assert [i for ids, _ in got for i in ids] == list(range(9)) and [t for _, part in got for t in part.to_pylist()] == texts
        assert len(got) > 2 and all(len(ids) == len(part) for ids, part in got)
    assert list(tokens._portions(iter([]))) == []


def test_perfect_hash():
    draw = np.random.default_rng(1)
    ids = np.unique(draw.integers(-(2**62), 2**62, 5000))
    again = np.concatenate([ids, ids[:50]])
    occurrences = np.concatenate([np.zeros(len(ids)), np.ones(50)]).astype(int)
    bits, sizes, slots = tokens.perfect_hash(again, occurrences)
    assert sorted(slots) == list(range(len(again)))
    assert (tokens.find(bits, sizes, again, occurrences) == slots).all()


def test_store(spark, docs):
    rows = [(9, "some words here"), (2, None), (None, "null id"), (5, ""), (2, "again"), (7, "long " * 3000)]
    df, path = docs(rows, CLASHING), scratch(spark, "test-store")
    tokens.write_store(df, path, FILE)
    got = sorted(map(tuple, tokens.digests(df, path).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    start, want = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ENCODER[1].encode(text or "", add_special_tokens=False).ids + [2]
        want.append((start, key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    keys = spark.createDataFrame([(9, 0), (2, 1), (404, 0), (None, 0), (9, 1)], "doc_id long, occurrence long")
    read = {(r.doc_id, r.occurrence): r.ids for r in tokens.read_documents(spark, path, keys).collect()}
    assert set(read) == {(9, 0), (2, 1), (None, 0)}
    assert read[9, 0] == ENCODER[1].encode("some words here", add_special_tokens=False).ids + [2]
    many, path = docs([(i, f"text {i}") for i in range(300)]), scratch(spark, "test-store")
    tokens.write_store(many, path, FILE, bucket_keys=16)
    assert spark.read.parquet(f"{path}/index").count() > 10 and tokens.digests(many, path).count() == 300
    empty = scratch(spark, "test-store")
    tokens.write_store(docs([]), empty, FILE)
    assert tokens.digests(docs([]), empty).count() == 0


# ------------------------------------------------------------------- licences
def test_license_scan(spark, docs):
    notices = {10: "Released under the MIT License.", 11: "This work is licensed under the GNU General Public License, version 3.", 12: "All rights reserved.", 13: "Licensed under CC BY-NC 4.0."}
    rows = [(i, f"Plain prose number {i} about a river and the hills.\nIt goes on here.") for i in range(10)]
    rows += [(i, f"Words before.\n{t}\nWords after.") for i, t in notices.items()] + [(10, notices[10])]
    rows += [(20, None), (21, ""), (None, notices[11]), (22, "The driver must renew the license every year."), (23, f"{notices[10]}\n{notices[13]}")]
    got = licenses.report(docs(rows, CLASHING)).collect()
    assert len(got) == len(rows)
    want = {10: "MIT", 11: "GPL", 12: "Proprietary", 13: "CC-BY-NC", None: "GPL", 23: "CC-BY-NC,MIT"}
    assert all(r.families == want.get(r.doc_id) for r in got)
    plan = licenses.report(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    assert licenses.report(docs([])).count() == 0


def test_wrapped_notices_and_two_families_in_a_line(spark, docs):
    mit = 'MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell'
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
    two = "Licensed under the MIT license or the Apache License, Version 2.0."
    plain = [(i, f"Plain prose number {i} about a river and the hills.\nIt goes on here.") for i in range(10)]
    rows = [*plain, (20, mit), (21, bsd), (22, gpl), (23, two), (24, "A library was released\nunder the general public eye.")]
    got = {r.doc_id: (r.families, r.notices) for r in licenses.report(docs(rows)).collect()}
    assert {i: got[i][0] for i in range(20, 25)} == {20: "MIT", 21: "BSD", 22: "GPL", 23: "Apache-2.0,MIT", 24: None}
    assert [got[i][1] for i in range(20, 24)] == [1, 1, 1, 1] and not any(got[i][0] for i in range(10))


def test_anchors_are_in_every_confirmable_paragraph(spark):
    import re

    pattern = re.compile("|".join(rf"\b{re.escape(w)}\b" for w in re.search(r"\(\?:(.*)\)\(\?!", licenses.anchors(spark))[1].replace("\\", "").split("|")))
    draw = np.random.default_rng(4)
    for row in licenses.templates(spark).collect():
        need = int(np.ceil(len(row.words) * licenses.CONTAINED - 1e-9))
        for _ in range(30):
            assert pattern.search(" ".join(draw.permutation(row.words)[:need]))


def test_only_units_that_a_template_may_confirm_go_on(spark, docs):
    prose = [(i, f"Under this public domain number {i} a version of the hills.\nAll of this in plain\nprose.") for i in range(40)]
    gpl = "Words before\nThis work is licensed under the GNU General\nPublic License, version 3."
    rows = [*prose, (50, "All rights\nreserved."), (51, gpl), (52, "One line: all rights reserved.\n\nThis."), (53, None)]
    got = licenses.units(docs(rows)).collect()
    assert {r.doc_id for r in got} == {50, 51, 52}
    known = [(set(r.words), len(r.words) <= 12) for r in licenses.templates(spark).select("words").collect()]
    for r in got:
        fit = [t for t, short in known if r.window in (0, 24 if short else 96)]
        assert any(len(t & set(r.words)) / len(t) >= licenses.CONTAINED for t in fit)
    assert {(r.doc_id, r.line, r.window) for r in got if r.doc_id == 52} == {(52, 1, 0)}
