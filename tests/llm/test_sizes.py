"""Bounds on work, memory and disk of the training-data operators."""

import random

import numpy as np
import pyarrow as pa

from playlens.llm import idcoder, line_dedup, packing
from playlens.llm.alignment import Pair
from playlens.llm.tokens import CutTokenizer, default_path, tokenizer_file


def _library(texts):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(default_path())
    return [fresh.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_are_encoded_once_from_slices_of_columns(monkeypatch):
    draw = random.Random(5)
    words = ["alpha", "béta", "gamma.", "delta,", "it's", "x1", "日本", "a\tb", "<|endoftext|>", "end)."]
    texts = [" ".join(draw.choices(words, k=30)) for _ in range(60)] + [None, "", "two  spaces", " lead", "trail "]
    column = pa.array(texts, pa.string())
    tok = CutTokenizer(default_path())
    asked = []
    monkeypatch.setattr(tok, "ids", lambda cuts, ids=tok.ids: asked.extend(cuts.to_pylist()) or ids(cuts))
    got = [x for a in range(0, len(texts), 10) for x in tok.encode(column.slice(a, 10))]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == _library(texts)
    assert len(asked) == len(set(asked)) and " gamma" in asked and " gamma." not in asked


def test_known_words_stay_within_their_limit():
    tok = CutTokenizer(default_path(), cache=40)
    for i in range(20):
        texts = [" ".join(f"w{i}x{j}" for j in range(30)), "y" * 500]
        assert [np.frombuffer(x, "<u4").tolist() for x in tok.encode(texts)] == _library(texts)
        assert len(tok.known) <= 40


def test_alignment_of_a_word_is_made_once(monkeypatch):
    pair = Pair(default_path(), tokenizer_file("piece_bpe_32k.model"))
    asked = []
    monkeypatch.setattr(pair, "words", lambda parts, words=pair.words: asked.extend(parts.to_pylist()) or words(parts))
    texts = ["one two, one two,", "two, three", None, "one  a\0b"]
    first = pair.align(texts)
    again = pair.align(texts[:2])
    assert again["groups"].to_pylist() == first["groups"].to_pylist()[:2] and asked.count("one") == 1
    assert first["n_groups"].sum() == len(first["cuts"])


def test_blocks_are_dealt_to_few_lanes():
    for n in (0, 1, idcoder.LANES, idcoder.LANES + 1, 1640, 3999):
        runs = idcoder.turns(n)
        sizes = [b - a for a, b in runs]
        assert sum(sizes) == n and max(sizes, default=0) <= idcoder.LANES and max(sizes, default=0) - min(sizes, default=0) <= 1
    assert idcoder._Model(1, 16).tree.nbytes * idcoder.LANES < 130e6


def test_lines_of_two_are_compared_once(spark, monkeypatch):
    draw = random.Random(9)
    lines = []
    for _ in range(150):  # similar, but too little for a link
        line = "".join(draw.choices("abcdefgh ", k=80)).strip()
        lines += [line, line[:40] + "".join(draw.choices("klmnop", k=6)) + line[46:]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    written = {}

    def keep(frame, name="stage", write=line_dedup.materialize):
        out = write(frame, name)
        written.setdefault(name, []).append([tuple(r) for r in out.collect()] if name in ("stars", "pairs") else None)
        return out

    monkeypatch.setattr(line_dedup, "materialize", keep)
    out = line_dedup.dedup_lines(df).count()
    assert out == len(lines) and "hubs" not in written  # texts travel, not sets
    stars = set(written["stars"][0])
    assert stars and not stars & set(written["pairs"][0])


def test_unlike_lines_of_a_band_meet_few_rounds(spark, monkeypatch):
    draw = random.Random(11)
    common = "".join(draw.choices("abcdefgh ", k=60)).strip()
    lines = [common + " " + "".join(draw.choices("klmnopqrst", k=40)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    written = []

    def keep(frame, name="stage", write=line_dedup.materialize):
        out = write(frame, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(line_dedup, "materialize", keep)
    assert line_dedup.dedup_lines(df).where("lines_removed = 0").count() == len(lines)
    names = [n for n, _ in written]
    # small bands meet no more rounds, and no text is fetched for pairs that the marks rule out
    assert names.count("links") == 2 and sum(n for name, n in written if name == "able") == 0 < dict(written)["stars"]


def test_more_marks_allow_every_link(spark):
    draw = random.Random(12)
    sets = [[draw.randrange(-2**31, 2**31) for _ in range(400)] for _ in range(20)]
    sets += [s[:370] + [draw.randrange(-2**31, 2**31) for _ in range(20)] for s in sets]
    df = spark.createDataFrame(list(enumerate(sets)), "key long, set array<int>")
    marks = line_dedup._more_marks(df)
    a = line_dedup._side(marks, "a", marks["key"].alias("a"), words=line_dedup.MORE)
    b = line_dedup._side(marks, "b", marks["key"].alias("b"), words=line_dedup.MORE)
    got = {(r["a"], r["b"]) for r in a.join(b, a["a"] < b["b"]).where(line_dedup._possible(0.8, line_dedup.MORE)).collect()}
    assert got == {(i, i + 20) for i in range(20)}


def test_marks_add_few_statements_to_a_plan(spark):
    row = {"band": 1, "key": 2, "comp": 3, "top": 4, "last": 5, **{f"w{i}": i for i in range(10)}}
    for side in line_dedup._against(spark.createDataFrame([row]), 10):
        known = side._jdf.queryExecution().analyzed().validConstraints().size()
        assert known < 60  # not twice as many for each word


def test_ids_of_pieces_travel_in_16_bits(spark, monkeypatch):
    texts = ["one two three " * 40, None, "", "日本 x" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = []
    monkeypatch.setattr(packing, "materialize", lambda f, name, write=packing.materialize: kept.append(write(f, name)) or kept[-1])
    got = packing.pack_documents(df, default_path(), capacity=64, end_id=0, with_ids=True).collect()
    assert all(len(r["ids"]) == 2 * r["length"] for r in kept[0].collect())
    for i, ids in enumerate(_library(texts)):
        mine = sorted((r["start"], bytes(r["ids"])) for r in got if r["doc_id"] == i)
        assert np.frombuffer(b"".join(x for _, x in mine), "<u4").tolist() == [*ids, 0]
