"""op11 to op13 against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from playlens.llm import fingerprints as fp
from playlens.llm import phrases as ph
from playlens.llm.alignment import Pair, align_corpus, align_texts, divide
from playlens.llm.common import heavy_lookup
from playlens.llm.tokens import default_path, tokenizer_file
from tests.conftest import SF_SMALL, rows

ODD = [None, "", " ", "a  b", "▁x", "hello   world\n\nthis is <|endoftext|> x <s>", "ﬁ ① 漢字かな交じり文 日本", "a　b",
       "tail ", "\n lead", "x" * 3000, "né à l’été, “ok”…", "é \x00 <0x41> <unk>", "🙂🙂 🙂 a", "\t\ta b"]


# ------------------------------------------------------------- op11

@pytest.fixture(scope="module")
def vocabularies():
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_path())
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))


def _brute_alignment(text, tok, sp):
    """Groups and links by set operations on the ends of both token lists."""
    if not text:
        return None
    letters = {**{chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
    rest = [b for b in range(256) if chr(b) not in letters]
    letters.update({chr(256 + i): b for i, b in enumerate(rest)})
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    ab = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
    bb = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(ab) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
        return None
    ends = [[sum(map(len, x[:0])) for x in ()], []]
    for k, x in enumerate((ab, bb)):
        at, out = 0, []
        for t in x:
            at += len(t)
            out.append(at)
        ends[k] = out
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups, links, i, j = [], [], 0, 0
    for c in cuts:
        i2, j2 = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
        groups.append((a[i:i2], b[j:j2]))
        links.append((a[i2 - 1], b[j2 - 1]))
        i, j = i2, j2
    return a, b, cuts, groups, links


def test_alignment_equals_brute_force(spark, vocabularies):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(120)
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)] + [(5, "twice"), (5, "twice"), (None, "no id")],
                                "doc_id long, text string")
    docs = docs.unionByName(odd).withColumn("n_a", F.lit("clash")).withColumn("row", F.lit(1)).cache()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    brute = [_brute_alignment(t, *vocabularies) for _, t in texts]
    counts = Counter(link for x in brute if x for link in x[4])
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    want = []
    for (d, _), x in zip(texts, brute):
        if x is None:
            want.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in x[3])
        want.append((d, len(x[0]), len(x[1]), len(x[3]), len(x[4]), sum(counts[k] == top[k[1]] for k in x[4]),
                     sum(counts[k] for k in x[4]), hashlib.sha256(said.encode()).hexdigest()))
    args = (default_path(), tokenizer_file("piece_bpe_32k.model"))
    got = align_corpus(docs, *args)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == sorted(want, key=repr)
    assert align_corpus(docs.limit(0), *args).count() == 0
    # the operator's own output: groups and shared cuts; clashing columns stay
    one = align_texts(docs.where("doc_id = -12"), *args).first()
    x = _brute_alignment(ODD[11], *vocabularies)
    assert one["n_a"] == "clash" and one["n_a_"] == len(x[0]) and list(one["cuts"]) == x[2] and one["groups"].count(";") == len(x[3]) - 1


def test_divide_finds_every_shared_cut():
    import numpy as np

    r = random.Random(3)
    for _ in range(300):
        n = r.randint(1, 400)
        ea = sorted(r.sample(range(1, 1000), min(n, 900))) + [1000]
        keep = r.choice([0.0, 0.02, 0.5, 1.0])
        eb = sorted({x for x in ea if r.random() < keep} | set(r.sample(range(1, 1000), r.randint(0, 300)))) + [1000]
        lo, hi, lob, hib = divide(np.array(ea), np.array(eb), [0], [len(ea)], [0], [len(eb)])
        assert [ea[i - 1] for i in hi] == sorted(set(ea) & set(eb)) == [eb[i - 1] for i in hib]
        assert lo.tolist() == [0, *hi[:-1].tolist()] and lob.tolist() == [0, *hib[:-1].tolist()]


def test_lookup_splits_hot_keys(spark):
    right = spark.range(200_000).select(F.col("id").alias("k"), F.when(F.col("id") < 3, 1_000_000).otherwise(1).cast("long").alias("w"))
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") * 10).cast("long").alias("k"), "id")
    got = heavy_lookup(left, right, ["k"], "w")
    assert rows(got.select("k", "id", "w")) == rows(left.join(right, "k").select("k", "id", "w"))


def test_memory_of_pieces_is_bounded(monkeypatch):
    import playlens.llm.alignment as al

    pair = Pair(default_path(), tokenizer_file("piece_bpe_32k.model"))
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(40)]
    want = [x["groups"] for x in [pair.align([t]) for t in texts]]
    monkeypatch.setattr(al, "KNOWN", 60)
    small = Pair(default_path(), tokenizer_file("piece_bpe_32k.model"))
    assert [x["groups"] for x in [small.align([t]) for t in texts]] == want
    assert len(small.known) + len(small.older) <= 2 * (60 + 50)


# ------------------------------------------------------------- op12

def _brute_phrases(docs, least=10, share=50, top=2000):
    freq = defaultdict(Counter)
    total = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    freq[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, f in freq.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * b >= share * a for q, b in cand.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, le, ri) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, le, ri, total[lang], -s))
    return sorted(out, key=repr)


def _phrase_docs(n=400, seed=5):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(9)] + ["The", "the", "of", "ÄÖ", " x", "漢字"]
    docs = []
    for i in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", ": "]) for _ in range(r.randint(0, 60)))
        docs.append((i, r.choice(["en", "en", "de", None]), text))
    docs += [(900 + i, "en", "a a a a a b") for i in range(12)] + [(1000, "en", None), (None, "fr", "one two three"), (7, "en", "dup dup")]
    return docs


def test_phrases_equal_brute_force(spark):
    docs = _phrase_docs()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, lang string, text string, phrase string")
    want = _brute_phrases([d[1:] for d in docs])
    assert any(x[0] == "und" for x in want) and any(len(x[2].split()) == 3 for x in want)
    assert rows(ph.collocations(df)) == want
    few = ph.collocations(df, top=5, least=4, keep_share=90)
    assert rows(few) == _brute_phrases([d[1:] for d in docs], 4, 90, 5)
    assert ph.collocations(df.limit(0)).count() == 0


def test_failures_of_the_sample_are_mended(spark):
    """A sample that proposes nothing leaves all to the border and its expansions."""
    docs = spark.createDataFrame([d[1:] for d in _phrase_docs()], "lang string, text string").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), F.lit("").alias("salt"))
    whole = rows(ph.frequent_phrases(docs, 10, sample=1.0))
    for share, lowered in ((0.0, 1), (0.1, 1), (0.5, 40)):
        assert rows(ph.frequent_phrases(docs, 10, sample=share, lowered=lowered)) == whole


def test_score_is_exact_beyond_64_bits(spark):
    freq = [("en", 0, "", 10**12), ("en", 1, "a", 10**11), ("en", 1, "b", 10**11 + 7), ("en", 2, "a b", 10**11 - 3)]
    want = 1000000 * (10**11 - 3) ** 2 // (10**11 * (10**11 + 7))
    saved = ph.frequent_phrases
    try:
        ph.frequent_phrases = lambda docs, least: spark.createDataFrame(freq, "lang string, k int, phrase string, f long")
        got = ph.collocations(spark.createDataFrame([(1, "en", "")], "doc_id long, lang string, text string")).first()
    finally:
        ph.frequent_phrases = saved
    assert (got.score, got.l, got.r, got.a) == (want, 10**11, 10**11 + 7, 10**11 - 3)


# ------------------------------------------------------------- op13

def _shingles(t, w=fp.WIDTH):
    return {t[i:i + w] for i in range(len(t) - w + 1)} if len(t) >= w else ({t} if t else set())


def _fingerprint_docs():
    r = random.Random(11)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))
    docs = [(i * 3, prose(r.randint(1, 900))) for i in range(60)]
    docs += [(1000, docs[5][1]), (1001, ""), (1002, None), (1003, "short"), (1004, "ab" * 9000), (1005, "🙂漢字" * 700),
             (1006, prose(60) * 50), (-5, "first of all, " + prose(30)), (None, "no id " + prose(20))]
    return docs


def test_fingerprints_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_BYTES", 20_000)  # several ranges
    docs = _fingerprint_docs()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, sketch string").repartition(5)
    got = {r.doc_id: r for r in fp.fingerprint_documents(df).collect()}
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0))
    errors = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for a, b, near in ((t, edited, r.near_edited), (t, after, r.near_next)):
            a, b = _shingles(a), _shingles(b)
            true = len(a & b) / len(a | b) if a | b else 1.0
            errors.append(abs(true - near))
            assert 0 <= near <= 1
            if len(a | b) <= fp.K:
                assert near == pytest.approx(true)
        a, b = _shingles(t), _shingles(edited)
        assert r.contained_in_edited == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=0.25)
        assert r.n_shingles == pytest.approx(len(a), rel=0.35) and (len(a) >= fp.K or r.n_shingles == len(a))
        assert len(r.fingerprint) == 16 * min(fp.K, len(a))
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.04
    assert got[1000].fingerprint == got[15].fingerprint  # equal texts
    assert fp.fingerprint_documents(df.limit(0)).count() == 0
    one = fp.fingerprint_documents(df.where("doc_id = 15")).first()
    assert one.near_next == 1.0 and one.near_edited <= 1.0


def test_rows_of_one_id_follow_each_other(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c")], "doc_id long, text string")
    assert rows(fp.with_next(df, "doc_id", "text").select("doc_id", "text", "next_text")) == [
        (1, "a", "a"), (1, "a", "b"), (1, "b", "c"), (2, "c", "a")]


def test_sketches_merge(spark):
    text = _fingerprint_docs()[66][1] + _fingerprint_docs()[3][1]
    cut = len(text) // 3
    parts = spark.createDataFrame([(1, text[:cut + fp.WIDTH - 1]), (1, text[cut:]), (1, text[cut:]), (2, ""), (None, None)],
                                  "k int, t string").withColumn("s", fp.sketch(F.col("t")))
    got = {r.k: list(r.sketch) for r in fp.merge_parts(parts, "k", "s").collect()}
    whole = spark.createDataFrame([(text,)], "t string").select(fp.sketch(F.col("t"))).first()[0]
    assert got[1] == list(whole) and got[2] == [] and got[None] == []
