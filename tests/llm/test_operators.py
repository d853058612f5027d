"""Each operator against brute force on small fixtures, with nulls, empty
texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import idcoder, line_dedup, packing, simhash_dedup, toxicity
from playlens.llm.common import ship
from playlens.llm.decontaminate import mark_contamination
from playlens.llm.license_scan import scan_licenses
from playlens.llm.queries import ORACLE, QUERIES
from playlens.llm.sharding import shuffle_into_shards
from playlens.llm.tokens import CutTokenizer, default_path, tokenizer, vocabulary_size
from playlens.llm.vector_dedup import vector_dedup
from tests.conftest import SF_SMALL

rng = np.random.default_rng(5)
WORDS = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(400)]


def sentence(n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with copies, near copies, nulls, empties, a long one and names that clash."""
    ship(spark)
    base = [sentence(int(n)) for n in rng.integers(5, 120, 40)]
    texts = base + base[:6] + [b + " extra" for b in base[6:12]] + [None, "", " ", None, "\n\n", "É é<|endoftext|> x", sentence(9000)]
    texts[0] = texts[0] + "\n" + texts[1]
    rows = [(i, t, 0.5, "x", i % 3) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id", 0.1, "y", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, lines_removed string, c0 int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def union(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_tokens_equal_the_library(docs):
    from tokenizers import Tokenizer

    tok, fresh = tokenizer(default_path()), Tokenizer.from_file(default_path())
    odd = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "a  b \n c\td ", " lead", "trail  ", " ", "a\0b", "it's  \r\n ok", "日本 語 text", "<|endoftext|> a", "é ́x", "🙂 🙂"]
    texts = odd + [t for _, t in texts_of(docs) if t]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert [np.frombuffer(b, "<u4").tolist() for b in tok.encode(texts)] == want
    assert tok.encode([None, ""]) == [b"", b""]
    plain = tokenizer(default_path(), plain=True)
    fresh.encode_special_tokens = True
    assert np.frombuffer(plain.encode(odd[:1])[0], "<u4").tolist() == fresh.encode(odd[0], add_special_tokens=False).ids
    # a small memory changes nothing
    small = CutTokenizer(default_path(), cache=50)
    assert [small.encode([t])[0] for t in texts] == tok.encode(texts) and len(small.known) + len(small.older) < 50_000


def test_simhash(docs, none):
    import xxhash

    def brute(t):
        ws = (t or "").encode().lower().split()
        if not ws:
            return 0
        sh = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
        hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    rows = [r for r in texts_of(docs) if r[0] is not None]
    got = simhash_dedup.simhash_dedup(docs.where("doc_id IS NOT NULL"), shingle=4, max_bits=4).collect()
    fps = [brute(t) for _, t in rows]
    root = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4])
    low = {}
    for (i, _), r in zip(rows, root):
        low[r] = min(low.get(r, i), i)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted(
        (i, f"{fp:016x}", low[r]) for (i, _), fp, r in zip(rows, fps, root))
    assert simhash_dedup.simhash_dedup(none).count() == 0


def test_simhash_search_loses_no_link(spark):
    centre = [int(x) for x in rng.integers(-2**62, 2**62, 6)]
    fps = {c for c in centre}
    for c in centre:
        for _ in range(120):
            v = c
            for b in rng.choice(63, rng.integers(1, 8), replace=False):
                v ^= 1 << int(b)
            fps.add(v)
    fps = sorted(fps)
    got = simhash_dedup.fingerprint_components(spark.createDataFrame([(f,) for f in fps], "fp long"), 4)
    got = {r["fp"]: r["comp"] for r in got.collect()}
    links = [(i, j) for i in range(len(fps)) for j in range(i)
             if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= 4]
    assert [fps[r] for r in union(len(fps), links)] == [got[f] for f in fps]
    for m in (3, 4, 5):  # thresholds keep the generalised pigeonhole sum
        parts = simhash_dedup.group_bits(np.array(fps), m)
        assert sorted(b for p in parts for b in p) == list(range(64))
        assert sum(simhash_dedup.allocate(parts, np.full(64, 0.5), 10**6, 4)[1]) == 4 - m + 1


def test_line_dedup(spark, docs, none):
    base = [sentence(int(n)) for n in rng.integers(3, 60, 60)]
    near = [b.replace(b.split()[0], "changed", 1) for b in base[:30]] + [b.upper() + " " for b in base[30:40]]
    lines = base + near + ["", "short", "short two", "short two"]
    texts = ["\n".join(lines[i:i + 3]) for i in range(0, len(lines), 3)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}

    def shingles(t):
        t = re.sub("[ \t\r]+", " ", t.lower()).strip(" ")
        return {t[i:i + 5] for i in range(max(1, len(t) - 4))}

    at = [(d, k, ln) for d, t in enumerate(texts) if t is not None for k, ln in enumerate(t.split("\n")) if ln.strip(" ")]
    sets = [shingles(t) for _, _, t in at]
    links = [(i, j) for i in range(len(at)) for j in range(i)
             if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    root = union(len(at), links)
    drop = {at[i][:2] for i in range(len(at)) if root[i] != i}
    want = {d: None if t is None else "\n".join(ln for k, ln in enumerate(t.split("\n")) if (d, k) not in drop)
            for d, t in enumerate(texts)}
    wrong = [d for d in want if want[d] != got[d]]
    # bands miss a few links; nothing else may differ: no line goes that brute force keeps
    assert len(wrong) <= 0.1 * len(drop), [(want[d], got[d]) for d in wrong]
    assert all(set(want[d].split("\n")) <= set(got[d].split("\n")) for d in wrong)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "lines_removed_"] and out.count() == docs.count()
    assert line_dedup.dedup_lines(none).count() == 0


def test_decontaminate(spark, docs, none, monkeypatch):
    pool = [t for _, t in texts_of(docs) if t]
    items = [(1, " ".join(pool[2].split()[2:16])), (2, "Aa bb"), (3, None), (4, ""), (1, "ÀÉ x9"), (10, pool[5].upper()), (None, "no id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = lambda t: word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    wins = set()
    for i, t in items:
        ws = fold(t)
        wins |= {(str(i), tuple(ws[k:k + 10])) for k in range(max(1, len(ws) - 9) if ws else 0)}

    def brute(t):
        ws, hit, got = fold(t), set(), set()
        for i, w in wins:
            for k in range(len(ws) - len(w) + 1):
                if tuple(ws[k:k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    got.add(i)
        return len(ws), sorted(hit), sorted(got)

    want = sorted(repr((i, *brute(t))) for i, t in texts_of(docs))
    for size in (1 << 20, 200):  # one block of patterns, and several
        monkeypatch.setattr("playlens.llm.decontaminate.BLOCK_BYTES", size)
        out = mark_contamination(docs, bench)
        assert out.columns == [*docs.columns, "n_words", "hit_words", "hit_items"]
        assert sorted(repr((r["doc_id"], r["n_words"], r["hit_words"], r["hit_items"])) for r in out.collect()) == want
    assert mark_contamination(none, bench).count() == 0
    assert mark_contamination(docs, bench.limit(0)).where("size(hit_items) > 0").count() == 0


def test_sharding(docs, none):
    got = shuffle_into_shards(docs, "doc_id", "text", shards=7, bucket_bytes=5000).collect()
    assert sorted(repr((r["key"], r["text"])) for r in got) == sorted(repr(x) for x in texts_of(docs))
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    order = [r["key"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order != sorted(order, key=lambda x: (x is not None, x))
    assert shuffle_into_shards(none, "doc_id", "text").count() == 0


def test_coder_round_trips():
    blocks = [np.zeros(0, int), np.array([5]), np.full(3000, 7), rng.integers(0, 50257, 2000),
              np.minimum(rng.zipf(1.3, 4096), 50256), np.arange(100)]
    words = idcoder.encode_lanes(blocks, 50257)
    back = idcoder.decode_lanes(words, [len(b) for b in blocks], 50257)
    assert all((a == b).all() for a, b in zip(blocks, back))
    assert 32 * len(words[2]) < 3000 and 32 * len(words[4]) < 14 * 4096
    block = idcoder.seal(words[1], 1, [(0, 0, 1, 1)])
    assert idcoder.unseal(block)[1] == 1
    with pytest.raises(ValueError):
        idcoder.unseal(block[:-6] + b"\x01" + block[-5:])


def test_id_files(spark, docs, none, tmp_path):
    idcoder.write_ids(docs.where("doc_id IS NOT NULL"), f"{tmp_path}/ids", default_path(), end_id=2, file_bytes=30_000, block=512)
    got = idcoder.read_documents(spark, f"{tmp_path}/ids", vocabulary_size(default_path())).collect()
    tok = tokenizer(default_path())
    raw = {}
    for i, t in texts_of(docs):
        raw[i] = tok.encode([t])[0] + (2).to_bytes(4, "little")
    rows = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got)
    at = 0
    for start, i, n, crc in rows:
        assert (start, n, crc) == (at, len(raw[i]) // 4, zlib.crc32(raw[i]))
        at += n
    assert [i for _, i, _, _ in rows] == sorted(i for i, _ in texts_of(docs) if i is not None)
    idcoder.write_ids(none, f"{tmp_path}/none", default_path(), end_id=2)
    assert idcoder.read_documents(spark, f"{tmp_path}/none", 50257).count() == 0


def test_packing(docs, none):
    got = packing.pack_documents(docs.where("doc_id IS NOT NULL"), default_path(), capacity=256, end_id=0, with_ids=True, group=50).collect()
    tok, seqs = tokenizer(default_path()), {}
    by_doc = {}
    for r in got:
        assert r["length"] * 4 == len(r["ids"]) and zlib.crc32(r["ids"]) == r["ids_crc32"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], {}).setdefault(r["start"], r["ids"])
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 256
    for i, t in texts_of(docs):
        if i is not None:
            assert b"".join(v for _, v in sorted(by_doc[i].items())) == tok.encode([t])[0] + bytes(4)
    total = sum(r["length"] for r in got)
    assert len(seqs) <= -(-total // 256) + 6
    assert packing.pack_documents(none, default_path()).count() == 0


def test_bin_completion_is_never_worse_and_often_better():
    better = 0
    for n in (0, 1, 12, 40):
        for _ in range(15):
            sizes = rng.integers(300, 1400, n).tolist()
            bins = packing.bin_completion(sizes, 2048)
            assert sorted(i for b in bins for i in b) == list(range(n))
            assert all(sum(sizes[i] for i in b) <= 2048 for b in bins)
            fit = len(packing.best_fit(sizes, 2048))
            assert packing.lower_bound(sizes, 2048) <= len(bins) <= fit if n else not bins
            better += len(bins) < fit
    assert better
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)] and packing.cut(2048, 2048) == [(0, 2048)]


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr("playlens.llm.vector_dedup.LEAF", 40)
    monkeypatch.setattr("playlens.llm.vector_dedup.BLOCK", 16)
    centre = rng.standard_normal((30, 24))
    x = np.concatenate([centre, *[centre[:8] + 0.15 * rng.standard_normal((8, 24)) for _ in range(12)], centre[:3]])
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [1.0, 2.0]]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000 + i, v, 0) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    ship(spark)
    got = {r["vec_id"]: r for r in vector_dedup(df, least=0.95).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    root = union(len(x), list(zip(*np.nonzero(near))))
    assert len(got) == len(rows)
    assert all(got[i]["n_links"] == near[i].sum() and got[i]["component_id"] == root[i] for i in range(len(x)))
    assert all(got[1000 + i]["n_links"] == 0 and got[1000 + i]["kept"] for i in range(len(odd)))
    assert vector_dedup(df.limit(0)).count() == 0


def test_toxicity_held_out(docs, none):
    bad = ["zzgrumph", "qqvile", "xxawful", "wwnasty"]
    made = [(sentence(40), 0) for _ in range(300)]
    made += [(sentence(15) + " " + " ".join(rng.choice(bad, 2)) + ". " + sentence(15) + " " + str(rng.choice(bad)), 1) for _ in range(100)]
    rng.shuffle(made)
    made = [(t, int(y)) for t, y in made]
    model = toxicity.fit(made[:280])
    right = [(model.score(t) >= toxicity.DECISION) == bool(y) for t, y in made[280:]]
    assert np.mean(right) > 0.93
    assert 0 <= model.score(None) <= 1 and model.score("") == model.score(None)
    out = toxicity.score_documents(docs, model)
    assert out.columns == [*docs.columns, "score_", "predicted"] and out.count() == docs.count()
    assert toxicity.score_documents(none, model).count() == 0
    assert 0 <= toxicity.fit([]).score("x") <= 1


def test_licenses(spark, docs, none):
    rows = [(1, "abc\nReleased under the MIT License.\nx"), (2, "Licensed under the  Apache License,\nVersion 2.0."),
            (3, "Licensed under nothing at all, rights or not"), (4, None), (5, "all rights RESERVED"),
            (6, "Released under the BSD License."), (1, "Licensed under CC BY-NC 4.0.")]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["line"], r["template"]) for r in got) == [
        (1, 0, "CC-BY-NC-4.0"), (1, 1, "MIT"), (2, 0, "Apache-2.0"), (5, 0, "all-rights-reserved")]
    assert scan_licenses(none).count() == 0 and scan_licenses(docs).count() == 0


def test_chat_fold(spark):
    from playlens.llm.chat import fold_events, format_events, read_back

    tricky = r"a\b\l<s>[INST]\q[/INST]</s>\\"
    log = [(1, 0, 1, 0, "message", "user", "hi"), (1, 1, 1, 1, "message", "assistant", ""), (1, 1, 1, 2, "delta", None, "bad"),
           (1, 1, 1, 3, "regenerate", None, "ignored"), (1, 1, 1, 5000, "delta", None, " two"), (1, 1, 1, 4, "delta", None, "one"),
           (1, 0, 1, 9, "edit", None, tricky), (2, None, 1, None, None, None, None), (None, 700, 1, 1, "message", "tool", "x")]
    df = spark.createDataFrame(log, "conv_id long, turn long, sub int, seq long, kind string, role string, text string")
    got = sorted((tuple(r) for r in fold_events(df).collect()), key=repr)
    assert got == sorted([(1, 0, 1, "user", tricky), (1, 1, 1, "assistant", "one two"), (2, None, 1, None, ""), (None, 700, 1, "tool", "x")], key=repr)
    back = {r["conv_id"]: r for r in read_back(format_events(df)).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", tricky), ("assistant", "one two")] and back[1]["loss"] == ["one two"]
    assert [tuple(t) for t in back[2]["turns"]] == [("", "")] and back[2]["loss"] == []
    assert format_events(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    from tools.oracle_check import rows_of

    got, want = QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(ORACLE[name]).df()
    assert rows_of(got) == rows_of(want)


def test_queries_cover_all_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = sorted(r[0] for r in docs.select("doc_id").collect())
    for name in ("op2_dictionary_distance", "op5_two_pass_shuffle", "op6_id_files", "op8_simhash_dedup"):
        assert sorted(r[0] for r in QUERIES[name](spark, SF_SMALL).select("doc_id").collect()) == ids, name
    held = QUERIES["op2_dictionary_distance"](spark, SF_SMALL).select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in held)
    sizes = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in QUERIES["op5_two_pass_shuffle"](spark, SF_SMALL).collect():
        raw = sizes[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
    assert hashlib.sha256(b"").hexdigest() == QUERIES["op9_chat_format"](spark, SF_SMALL).where(
        F.col("loss_chars") == 0).agg(F.coalesce(F.max("loss_sha256"), F.lit(hashlib.sha256(b"").hexdigest()))).first()[0]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, ids = docs.columns, set()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SF_SMALL).cache()
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == cols and ids <= before and len(ids) > 0.6 * len(before), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
