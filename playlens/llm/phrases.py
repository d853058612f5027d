"""Phrase collocations by Toivonen's sampling, counted exactly.

A sample of the texts proposes phrases (words and pairs of words frequent in
it at a lowered bound).  One pass over all texts then counts every word, and
every longer phrase whose two parts (without its last, without its first
word) are proposed: that is the proposed phrases and their negative border
together, the border never being spelt out.  A border phrase that turns out
frequent is a failure of the sample; it joins the proposed ones, and a further
pass counts just the phrases that this brings in.  Passes go on until no
failure is left.  A phrase is at most as frequent as its parts, so every
frequent phrase has then been counted, exactly, whatever the sample was.

The proposed phrases reach the tasks as bit maps of bounded size.  A bit that
is set by chance lets a phrase be counted that need not be, and changes no
result.  These passes count hashes of phrases: two phrases with one hash can
only count as more, so none is missed.  A last pass counts the texts of the phrases
found, which makes the counts exact.  Tasks work on words as numbers, block by
block, and send the counts of a block on; Spark sums them.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import heavy_lookup, in_blocks, materialize, pick

#: Share of the texts in the sample, and the frequency there that proposes a phrase.
SAMPLE, LOWERED = 0.3, 2
#: Bits of a map per phrase, and bounds of a map's size (bits, powers of two).
BITS, LEAST, MOST = 16, 1 << 16, 1 << 28
#: Bytes of text that are counted as one block.
BLOCK = 2 << 20

#: Letters A-Z lowered, and every mark that ends a piece as a full stop.
_FORM = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz.........")


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of a pair of words from the hashes of both."""
    with np.errstate(over="ignore"):
        z = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + np.uint64(0x632BE59BD9B4E019))
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return z ^ (z >> np.uint64(32))


def _hash_words(words: list[bytes], lang: str) -> np.ndarray:
    import xxhash

    seed, h = zlib.crc32(lang.encode()), xxhash.xxh3_64_intdigest
    return np.array([h(w, seed) for w in words], dtype=np.uint64)


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)]


def _within(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes are in a bit map (no member is missed)."""
    out = np.ones(len(h), dtype=bool)
    for p in _places(h, 8 * len(bitmap)):
        out &= (bitmap[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _bitmap(hashes: DataFrame, bits: int, without: np.ndarray | None = None) -> np.ndarray:
    """Bit map of the column ``h``, of hashes that ``without`` doesn't hold: tasks
    set the bits of a stretch each, the driver puts the stretches together
    (``bits`` / 8 bytes)."""
    import pyarrow as pa

    stretch = max(bits // 256, 8)
    held = None if without is None else hashes.sparkSession.sparkContext.broadcast(without)

    def spread(batches):
        for b in batches:
            h = b.column(0).to_numpy().view(np.uint64)
            if held is not None:
                h = h[~_within(held.value, h)]
            p = np.unique(np.concatenate(_places(h, bits))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p // stretch, pa.int64()), pa.array(p % stretch, pa.int32())], ["s", "p"])

    def gather(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            s, p = b.column(0).to_numpy(), b.column(1).to_numpy()
            for k in np.unique(s).tolist():
                np.bitwise_or.at(held.setdefault(k, np.zeros(stretch // 8, dtype=np.uint8)), p[s == k] >> 3,
                                 (1 << (p[s == k] & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()),
                                          pa.array([x.tobytes() for x in held.values()], pa.binary())], ["s", "bytes"])

    rows = (hashes.select("h").mapInArrow(spread, "s long, p int")
            .repartition("s").mapInArrow(gather, "s long, bytes binary").collect())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        at = r["s"] * stretch // 8
        out[at:at + stretch // 8] |= np.frombuffer(bytes(r["bytes"]), dtype=np.uint8)
    return out


def _size_for(n: int) -> int:
    bits = LEAST
    while bits < min(n * BITS, MOST):
        bits *= 2
    return bits


class Border:
    """What is proposed: words and pairs, now and before the last pass."""

    def __init__(self, words, pairs, old_words=None, old_pairs=None):
        self.words, self.pairs, self.old_words, self.old_pairs = words, pairs, old_words, old_pairs


class Block:
    """The words of a block of texts of one language as numbers, with their hashes."""

    def __init__(self, texts: list[str], lang: str):
        words = b" . ".join([t.encode().translate(_FORM).replace(b".", b" . ") for t in texts]).split()
        known = dict.fromkeys(words)
        known[b"."] = None
        self.names = list(known)
        known = {w: i for i, w in enumerate(self.names)}
        self.ids = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
        self.n, mark = len(known), known[b"."]
        self.h = _hash_words(self.names, lang)
        self.counts = np.bincount(self.ids, minlength=self.n)
        self.counts[mark] = 0
        a, b = self.ids[:-1], self.ids[1:]
        self.inside = (a != mark) & (b != mark)  # whether two words follow each other in a piece
        self.code = a * self.n + b

    def pairs(self, take: np.ndarray) -> tuple:
        """(first words, second words, counts) of the pairs that start at ``take``."""
        pair, c = np.unique(self.code[take], return_counts=True)
        return pair // self.n, pair % self.n, c

    def triples(self, take: np.ndarray) -> tuple:
        """As ``pairs``, of three words."""
        at = np.flatnonzero(take)
        # number the pairs of this block, so that two numbers name three words
        firsts, first = np.unique(self.code[:-1][at], return_inverse=True)
        three, c = np.unique(first * self.n + self.ids[2:][at], return_counts=True)
        front = firsts[three // self.n]
        return front // self.n, front % self.n, three % self.n, c


def _by_language(batches):
    """Blocks of the texts of a task, by language."""
    for batch in batches:
        for b in in_blocks(batch, 1, BLOCK):
            by: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                yield lang, Block(texts, lang)


def _hashed_counts(block: Block, border: Border | None, levels: tuple):
    """(level, hashes, counts) of the phrases of a block that the border lets in."""
    h, ids = block.h, block.ids
    if 1 in levels:
        at = np.flatnonzero(block.counts)
        yield 1, h[at], block.counts[at]
    if border is None or len(ids) < 2:
        return
    if 2 in levels:
        now = _within(border.words, h)
        take = block.inside & now[ids[:-1]] & now[ids[1:]]
        if border.old_words is not None:
            old = _within(border.old_words, h)
            take &= ~(old[ids[:-1]] & old[ids[1:]])
        a, b, c = block.pairs(take)
        yield 2, _mix(h[a], h[b]), c
    if 3 in levels and border.pairs is not None:
        both = _mix(h[ids[:-1]], h[ids[1:]])
        now = block.inside & _within(border.pairs, both)
        take = now[:-1] & now[1:]
        if border.old_pairs is not None:
            old = block.inside & _within(border.old_pairs, both)
            take &= ~(old[:-1] & old[1:])
        a, b, c, n = block.triples(take)
        yield 3, _mix(_mix(h[a], h[b]), h[c]), n


def count_hashes(docs: DataFrame, border: Border | None, levels: tuple, least: int) -> DataFrame:
    """``(k, h, f)``: how often the phrases that the border lets in occur, by hash, if at least ``least`` times.

    ``docs`` has ``lang`` and ``text`` without nulls; a phrase's language is part of its hash."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(border)

    def run(batches):
        for _, block in _by_language(batches):
            for k, hashes, counts in _hashed_counts(block, held.value, levels):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), k), pa.int32()),
                                                  pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())], ["k", "h", "f"])

    return (docs.select("lang", "text").mapInArrow(run, "k int, h long, f long")
            .groupBy("k", "h").agg(F.sum("f").alias("f")).where(F.col("f") >= least))


def count_texts(docs: DataFrame, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, least: int) -> DataFrame:
    """``(lang, k, phrase, f)`` of the phrases in the bit maps, if at least ``least``; ``k`` = 0 counts all words.

    Phrases are counted by their text, so two with one hash are told apart."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held = docs.sparkSession.sparkContext.broadcast((words, pairs, triples))

    def found(block):
        words, pairs, triples = held.value
        h, ids = block.h, block.ids
        text = pa.array(block.names, pa.binary()).cast(pa.string())
        yield 0, pa.array([""], pa.string()), np.array([block.counts.sum()])
        at = np.flatnonzero((block.counts > 0) & _within(words, h))
        yield 1, text.take(pa.array(at)), block.counts[at]
        if len(ids) < 2:
            return
        both = _mix(h[ids[:-1]], h[ids[1:]])
        take = block.inside & _within(pairs, both)
        a, b, n = block.pairs(take)
        yield 2, pc.binary_join_element_wise(text.take(pa.array(a)), text.take(pa.array(b)), " "), n
        take = take[:-1] & take[1:]
        take[take] = _within(triples, _mix(both[:-1][take], h[ids[2:][take]]))
        a, b, c, n = block.triples(take)
        yield 3, pc.binary_join_element_wise(text.take(pa.array(a)), text.take(pa.array(b)), text.take(pa.array(c)), " "), n

    def run(batches):
        for lang, block in _by_language(batches):
            for k, phrases, counts in found(block):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrases), pa.string()), pa.array(np.full(len(phrases), k), pa.int32()),
                     phrases, pa.array(counts, pa.int64())], ["lang", "k", "phrase", "f"])

    return (docs.select("lang", "text").mapInArrow(run, "lang string, k int, phrase string, f long")
            .groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("k") == 0) | (F.col("f") >= least)))


def frequent_phrases(docs: DataFrame, least: int = 10, sample: float = SAMPLE, lowered: int = LOWERED) -> DataFrame:
    """``(lang, k, phrase, f)`` of every phrase of 1 to 3 words with f >= ``least``, and
    ``k`` = 0 rows with the number of all words of a language.

    ``docs``: ``lang`` and ``text`` without nulls.  Texts may be equal, empty
    or very long; no texts give no rows."""
    # a row's own hash decides, so the sample is the same whenever it is read
    share = docs.where(F.pmod(F.xxhash64("lang", "text", "salt"), F.lit(1000)) < int(1000 * sample))
    docs = docs.select("lang", "text")
    words = materialize(count_hashes(share, None, (1,), lowered), "sample-words")
    # the sample's numbers say how large the maps of the whole will be
    bits = _size_for(2 * words.count())
    proposed = _bitmap(words, bits)
    pairs = materialize(count_hashes(share, Border(proposed, None), (2,), lowered), "sample-pairs")
    bits2 = _size_for(2 * pairs.count())
    border = Border(proposed, _bitmap(pairs, bits2))
    found = last = materialize(count_hashes(docs, border, (1, 2, 3), least), "counts")
    while True:
        more_words = _bitmap(last.where("k = 1"), bits, without=border.words)
        more_pairs = _bitmap(last.where("k = 2"), bits2, without=border.pairs)
        if not more_words.any() and not more_pairs.any():
            break
        border = Border(border.words | more_words, border.pairs | more_pairs, border.words, border.pairs)
        levels = ((2,) if more_words.any() else ()) + ((3,) if more_pairs.any() else ())
        last = materialize(count_hashes(docs, border, levels, least), "counts")
        found = found.unionByName(last)
    maps = [_bitmap(found.where(F.col("k") == k), _size_for(found.where(F.col("k") == k).count())) for k in (1, 2, 3)]
    return count_texts(docs, *maps, least)


def collocations(docs: DataFrame, least: int = 10, keep_share: int = 50, top: int = 2000,
                 lang: str = "lang", text: str = "text", id_col: str | None = "doc_id") -> DataFrame:
    """Scored phrases of 2 and 3 words of each language, best first.

    ``(lang, rank, phrase, a, l, r, n, score)``: a phrase with count
    ``a >= least`` is cut where floor(1000000 a a / (l r)) is lowest (ties: the
    first cut); it is dropped if a longer candidate holds it in a row with at
    least ``keep_share`` % of its count; the first ``top`` by score, count and
    text (bytes) stay.  Null languages are ``und``, null texts empty; equal
    texts all count; a language without candidates has no rows, an empty table
    none at all; other columns are not looked at."""
    from pyspark.sql import Window

    salt = F.coalesce(F.col(id_col).cast("string"), F.lit("")) if id_col else F.lit("")
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       salt.alias("salt"))
    freq = materialize(frequent_phrases(docs, least), "frequent")
    total = freq.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    parts = freq.where("k IN (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("f").alias("g"))
    cand = freq.where("k >= 2").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))

    def words(start, count):
        return F.array_join(F.slice("w", start, count), " ")

    # both parts of every cut as one list of lookups: a third of all phrases may share a word
    cuts = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    asked = (cand.withColumn("cut", cuts)
             .select("lang", "k", "phrase", "a", "cut", F.explode(F.array(
                 F.struct(F.lit(True).alias("front"), words(F.lit(1), F.col("cut")).alias("part")),
                 F.struct(F.lit(False).alias("front"), words(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("part")))).alias("s"))
             .select("lang", "k", "phrase", "a", "cut", "s.*"))
    asked = materialize(asked, "cut-parts")
    # a word's phrases are no more than its count, so counts are the weight of a lookup
    got = heavy_lookup(asked, parts, ["lang", "part"], "g")
    cut = (got.groupBy("lang", "phrase", "k", "a", "cut").agg(F.max(F.when(F.col("front"), F.col("g"))).alias("l"),
                                                              F.max(F.when(~F.col("front"), F.col("g"))).alias("r"))
           .withColumn("score", F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))))"
                                       " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")))
    best = cut.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
    scored = materialize(best.select("lang", "phrase", "k", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "s.score"), "scored")
    # pairs within candidates of three words
    inner = (scored.where("k = 3").select("lang", F.col("a").alias("longer"), F.split("phrase", " ", -1).alias("w"))
             .select("lang", "longer", F.explode(F.array(words(1, 2), words(2, 2))).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where((F.col("k") == 3) | F.col("longer").isNull() | (100 * F.col("longer") < keep_share * F.col("a"))))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.select("lang", place.cast("long").alias("rank"), "phrase", "a", "l", "r", "score").where(F.col("rank") <= top)
    return ranked.join(F.broadcast(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
