"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Two tokenizers A and B part the same bytes.  A byte offset where a token of A
and a token of B both end is a shared cut.  An interval is divided at the
shared cut nearest to its middle: the ends of A's tokens are tried outwards
from the middle, each looked up among the ends of B's tokens by bisection,
and both halves are divided in turn.  An interval without a cut is a leaf
group.  All intervals of one level, over all texts of a block, are tried
together as arrays, so a text of any length costs a few array steps per level.
Tokens of A and B both end where a word ends at a space that is a safe cut, so a
text is divided there first, and each different word once for all texts, as
long as it is known.

Counting how often an id pair is linked over the corpus is Spark's work: each
text keeps its distinct pairs with their numbers, the numbers are summed by
pair, and come back to the texts by ``heavy_lookup`` (frequent pairs
broadcast under a proven bound, the others joined).
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import free_name, heavy_lookup, map_rows, materialize, pick
from playlens.llm.tokens import CutTokenizer, Known, Pieces, bytes_of, column, cuts_of, strings_of

#: Text bytes that are worked on as one block of arrays.
BLOCK = 2 << 20
#: Words that a worker remembers with their groups.
KNOWN = 600_000

def divide(ea: np.ndarray, eb: np.ndarray, lo, hi, lob, hib) -> tuple:
    """Leaf groups of the intervals A[lo:hi] / B[lob:hib].

    ``ea`` and ``eb`` are increasing byte offsets of token ends; the last
    tokens of every interval end together.  Returns the four bounds of the
    leaves, in order."""
    lo, hi, lob, hib = (np.asarray(x, dtype=np.int64) for x in (lo, hi, lob, hib))
    far = np.zeros(len(lo), dtype=np.int64)  # 0: try the middle; then that far from it and beyond
    leaves = []
    while len(lo):
        mid = (lo + hi - 2) // 2
        done = (hi - lo < 2) | (hib - lob < 2) | (far > np.maximum(mid - lo, hi - 2 - mid))
        leaves.append((lo[done], hi[done], lob[done], hib[done]))
        lo, hi, lob, hib, far, mid = (x[~done] for x in (lo, hi, lob, hib, far, mid))
        if not len(lo):
            break
        tries = np.where(far == 0, 1, 2 * far)
        of = np.repeat(np.arange(len(lo)), tries)
        j = np.arange(len(of)) - np.repeat(np.cumsum(tries) - tries, tries)
        step = far[of] + j // 2
        at = mid[of] + np.where(j & 1, step, -step)
        fits = (at >= lo[of]) & (at <= hi[of] - 2)
        of, at = of[fits], at[fits]
        k = np.minimum(np.searchsorted(eb, ea[at]), len(eb) - 1)  # bisection
        hit = eb[k] == ea[at]
        which, first = np.unique(of[hit], return_index=True)  # nearest to the middle
        cut, cutb = at[hit][first] + 1, k[hit][first] + 1
        left = np.ones(len(lo), dtype=bool)
        left[which] = False
        nothing = np.zeros(len(which), dtype=np.int64)
        lo, hi, lob, hib, far = (
            np.concatenate([lo[left], lo[which], cut]), np.concatenate([hi[left], cut, hi[which]]),
            np.concatenate([lob[left], lob[which], cutb]), np.concatenate([hib[left], cutb, hib[which]]),
            np.concatenate([np.maximum(1, 2 * far[left]), nothing, nothing]))
    parts = [np.concatenate(x) for x in zip(*leaves)] if leaves else [np.zeros(0, dtype=np.int64)] * 4
    order = np.argsort(parts[0])
    return tuple(x[order] for x in parts)


def _digits(n: int) -> np.ndarray:
    """Row i: the decimal digits of i, padded with zero bytes."""
    width = len(str(max(n - 1, 1)))
    return np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(n)), dtype=np.uint8).reshape(n, width)


class Pair:
    """Both tokenizers, their token bytes, and the pieces of text seen."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = CutTokenizer(a_path, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        entries = json.loads(self.a.tok.to_str())["model"]["vocab"]
        byte = {c: b for b, c in self.a.letters.items()} | {chr(b): b for b in range(256) if b not in self.a.letters}
        n = max(self.a.tok.get_vocab().values()) + 1
        self.a_bytes = [b""] * n
        for token, i in entries.items():
            self.a_bytes[i] = bytes(byte[c] for c in token)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
        # cutting at spaces needs that no piece goes on over a space
        if any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())):
            raise ValueError("vocabulary B has pieces that hold a space inside")
        self.a_text, self.b_text = (Pieces(np.frombuffer(b"".join(x), dtype=np.uint8), np.array([len(y) for y in x], dtype=np.int64))
                                    for x in (self.a_bytes, self.b_bytes))
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_digits, self.b_digits = _digits(len(self.a_bytes)), _digits(len(self.b_bytes))
        self.known, self.older = Known(KNOWN), ()

    def _encode(self, parts: pa.Array) -> tuple[Pieces, Pieces, np.ndarray]:
        """Ids of A, ids of B, bytes equal, of parts, each with a space before it."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), parts, pa.scalar("", pa.large_string()))
        a, lists = self.a.words(spaced), self.b.encode(parts.to_pylist(), num_threads=1) if len(parts) else []
        b = Pieces(np.fromiter(itertools.chain.from_iterable(lists), dtype=np.uint32), np.array([len(x) for x in lists], dtype=np.int64))
        want, same = bytes_of(spaced), np.ones(len(parts), dtype=bool)
        for ids, text in ((a, self.a_text), (b, self.b_text)):
            given = text.take(ids.flat).sums(ids.n)
            same &= given.n == want.n
            fits = np.flatnonzero(same)
            same[np.repeat(fits, want.n[fits])[given.take(fits).flat != want.take(fits).flat]] = False
        return a, b, same

    def words(self, parts: pa.Array) -> list[Pieces]:
        """What is known of parts, each with a space before it: its groups as text; numbers of tokens of A and B,
        of groups and bytes, and whether the bytes are equal; the offset where each group ends; its linked pair."""
        x, y, same = self._encode(parts)
        size = bytes_of(parts).n + 1
        some = np.flatnonzero(same)
        x, y = x.take(some), y.take(some)
        a, b, na, nb = x.flat.astype(np.int64), y.flat.astype(np.int64), x.n, y.n
        ea, eb = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        top, topb = np.cumsum(na), np.cumsum(nb)
        lo, hi, lob, hib = divide(ea, eb, top - na, top, topb - nb, topb)
        # which part a leaf belongs to
        of = np.searchsorted(top, lo, side="right")
        groups = np.bincount(of, minlength=len(some))
        # a1,a2|b1;a3|b2,b3
        wide = max(self.a_digits.shape[1], self.b_digits.shape[1])
        marks = np.zeros((len(a) + len(b), wide + 1), dtype=np.uint8)
        pa_, pb = np.arange(len(a)) + np.repeat(lob, hi - lo), np.arange(len(b)) + np.repeat(hi, hib - lob)
        marks[pa_, :self.a_digits.shape[1]] = self.a_digits[a]
        marks[pb, :self.b_digits.shape[1]] = self.b_digits[b]
        marks[:, wide] = ord(",")
        if len(lo):
            marks[pa_[hi - 1], wide] = ord("|")
            marks[pb[hib - 1], wide] = ord(";")
            marks[pb[topb - 1], wide] = 0  # the last group of a part
        used = np.concatenate([[0], np.cumsum((marks != 0).sum(axis=1))])
        flat = marks.ravel()
        # shared cuts, as offsets into space + part
        base = np.concatenate([[0], ea])[top - na]
        pair = a[hi - 1] * len(self.b_bytes) + b[hib - 1] if len(lo) else np.zeros(0, dtype=np.int64)
        cuts = ea[hi - 1] - base[of] if len(lo) else np.zeros(0, dtype=np.int64)

        def every(n):
            out = np.zeros(len(same), dtype=np.int64)
            out[some] = n
            return out

        head = np.stack([every(na), every(nb), every(groups), size, same.astype(np.int64)], axis=1)
        return [Pieces(flat[flat != 0], every(np.diff(used[np.concatenate([[0], top + topb])]))),
                Pieces(head.ravel().astype(np.int32), np.full(len(same), 5)), Pieces(cuts.astype(np.int32), every(groups)), Pieces(pair, every(groups))]

    def align(self, texts: list[str | None] | pa.Array) -> dict[str, list]:
        """Groups, cuts and distinct linked pairs of each text."""
        texts = column(texts)
        flat, size = cuts_of(texts, "")
        coded = flat.dictionary_encode()
        said, head, ends, linked = self.known.find(coded.dictionary, self.words)
        at = coded.indices.to_numpy().astype(np.int64)
        of = np.repeat(np.arange(len(size)), size)
        # texts of which the bytes of a part differ are looked at as a whole
        odd = np.unique(of[head.flat[5 * at + 4] == 0])
        if len(odd):
            whole = self.words(texts.take(pa.array(odd)))
            n = len(coded.dictionary)
            said, head, ends, linked = (Pieces.join([x, y]) for x, y in zip((said, head, ends, linked), whole))
            stays = ~np.isin(of, odd)
            of, at = np.concatenate([of[stays], odd]), np.concatenate([at[stays], n + np.arange(len(odd))])
            order = np.argsort(of, kind="stable")
            of, at = of[order], at[order]
            size = np.bincount(of, minlength=len(size))
        head = head.flat.reshape(-1, 5)[at]
        na, nb, groups, length = (np.bincount(of, weights=head[:, i], minlength=len(size)).astype(np.int64) for i in range(4))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                                         strings_of(said).take(pa.array(at)))
        # shared cuts, as offsets into space + text
        ends, size_in = ends.take(at), head[:, 3].astype(np.int64)
        before = np.cumsum(size_in) - size_in - np.repeat(np.cumsum(length) - length, size)
        cuts = ends.flat + np.repeat(before, ends.n)
        # distinct linked pairs of a text
        linked = linked.take(at)
        pair, times = np.unique(np.repeat(of, linked.n) << 40 | linked.flat, return_counts=True)
        return {"n_a": na, "n_b": nb, "groups": pc.binary_join(lists, pa.scalar(";", pa.large_string())), "n_groups": groups, "cuts": cuts,
                "pair": pair & ((1 << 40) - 1), "times": times, "n_pairs": np.bincount(pair >> 40, minlength=len(size))}


@functools.lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def sizes(a_path: str, b_path: str) -> tuple[int, int]:
    """Number of ids of both vocabularies."""
    import sentencepiece
    from tokenizers import Tokenizer

    return (max(Tokenizer.from_file(a_path).get_vocab().values()) + 1,
            sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size())


def align_texts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Add the alignment of every whole text.

    New columns: ``n_a``, ``n_b`` (tokens of A and B), ``n_groups``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``), ``cuts`` (byte offset in space + text
    where each group ends), ``pairs`` and ``times`` (distinct linked pairs as
    A id * size of B + B id, and how many links hold each).  A text that is
    null or empty, or whose bytes a vocabulary does not give back, has no
    tokens: zeros, '' and empty arrays.  Other columns stay as they are; a new
    column whose name is taken gets underscores."""
    def lists(n, values, kind):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values, kind))

    def run(cols):
        got = _pair(a_path, b_path).align(cols[0])
        return [pa.array(got["n_a"], pa.int64()), pa.array(got["n_b"], pa.int64()), pa.array(got["n_groups"], pa.int64()),
                got["groups"].cast(pa.string()), lists(got["n_groups"], got["cuts"], pa.int64()),
                lists(got["n_pairs"], got["pair"], pa.int64()), lists(got["n_pairs"], got["times"], pa.int32())]

    return map_rows(docs, [text], run, "n_a long, n_b long, n_groups long, groups string, cuts array<long>, "
                    "pairs array<long>, times array<int>", block_bytes=BLOCK)


def align_corpus(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its alignment, measured against the corpus.

    ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)``: the count of an id pair is the number of links of the
    whole corpus that hold it; ``n_best`` counts the links whose pair has the
    highest count of all pairs of its B id (ties included); ``count_sum`` adds
    the counts of the row's links.  Rows with equal or null ids stay rows of
    their own; null and empty texts have zeros and an empty digest; an empty
    table gives an empty frame; other columns are not looked at."""
    _, size_b = sizes(a_path, b_path)
    docs = pick(docs, doc_id=id_col, text=text)
    aligned = align_texts(docs, a_path, b_path)
    found = materialize(aligned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "pairs", "times"), "aligned")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    counts = links.groupBy("pairs").agg(F.sum("times").alias("n")).withColumn("b", F.col("pairs") % size_b)
    counts = materialize(counts, "pair-counts")
    # at most one row per id of B, so this side has a bound
    best = counts.groupBy("b").agg(F.max("n").alias("top"))
    counts = counts.join(F.broadcast(best), "b").select("pairs", "n", (F.col("n") == F.col("top")).alias("best"))
    sums = (heavy_lookup(links, counts, ["pairs"], "n")
            .groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"),
                                F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    out = found.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.coalesce("n_links", zero).alias("n_links"),
                      F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
