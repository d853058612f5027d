"""Packing of tokenized documents into fixed-length training sequences by bin
completion with best-fit incumbents.

Documents are tokenized once; texts longer than a sequence are cut from the
end, so that only the first piece is shorter.  Pieces are dealt by a salted
hash into groups of about ``GROUP`` pieces, and each group is packed on its
own: best-fit decreasing gives the incumbent, and where it misses the lower
bound, branch-and-bound fills one bin after another around the largest piece
left, over undominated fillings of any number of pieces, pruned by the waste an
improvement may have.  A budget of steps back bounds the search, not its depth,
so that a descent over the whole group always ends; beyond it the best bins
found so far stand.

A group's last sequences waste less than one sequence or so, a share of about
one in thousands; groups are independent, so the work spreads over any number
of executors and a lost one repeats only its own groups.
"""

from __future__ import annotations

import contextlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import in_blocks, materialize, parts_for, pick
from playlens.llm.tokens import BLOCK_BYTES, tokenizer, vocabulary_size

#: Pieces packed together; a bound on a task's memory and time.
GROUP = 8192
#: Steps back of the search per group.
NODES = 2000
#: Bins of one window of the search, and its steps back.
WINDOW = 32
WINDOW_NODES = 200
#: Thousandths of a sequence that a bin of two pieces may waste in a descent.
SLACKS = (0, 5, 10, 15, 20, 25, 30, 40, 50, 70, 100, 150)
#: Partial fillings looked at per bin, before the greedy one ends the list.
TRIES = 400
#: Fillings tried per bin, after the undominated ones are ordered by waste.
BRANCH = 4


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of indices into ``sizes``."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r: a bin with r tokens left
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = sizes[i]
        fits = open_ >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                open_ ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > s:
            free[room - s].append(b)
            open_ |= 1 << (room - s)
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """The larger of the volume bound and the bound for pieces over a half."""
    best = -(-sum(sizes) // capacity)
    counts = np.bincount(np.asarray(sizes, dtype=np.int64), minlength=capacity + 1)
    volume = counts * np.arange(capacity + 1)
    n_up, v_up = np.cumsum(counts[::-1])[::-1], np.cumsum(volume[::-1])[::-1]
    half = capacity // 2
    for k in range(1, half + 1):
        big = int(n_up[capacity - k + 1]) if k else 0
        mid_n = int(n_up[half + 1]) - big
        mid_v = int(v_up[half + 1]) - int(v_up[capacity - k + 1])
        low_v = int(v_up[k]) - int(v_up[half + 1])
        best = max(best, big + mid_n + max(0, -(-(low_v - (mid_n * capacity - mid_v)) // capacity)))
    return best


def _dominated(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether best fit finds places for the pieces of filling a in the pieces of filling b."""
    room = list(b)
    for x in a:  # both descending; a miss of best fit only leaves a filling in
        at = [r for r in room if r >= x]
        if not at:
            return False
        r = min(at)
        room.remove(r)
        room.append(r - x)
    return True


class _Left:
    """The pieces left, by size: counts, and as bits of ``present`` (bit s) and ``mirror`` (bit capacity - s)."""

    def __init__(self, sizes: list[int], capacity: int):
        self.capacity, self.counts, self.present, self.mirror, self.tries = capacity, [0] * (capacity + 1), 0, 0, 0
        for s in sizes:
            self.put(s)

    def put(self, s: int) -> None:
        self.counts[s] += 1
        self.present |= 1 << s
        self.mirror |= 1 << (self.capacity - s)

    def take(self, s: int) -> None:
        self.counts[s] -= 1
        if not self.counts[s]:
            self.present ^= 1 << s
            self.mirror ^= 1 << (self.capacity - s)

    def exact(self, total: int, top: int) -> Iterator[tuple[int, ...]]:
        """Fillings of exactly ``total`` by any number of pieces of at most ``top``, each descending."""
        if total <= top and self.present >> total & 1:
            yield (total,)
        yield from self._several(total, top)

    def _several(self, total: int, top: int) -> Iterator[tuple[int, ...]]:
        """As ``exact``, by two pieces or more; ends with the tries."""
        self.tries -= 1
        if self.tries < 0:
            return
        half = total // 2
        at = min(top, total)
        # bit y: pieces of y and of total - y are there
        pairs = (self.present & (self.mirror >> (self.capacity - total)) & ((2 << at) - 1)) >> (half + total % 2) << (half + total % 2)
        while pairs:
            y = pairs.bit_length() - 1
            pairs ^= 1 << y
            if 0 < total - y and (2 * y != total or self.counts[y] > 1):
                yield (y, total - y)
        low = (self.present & -self.present).bit_length() - 1
        sizes = self.present & ((2 << min(top, total - 2 * low)) - 1) if low > 0 and total >= 3 * low else 0
        while sizes and self.tries > 0:
            z = sizes.bit_length() - 1
            if 3 * z < total and z * self.counts[z] < total and not self.present & ((1 << z) - 1):
                return  # only this size is left, and too little of it
            sizes ^= 1 << z
            self.take(z)
            try:
                for rest in (inner := self._several(total - z, z)):
                    yield (z, *rest)
            finally:  # also when the caller stops here
                inner.close()
                self.put(z)


def fillings(room: int, left: _Left, waste: int) -> list[tuple[int, ...]]:
    """Up to ``BRANCH`` undominated fillings of ``room`` that waste at most
    ``waste``, the fullest first, by any number of pieces."""
    keep: list[tuple[int, ...]] = []
    left.tries = TRIES
    low = (left.present & -left.present).bit_length() - 1
    for gap in range(min(room, waste) + 1):
        if left.tries < 0 or room - gap < low or low < 0:
            break
        with contextlib.closing(left.exact(room - gap, room - gap)) as found:
            for f in itertools.islice(found, 2 * BRANCH):
                if not any(_dominated(f, g) for g in keep):
                    keep.append(f)
        if len(keep) >= BRANCH:
            return sorted(keep, key=lambda f: (-sum(f), len(f)))[:BRANCH]
    greedy, rest = [], room  # largest first, whatever the tries
    while fits := left.present & ((2 << rest) - 1):
        greedy.append(fits.bit_length() - 1)
        left.take(greedy[-1])
        rest -= greedy[-1]
    for s in greedy:
        left.put(s)
    if rest <= waste and tuple(greedy) not in keep:
        keep.append(tuple(greedy))
    return sorted(keep, key=lambda f: (-sum(f), len(f)))


def descend(sizes: list[int], capacity: int, slack: int) -> list[tuple[int, ...]]:
    """One filling of every bin, each around the largest piece left: one other
    piece if that wastes at most ``slack``, else the fullest of one or two
    others, and the rest of the room largest first."""
    left, bins = _Left(sizes, capacity), []
    while left.present:
        big = left.present.bit_length() - 1
        left.take(big)
        room, f = capacity - big, [big]
        while fits := left.present & ((2 << room) - 1):
            y = fits.bit_length() - 1
            low = (fits & -fits).bit_length() - 1
            two = ()
            if room - y > slack and room >= 2 * low:
                for gap in range(room - y):  # less than one piece wastes
                    total = room - gap
                    pairs = left.present & (left.mirror >> (capacity - total)) & ((1 << total) - 1)
                    pairs = pairs >> -(-total // 2) << -(-total // 2)
                    while pairs and (z := pairs.bit_length() - 1) * 2 == total and left.counts[z] < 2:
                        pairs ^= 1 << z
                    if pairs:
                        two = (z, total - z)
                        break
            for s in two or (y,):
                left.take(s)
                f.append(s)
                room -= s
        bins.append(tuple(f))
    return bins


def search(sizes: list[int], capacity: int, bins: int, nodes: int) -> tuple[list[tuple[int, ...]], int]:
    """Branch-and-bound for fewer than ``bins`` bins: the best fillings found
    (none if no better) and the steps back that are left of ``nodes``."""
    bound, total = lower_bound(sizes, capacity), sum(sizes)
    if bins <= bound:
        return [], nodes
    spare = (bins - 1) * capacity - total  # the waste an improvement may have
    left = _Left(sizes, capacity)
    path: list[tuple[tuple[int, ...], list[tuple[int, ...]], int]] = []
    best: list[tuple[int, ...]] = []
    waste, choice = 0, None
    while nodes > 0:
        if choice is None:
            big = left.present.bit_length() - 1
            left.take(big)
            choice = [(big, *f) for f in fillings(capacity - big, left, spare - waste)]
            left.put(big)
        while choice and waste + capacity - sum(choice[0]) > spare:
            choice.pop(0)
        if choice:
            f = choice.pop(0)
            path.append((f, choice, waste))
            for s in f:
                left.take(s)
            waste += capacity - sum(f)
            choice = None
            if left.present:
                continue
            best = [f for f, _, _ in path]
            if len(best) <= bound:
                break
            spare = (len(best) - 1) * capacity - total
        if not path:
            break
        nodes -= 1
        f, choice, waste = path.pop()
        for s in f:
            left.put(s)
    return best, nodes


def bin_completion(sizes: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Bins as lists of indices; never worse than best-fit decreasing.

    Whole descents come first, with several slacks; then the search completes
    the bins again in windows, the most wasteful bins first.  ``nodes`` is how
    often it may go back, at most ``WINDOW_NODES`` in one window.
    """
    incumbent = best_fit(sizes, capacity)
    bound = lower_bound(sizes, capacity) if sizes else 0
    if len(incumbent) <= bound:
        return incumbent
    bins = [tuple(sizes[i] for i in b) for b in incumbent]
    for slack in SLACKS:
        bins = min(bins, descend(sizes, capacity, slack * capacity // 1000), key=len)
        if len(bins) <= bound:
            break
    bins.sort(key=sum)
    at = 0
    while nodes > 0 and len(bins) > bound and at < len(bins) and sum(bins[at]) < capacity:
        window = bins[at:at + WINDOW]
        better, after = search([s for f in window for s in f], capacity, len(window), min(nodes, WINDOW_NODES))
        nodes -= max(1, min(nodes, WINDOW_NODES) - after)
        if better:
            bins[at:at + WINDOW] = better
            bins.sort(key=sum)
            at = 0
        else:
            at += WINDOW
    if len(bins) >= len(incumbent):
        return incumbent
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        by_size.setdefault(s, []).append(i)
    return [[by_size[s].pop() for s in f] for f in bins]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _wide(vocabulary: str, end_id: int) -> bool:
    """Whether an id may need more than 16 bits."""
    return max(vocabulary_size(vocabulary) - 1, end_id) >= 1 << 16


def widened(ids: pa.Array) -> pa.Array:
    """Ids of 16 bits as ids of 32 bits, list by list."""
    flat, n = np.frombuffer(b"".join(ids.to_pylist()), "<u2"), pc.binary_length(ids).to_numpy().astype(np.int64)
    raw, end = flat.astype("<u4").tobytes(), (2 * np.cumsum(n)).tolist()
    return pa.array([raw[i:j] for i, j in zip([0, *end[:-1]], end)], pa.binary())


def tokenize_pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int,
                    end_id: int, with_ids: bool) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` for every document; ``ids`` are of
    16 bits if all ids of the vocabulary are."""
    slim = pick(docs, doc_id=id_col, text=text_col)
    wide = _wide(vocabulary, end_id)
    width = 4 if wide else 2
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary)
        for batch in batches:
            for b in in_blocks(batch, 1, BLOCK_BYTES):
                rows = [[], [], [], [], [], []]
                for i, raw in enumerate(tok.encode(b.column("text"))):
                    raw += end
                    short = raw if wide or not with_ids else np.frombuffer(raw, "<u4").astype("<u2").tobytes()
                    for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                        part = short[width * s:width * (s + n)] if with_ids else None
                        for col, v in zip(rows, (i, k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)]), part)):
                            col.append(v)
                out = [b.column("doc_id").take(pa.array(rows[0], pa.int32())), pa.array(rows[1], pa.int32()),
                       *[pa.array(r, pa.int64()) for r in rows[2:5]]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.array(rows[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                           + (", ids binary" if with_ids else ""))


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 2048, end_id: int = 0, with_ids: bool = False, group: int = GROUP) -> DataFrame:
    """Every piece with its place: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` and, if asked for, ``ids`` (little-endian unsigned
    32-bit).  A sequence's pieces in order of ``offset`` are its tokens.

    A null or empty text is its end id alone; very long texts become full
    sequences and one shorter first piece; repeated rows are packed each; an
    empty table gives no rows; other columns are ignored.
    """
    wide = _wide(vocabulary, end_id)
    pieces = materialize(tokenize_pieces(docs, id_col, text_col, vocabulary, capacity, end_id, with_ids), "pieces")
    n = parts_for(pieces.count(), group)
    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(n)))

    def pack(part: pa.Table) -> pa.Table:
        sizes = part.column("length").to_pylist()
        deal = part.column("deal")[0].as_py()
        seq, off = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for b, members in enumerate(bin_completion(sizes, capacity)):
            at = 0
            for i in members:
                seq[i], off[i] = (deal << 32) + b, at
                at += sizes[i]
        part = part.drop_columns(["deal"])
        if with_ids and not wide:
            at = part.schema.get_field_index("ids")
            part = part.set_column(at, "ids", widened(part.column(at).combine_chunks()))
        return part.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("deal").applyInArrow(pack, schema + ", sequence_id long, offset long")
