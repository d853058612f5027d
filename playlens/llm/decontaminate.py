"""Benchmark decontamination by Wu-Manber multi-pattern search.

Windows of ten consecutive benchmark words are the patterns.  Documents are
searched in batches: normalised texts lie end to end in one buffer, many
places of it advance at the same time, and each reads the block of bytes that
would end a pattern's first m bytes.  A shift table says how far that block
lets it skip; where the shift is zero the block's suffix-hash bucket names the
patterns to compare byte by byte.

The benchmark is read in blocks of bounded size (``BLOCK_BYTES``); each block
is one pass over all documents, so neither the driver nor a task ever holds
more than one block of patterns.  There is no shuffle.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import map_rows, materialize, parts_for, pick

WORDS = 10
#: Benchmark text per pass (patterns take about 30 times that in a task).
BLOCK_BYTES = 1 << 20
#: ASCII bytes that are no word become spaces, A-Z become a-z, others stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_BITS = 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


class _Group:
    """Wu-Manber tables for patterns of at least m bytes."""

    def __init__(self, patterns: list[bytes]):
        self.m = min(map(len, patterns))
        self.b = min(8, self.m)
        self.mask = np.uint64((1 << (8 * self.b)) - 1 if self.b < 8 else 0xFFFFFFFFFFFFFFFF)
        self.shift = np.full(1 << _BITS, self.m - self.b + 1, dtype=np.int32)
        self.starts = np.zeros(1 << _BITS, dtype=bool)
        self.buckets: dict[int, list[bytes]] = defaultdict(list)
        heads = np.frombuffer(b"".join(p[:self.m] + b"\0" * 8 for p in patterns), dtype=np.uint8)
        row = np.arange(len(patterns)) * (self.m + 8)
        for j in range(self.m - self.b + 1):
            np.minimum.at(self.shift, self._hash(self._load(heads, row + j)), self.m - self.b - j)
        ends = self._load(heads, row + self.m - self.b)
        for p, e in zip(patterns, ends.tolist()):
            self.buckets[e].append(p)
        self.starts[self._hash(self._load(heads, row))] = True

    def _load(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The block of b bytes at each place, as one integer."""
        return np.ascontiguousarray(buf[at[:, None] + np.arange(8)]).view("<u8").ravel() & self.mask

    @staticmethod
    def _hash(block: np.ndarray) -> np.ndarray:
        return ((block * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def find(self, raw: bytes, buf: np.ndarray) -> list[tuple[int, bytes]]:
        """(place, pattern) of every occurrence; buf is raw with 8 spare bytes."""
        last = len(raw) - self.m
        if last < 0:
            return []
        lanes = max(1, min(8192, (last + 1) // 512))
        edge = np.linspace(0, last + 1, lanes + 1).astype(np.int64)
        at, stop = edge[:-1].copy(), edge[1:].copy()
        found: list[np.ndarray] = []
        while len(at):
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
                if not len(at):
                    break
            step = self.shift[self._hash(self._load(buf, at + (self.m - self.b)))]
            zero = step == 0
            if zero.any():
                cand = at[zero]
                found.append(cand[self.starts[self._hash(self._load(buf, cand))]])
            at = at + np.maximum(step, 1)
        out = []
        if found:
            cand = np.concatenate(found)
            ends = self._load(buf, cand + (self.m - self.b)).tolist()
            for p, e in zip(cand.tolist(), ends):
                for pat in self.buckets.get(e, ()):
                    if raw.startswith(pat, p):
                        out.append((p, pat))
        return out


class Patterns:
    """Windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str | None]], size: int):
        self.owners: dict[bytes, set[str]] = defaultdict(set)
        for item_id, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - size + 1) if words else 0):
                self.owners[b" " + b" ".join(words[i:i + size]) + b" "].add(item_id)
        by_class = defaultdict(list)  # short patterns must not shorten the skips of long ones
        for p in self.owners:
            by_class[min(5, len(p).bit_length())].append(p)
        self.groups = [_Group(ps) for ps in by_class.values()]
        self.n_words = {p: p.count(b" ") - 1 for p in self.owners}

    def search(self, texts: list[str | None]) -> list[tuple[int, np.ndarray, set[str]]]:
        """For each text: its number of words, the words hit, the items."""
        split = [words_of(t) for t in texts]
        parts = [b"\n " + b" ".join(ws) + b" " for ws in split]
        raw = b"".join(parts)
        buf = np.frombuffer(raw + b"\0" * 16, dtype=np.uint8)
        begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        hits: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        found = [x for g in self.groups for x in g.find(raw, buf)]
        if found:
            spaces = np.flatnonzero(buf[:len(raw)] == 32)
            place = np.array([p for p, _ in found])
            doc = np.searchsorted(begin, place, side="right") - 1
            word = np.searchsorted(spaces, place) - np.searchsorted(spaces, begin[doc])
            for d, w, (_, pat) in zip(doc.tolist(), word.tolist(), found):
                hits[d].append((w, pat))
        out = []
        for d, ws in enumerate(split):
            mark, owners = np.zeros(len(ws) + 1 if d in hits else 0, dtype=np.int64), set()
            for w, pat in hits.get(d, ()):
                mark[w] += 1
                mark[w + self.n_words[pat]] -= 1
                owners |= self.owners[pat]
            out.append((len(ws), np.flatnonzero(np.cumsum(mark) > 0), owners))
        return out


_CACHE: dict[tuple, Patterns] = {}


def _patterns(items: tuple, size: int) -> Patterns:
    """One block's tables, built once per worker."""
    if (items, size) not in _CACHE:
        _CACHE.clear()
        _CACHE[(items, size)] = Patterns(list(items), size)
    return _CACHE[(items, size)]


def _blocks(items: DataFrame):
    """The benchmark as lists of (id, text), each of about BLOCK_BYTES."""
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    n = parts_for(total, BLOCK_BYTES)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).distinct()
        yield tuple(sorted((str(r["item_id"]), r["text"] or "") for r in part.collect()))


def _pass(docs: DataFrame, text: str, items: tuple, size: int, before: list[str]) -> DataFrame:
    def run(cols):
        n, hit, owners = [], [], []
        texts = cols[0].to_pylist()
        for a in range(0, len(texts), 500):
            for c, h, o in _patterns(items, size).search(texts[a:a + 500]):
                n.append(c), hit.append(h), owners.append(o)
        if before:  # what earlier blocks found
            hit = [np.union1d(h, np.array(o or [], dtype=np.int64)) for h, o in zip(hit, cols[1].to_pylist())]
            owners = [s | set(o or ()) for s, o in zip(owners, cols[2].to_pylist())]
        return [pa.array(n, pa.int64()), pa.array([h.astype(np.int32) for h in hit], pa.list_(pa.int32())),
                pa.array([sorted(o) for o in owners], pa.list_(pa.string()))]

    return map_rows(docs, [text, *before], run, "n_words long, hit_words array<int>, hit_items array<string>")


def mark_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", size: int = WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (indices of words inside an
    occurrence) and ``hit_items`` (ids, as text, of items with occurrences).

    A null or empty text has no words and no hits; an item without words has
    no window, one with fewer than ``size`` words is one window; a null item
    id reads ``None``; repeated rows are each marked; an empty benchmark marks
    nothing.  All columns of ``docs`` stay; new names that are taken get
    underscores.
    """
    items = pick(items, item_id=item_id, text=item_text)
    keep, out = list(docs.columns), docs
    for k, block in enumerate(_blocks(items)):
        if k == 0:
            out = _pass(docs, text_col, block, size, [])
            continue
        n, h, o = out.columns[-3:]
        nxt = _pass(materialize(out, "decon"), text_col, block, size, [h, o])
        w = len(keep)  # the three columns of the blocks so far are replaced
        nxt = nxt.toDF(*[f"c{i}" for i in range(w + 6)])
        out = nxt.select(*[f"c{i}" for i in (*range(w), w + 3, w + 4, w + 5)]).toDF(*keep, n, h, o)
    return out
