"""Exact, memoised calls of the ``tokenizers`` library (runs inside tasks).

A byte-level BPE splits text into pieces before merging.  A single space
between two visible characters always starts a new piece, so a text may be
cut there and the cuts encoded on their own: the ids of the cuts, put
together, are the ids of the text.  Words repeat, so each worker keeps the
ids of the words it has seen last (``CACHE`` of them at most; the limit changes
speed only), and new words are encoded many at a time.  The words of all texts
of a call are one Arrow column, of which each different string is looked up
once, and ids are put together as arrays.  Texts with other white space beside
a space are cut only where the rule holds.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and other cuts, that a worker remembers, and the longest, in bytes.
CACHE, CACHE_CHARS = 700_000, 64
#: Text bytes that callers hand over at once: known words are looked up once a call.
BLOCK_BYTES = 4 << 20
# a space is a safe cut only between these: letters, digits, marks that no
# engine counts as white space
_UNSAFE = r" [^!-~¡-ᙿ、-\x{D7FF}]|[^!-~¡-ᙿ、-\x{D7FF}] |^ | \z|\x00"
_CUT = re.compile(r"(?<=[!-~¡-ᙿ、-퟿])(?= [!-~¡-ᙿ、-퟿])")
# a cut that may stand behind another one: a space and what may stand between two spaces that are safe cuts
_PLAIN_CUT = r"(?s)^ [!-~¡-ᙿ、-\x{D7FF}](?:.*[!-~¡-ᙿ、-\x{D7FF}])?\z"
# a word of Latin letters and the marks that may be parted from its end, two pieces of the vocabulary's rule
_WORD = r"^ [A-Za-zÀ-ÖØ-öø-ÿ]+\z"
_MARKS = "".join(chr(c) for r in ("!&", "(/", ":@", "[`", "{~") for c in range(ord(r[0]), ord(r[1]) + 1))
_INSTANCES: dict[tuple, "CutTokenizer"] = {}


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def default_path() -> str:
    """The byte-level vocabulary."""
    return tokenizer_file("byte_bpe_50k.json")


class Pieces:
    """Lists of numbers, one behind the other: ``flat`` and how many each list has."""

    def __init__(self, flat: np.ndarray, n: np.ndarray):
        self.flat, self.n = flat, n
        self.start = np.cumsum(n) - n

    def take(self, at: np.ndarray) -> "Pieces":
        n = self.n[at]
        end = np.cumsum(n)
        return Pieces(self.flat[np.repeat(self.start[at] - (end - n), n) + np.arange(end[-1] if len(end) else 0)], n)

    def sums(self, size: np.ndarray) -> "Pieces":
        """The same numbers as fewer lists, each of so many of these one behind the other."""
        return Pieces(self.flat, np.diff(np.cumsum(np.concatenate([[0], self.n]))[np.cumsum(np.concatenate([[0], size]))]))

    @staticmethod
    def join(parts: "list[Pieces]") -> "Pieces":
        return Pieces(np.concatenate([p.flat for p in parts]), np.concatenate([p.n for p in parts]))


class Known:
    """What a worker knows of strings: for each one list of every kind.

    Strings last asked for longest ago are forgotten beyond ``limit`` of them, strings over ``CACHE_CHARS``
    bytes at once; this changes speed only."""

    def __init__(self, limit: int):
        self.limit, self.clock = limit, 0
        self.words, self.used, self.lists = pa.array([], pa.large_string()), np.zeros(0, dtype=np.int64), None

    def __len__(self) -> int:
        return len(self.words)

    def find(self, words: pa.Array, make) -> list[Pieces]:
        """The lists of different strings; ``make(strings)`` gives those of strings not known."""
        self.clock += 1
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        if len(new) or self.lists is None:
            made = make(new)
            self.lists = [Pieces.join([x, y]) for x, y in zip(self.lists, made)] if self.lists else made
            self.words = pa.concat_arrays([self.words, new])
            self.used = np.concatenate([self.used, np.zeros(len(new), dtype=np.int64)])
        place = at.to_numpy(zero_copy_only=False)
        if len(new):
            place = np.where(np.isnan(place), 0, place).astype(np.int64) if place.dtype.kind == "f" else place.astype(np.int64)
            place[pc.is_null(at).to_numpy(zero_copy_only=False)] = np.arange(len(self.words) - len(new), len(self.words))
        self.used[place] = self.clock
        found = [x.take(place) for x in self.lists]
        size = pc.binary_length(new).to_numpy(zero_copy_only=False) if len(new) else np.zeros(0)
        if len(self.words) > self.limit or (size > CACHE_CHARS).any():
            stay = pc.binary_length(self.words).to_numpy(zero_copy_only=False) <= CACHE_CHARS
            if stay.sum() > self.limit:  # the later half
                stay &= self.used >= np.partition(self.used, -(self.limit // 2))[-(self.limit // 2)]
            if stay.sum() > self.limit:
                stay[:] = False
            keep = np.flatnonzero(stay)
            self.words, self.used = self.words.take(pa.array(keep)), self.used[keep]
            self.lists = [x.take(keep) for x in self.lists]
        return found


class CutTokenizer:
    """Encode texts by cuts; ids equal ``Tokenizer.encode`` on the whole text
    without special tokens around it.

    The strings of the vocabulary's added tokens stand for those tokens where a
    text has them, as in the library; with ``plain`` they are ordinary text.
    """

    def __init__(self, path: str, cache: int = CACHE, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = "|".join(map(re.escape, added)) if added and not plain else None
        self.known, self.older = Known(cache), ()
        # the letter that a byte-level vocabulary writes for each byte
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in visible]
        self.letters = {b: chr(256 + i) for i, b in enumerate(rest)}
        # bytes of each id: one letter a byte
        vocabulary = self.tok.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)

    def _each(self, cuts: list[str]) -> Pieces:
        ids = [e.ids for e in self.tok.encode_batch_fast(cuts, add_special_tokens=False)] if cuts else []
        return Pieces(np.fromiter(chain.from_iterable(ids), dtype=np.uint32), np.array([len(x) for x in ids], dtype=np.int64))

    def ids(self, cuts: pa.Array) -> Pieces:
        """Ids of cuts.  Those that may stand behind each other are encoded as one text,
        which is taken apart at its ends."""
        row = pc.match_substring_regex(cuts, _PLAIN_CUT)
        inside = row.to_numpy(zero_copy_only=False).astype(bool)
        one = cuts.filter(row)
        if len(one):
            ends = np.cumsum(pc.binary_length(one).to_numpy(zero_copy_only=False).astype(np.int64))
            text = "".join(one.to_pylist())
            ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            at = np.cumsum(self.sizes[ids])
            k = np.minimum(np.searchsorted(at, ends), len(at) - 1)
            if (at[k] == ends).all():
                together = Pieces(ids, np.diff(np.concatenate([[0], k + 1])))
                if inside.all():
                    return together
                apart = self._each(cuts.filter(pc.invert(row)).to_pylist())
                order = np.zeros(len(inside), dtype=np.int64)
                order[inside], order[~inside] = np.arange(len(one)), np.arange(len(one), len(inside))
                return Pieces.join([together, apart]).take(order)
        return self._each(cuts.to_pylist())

    def words(self, cuts: pa.Array) -> Pieces:
        """Ids of different cuts.  A word is parted from the marks after it, and each is encoded once,
        as long as it is known."""
        base = pc.utf8_rtrim(cuts, characters=_MARKS)
        parted = pc.and_(pc.match_substring_regex(base, _WORD), pc.less(pc.binary_length(base), pc.binary_length(cuts)))
        base = pc.if_else(parted, base, cuts)
        both = pa.concat_arrays([base, _behind(cuts, base)]).dictionary_encode()
        found = self.known.find(both.dictionary, lambda new: [self.ids(new)])[0]
        return found.take(both.indices.to_numpy().reshape(2, -1).T.ravel()).sums(np.full(len(cuts), 2))

    def pieces(self, texts: list[str | None] | pa.Array) -> Pieces:
        """Ids of each text; a null or empty text has none."""
        texts = column(texts)
        special = pc.fill_null(pc.match_substring_regex(texts, self.added), False) if self.added else None
        whole = pc.indices_nonzero(special).to_pylist() if self.added else []
        flat, size = cuts_of(pc.replace_with_mask(texts, special, pa.scalar("", pa.large_string())) if whole else texts, " ")
        coded = flat.dictionary_encode()
        of_each = self.words(coded.dictionary)
        out = of_each.take(coded.indices.to_numpy()).sums(size)
        if whole:
            order = np.arange(len(texts))
            order[whole] = np.arange(len(texts), len(texts) + len(whole))
            out = Pieces.join([out, self._each(texts.take(pa.array(whole)).to_pylist())]).take(order)
        return out

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null
        or empty text has none."""
        got = self.pieces(texts)
        raw, end = got.flat.astype("<u4").tobytes(), (4 * np.cumsum(got.n)).tolist()
        return [raw[i:j] for i, j in zip([0, *end[:-1]], end)]


def bytes_of(words: pa.Array) -> Pieces:
    """The bytes of an Arrow column of large strings."""
    _, offsets, data = words.buffers()
    if not len(words) or data is None:
        return Pieces(np.zeros(0, dtype=np.uint8), np.zeros(len(words), dtype=np.int64))
    at = np.frombuffer(offsets, dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    return Pieces(np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], np.diff(at))


def strings_of(got: Pieces) -> pa.Array:
    """The reverse of ``bytes_of``."""
    off = np.concatenate([[0], np.cumsum(got.n)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(got.n), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(got.flat)))


def _behind(long: pa.Array, short: pa.Array) -> pa.Array:
    """What is left of strings behind their starts."""
    rest = bytes_of(long)
    gone = pc.binary_length(short).to_numpy(zero_copy_only=False).astype(np.int64)
    rest.start, rest.n = rest.start + gone, rest.n - gone
    return strings_of(rest.take(np.arange(len(long))))


def column(texts: list[str | None] | pa.Array) -> pa.Array:
    """Texts as an Arrow column of its own: of a slice that is only cast, ``if_else`` takes wrong bytes (Arrow 23)."""
    return pa.concat_arrays([texts.cast(pa.large_string())]) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())


def cuts_of(texts: pa.Array, before: str) -> tuple[pa.Array, np.ndarray]:
    """Cuts of all texts one behind the other, each but a text's first with ``before`` in place of
    the space it starts with, and how many a text has."""
    none = pa.scalar(None, pa.large_string())
    texts = pc.replace_with_mask(texts, pc.fill_null(pc.equal(texts, ""), False), none)
    odd = pc.fill_null(pc.match_substring_regex(texts, _UNSAFE), False)
    plain = pc.replace_with_mask(texts, odd, none)
    split = pc.split_pattern(pc.replace_substring(plain, " ", "\0" + before) if before else plain, "\0" if before else " ")
    size = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    places = pc.indices_nonzero(odd).to_pylist()
    if not places:
        return split.flatten(), size
    lists = split.to_pylist()
    for i in places:
        first, *others = _CUT.split(texts[i].as_py())
        lists[i] = [first, *[before + c[1:] for c in others]]
    flat = [x or [] for x in lists]
    return pa.array(list(chain.from_iterable(flat)), pa.large_string()), np.array([len(x) for x in flat], dtype=np.int64)


def tokenizer(path: str, plain: bool = False) -> CutTokenizer:
    """The worker's tokenizer for a vocabulary file (one per process)."""
    if (path, plain) not in _INSTANCES:
        _INSTANCES[path, plain] = CutTokenizer(path, plain=plain)
    return _INSTANCES[path, plain]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
