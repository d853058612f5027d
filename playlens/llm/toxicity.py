"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text.  The ordinary one
holds what ordinary text repeats; the toxic one is the same with a part
trained on what toxic text repeats and ordinary text does not, so that their
difference on a window is what toxic content saves.  A text is cut into
windows of at most ``WINDOW`` bytes (words in lower case, punctuation gone),
each window is compressed with both dictionaries, and the windows whose
lengths differ by a threshold or more are counted.

The counts at several thresholds, the largest difference and the number of
windows are calibrated to a score by logistic regression on labelled
documents that trained no dictionary; the decision point is put at 0.7.

Only the fit is bounded: at most ``FIT_TOXIC`` and ``FIT_ORDINARY`` labelled
documents of at most ``FIT_BYTES`` bytes, drawn by a hash of their ids.  Every
whole text is scored, in tasks, without a shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import map_rows, pick

FIT_TOXIC, FIT_ORDINARY, FIT_BYTES = 3000, 6000, 12_000
#: Share of the drawn documents that trains dictionaries; the rest calibrates.
DICTIONARY_SHARE = 0.55
WINDOW = 56
ORDINARY_DICT, TOXIC_DICT = 1280, 1024
THRESHOLDS = (2, 3, 4, 5, 6, 8)
DECISION = 0.7
#: Share of the ordinary calibration documents that the cut may reject at most.
MOST_FALSE = 0.02
#: Least log of the odds against chance at which a word's beginning tells toxic text.
CHANCE = 16.0
#: Marks of word neighbourhoods met in the training documents.
SEEN = 1 << 25
_NO_WORD = re.compile(rb"[\x00-\x60\x7b-\x7f]+")


def _written(word: bytes) -> bytes:
    """The word with its first four bytes written twice: a stem in common then
    saves more than the few bytes that naming a match costs."""
    return word[:4] + word if len(word) >= 4 else word


def windows(text: str | None) -> list[bytes]:
    """Windows of whole words; words beyond a window's length are cut up."""
    low = _NO_WORD.sub(b" ", (text or "").lower().encode("utf-8", "surrogatepass"))
    out, cur = [], b" "
    for w in low.split():
        while len(w) > WINDOW - 6:
            out.append(b" " + _written(w[:WINDOW - 6]) + b" ")
            w = w[WINDOW - 6:]
        w = _written(w)
        if len(cur) + len(w) + 1 > WINDOW:
            out.append(cur)
            cur = b" "
        cur += w + b" "
    if len(cur) > 1:
        out.append(cur)
    return out


def _starts(word: bytes) -> list[bytes]:
    """Beginnings of a word by which it is judged."""
    return [(b" " + word)[:n] for n in (5, 6, 7)] if len(word) >= 4 else []


def _fresh(words: list[bytes], seen: bytearray) -> set[bytes]:
    """Words that stand between neighbours they did not stand between before,
    so that near copies of a document count as one."""
    out = set()
    for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
        at = zlib.crc32(before + b" " + word + b" " + after) % len(seen)
        if not seen[at]:
            seen[at] = 1
            out.add(word)
    return out


def _train(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary's content; too few samples serve as they are."""
    import zstandard

    samples = [s for s in samples if len(s) > 8]
    try:
        return zstandard.train_dictionary(size, samples * (1 + 200 // max(1, len(samples)))).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Model:
    """The two dictionaries and the calibration; small enough to travel with each task."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = ordinary, toxic
        self.mean = self.scale = self.weights = None
        self.bias, self.shift = 0.0, 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_c")}

    def _compressors(self):
        if "_c0" not in self.__dict__:
            import zstandard as z

            made = []
            for content in (self.ordinary, self.ordinary + self.toxic):
                params = z.ZstdCompressionParameters(strategy=z.STRATEGY_GREEDY, window_log=12, hash_log=12,
                                                     chain_log=12, search_log=4, min_match=5,
                                                     write_content_size=False)
                d = z.ZstdCompressionDict(content or b" ", dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                made.append(z.ZstdCompressor(compression_params=params, dict_data=d).compress)
            self._c0, self._c1 = made
        return self._c0, self._c1

    def differences(self, text: str | None) -> np.ndarray:
        """Bytes saved by the toxic dictionary, window by window."""
        c0, c1 = self._compressors()
        return np.array([len(c0(w)) - len(c1(w)) for w in windows(text)], dtype=np.int64)

    def features(self, text: str | None) -> list[float]:
        d = self.differences(text)
        if not len(d):
            return [0.0] * (2 * len(THRESHOLDS) + 2)
        n = [int((d >= t).sum()) for t in THRESHOLDS]
        return [float(d.max()), math.log1p(len(d)), *[math.log1p(x) for x in n], *[math.sqrt(x / len(d)) for x in n]]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Ridge-penalised logistic regression by Newton steps, then the shift
        that puts the best F1 on the calibration documents at DECISION, but not
        more than MOST_FALSE of the ordinary ones above it."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        w, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], 1.0)
        ridge[0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(h, z.T @ (p - y) + ridge * w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.bias, self.weights = float(w[0]), w[1:]
        logit = z @ w
        order = np.argsort(-logit, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
        best = int(np.argmax(f1))
        edge = logit[order][best] if best + 1 == len(y) else (logit[order][best] + logit[order][best + 1]) / 2
        # with few toxic documents the best F1 is chance: the cut leaves alone all but a few ordinary ones
        ordinary = np.sort(logit[y == 0])
        if len(ordinary) and len(ordinary) < len(y):
            edge = max(edge, ordinary[len(ordinary) - 1 - int(MOST_FALSE * len(ordinary))] + 1e-6)
        self.shift = float(math.log(DECISION / (1 - DECISION)) - edge)

    def score(self, text: str | None) -> float:
        f = (np.array(self.features(text)) - self.mean) / self.scale
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.shift + float(f @ self.weights))))))


def held_out(doc_id: Column) -> Column:
    """Rows no label of which may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(examples: list[tuple[str | None, int]]) -> Model:
    """A model from labelled texts, in the given order; copies count once."""
    seen, rows = set(), []
    for text, label in examples:
        if text not in seen:
            seen.add(text)
            rows.append((text, int(label)))
    share = max(1, int(len(rows) * DICTIONARY_SHARE))
    train = rows[:share]
    words = [(_NO_WORD.sub(b" ", (t or "").lower().encode("utf-8", "surrogatepass")).split(), y) for t, y in train]
    df: tuple[Counter, Counter] = (Counter(), Counter())
    count = [sum(1 for _, y in train if y == k) for k in (0, 1)]
    seen = bytearray(SEEN)
    for ws, y in words:
        df[y].update({s for w in _fresh(ws, seen) for s in _starts(w)})

    base = (count[1] + 0.5) / (count[0] + count[1] + 1)

    def marks(s: bytes) -> bool:
        """Ten times as frequent in toxic documents, and more than chance brings about."""
        n1, n0 = df[1][s], df[0][s]
        if n1 * (count[0] + 1) <= 10 * (n0 + 0.5) * count[1]:
            return False
        q = n1 / (n1 + n0)
        surprise = n1 * math.log(q / base) + (n0 * math.log((1 - q) / (1 - base)) if n0 else 0.0)
        return surprise > CHANCE

    telling_starts = {s for s in df[1] if marks(s)}

    def telling(word: bytes) -> bool:
        return not telling_starts.isdisjoint(_starts(word))

    toxic = [b" " + b" ".join(_written(w) for w in ws if telling(w)) + b" " for ws, y in words if y]
    ordinary = [b" " + b" ".join(map(_written, ws)) + b" " for ws, y in words if not y]
    model = Model(_train(ordinary, ORDINARY_DICT), _train(toxic, TOXIC_DICT))
    rest = rows[share:] or rows
    model.calibrate(np.array([model.features(t) for t, _ in rest]).reshape(len(rest), -1) if rest
                    else np.zeros((1, 2 * len(THRESHOLDS) + 2)),
                    np.array([y for _, y in rest] or [0], dtype=np.float64))
    return model


def fit_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_id: str = "doc_id", label_col: str = "toxic") -> Model:
    """A model from a bounded sample of labelled rows that are not held out.

    Null labels, ids and texts teach nothing; without labels of both kinds all
    scores are low and equal.
    """
    marks = pick(labels, id=label_id, y=label_col).where("id IS NOT NULL AND y IN (0, 1)").where(~held_out(F.col("id")))
    texts = pick(docs, id=id_col, text=text_col).where(F.octet_length("text").between(1, FIT_BYTES))
    chosen = []
    for y, most in ((1, FIT_TOXIC), (0, FIT_ORDINARY)):
        drawn = marks.where(F.col("y") == y).select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(most)
        got = (texts.join(F.broadcast(drawn), "id")  # at most FIT_ORDINARY ids
               .groupBy("id").agg(F.min("text").alias("text"))  # one row each
               .withColumn("h", F.xxhash64("id")).toPandas())
        chosen += [(h, t, y) for h, t in zip(got["h"], got["text"])]
    return fit([(t, y) for _, t, y in sorted(chosen)])


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 at DECISION or more).

    Null and empty texts have no windows and the score of that; very long
    texts are scored whole; repeated rows each; an empty table gives no rows;
    all columns stay, and taken names get underscores.
    """
    def run(cols):
        s = [model.score(t.as_py()) for t in cols[0]]
        return [pa.array(s, pa.float64()), pa.array([int(x >= DECISION) for x in s], pa.int32())]

    return map_rows(docs, [text_col], run, "score double, predicted int")
