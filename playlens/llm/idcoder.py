"""Token-id files written by an adaptive context-mixing range coder.

A block holds at most ``BLOCK`` ids and stands alone: every model starts anew
in it and a checksum covers it.  Ids are coded one after another:

* order 2 and order 1 each predict the id last seen after the same two ids or
  one id; the prediction of the higher order that has one is the candidate;
* three adaptive estimates that the candidate is right (by the order-2 and the
  order-1 predictor's record and agreement, and by the candidate's order-0
  count) are mixed in the logistic domain with weights learned on the way,
  and a range coder codes right or wrong with the mixed probability;
* a wrong (or missing) candidate is followed by the id under the adaptive
  order-0 counts, kept for all prefixes of 4, 8, 12 and 16 bits; an id new to the
  block is coded as such and then evenly over the vocabulary.

All arithmetic is on integers, so decoding repeats it exactly.  Many blocks
are coded side by side as lanes of NumPy arrays: the steps of a block are
sequential, the lanes of a step are not.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import in_blocks, materialize, parts_for, pick, prefix_offsets
from playlens.llm.tokens import BLOCK_BYTES, tokenizer

BLOCK = 4096
#: Blocks coded side by side at most, about 0.2 MB of models each, and blocks collected for that,
#: so that they are dealt evenly.
LANES, HELD = 850, 4000
#: Text bytes per file.
FILE_BYTES = 16 << 20
MAGIC = b"IDCM"
_STEP = 3           # order-0 count of one occurrence: a block's counts fit 16 bits
_TABLE = 12         # bits of the order-1 and order-2 tables
_WORD = np.uint64(32)
_TOP = np.uint64(1 << 32)
_BOT = np.uint64(1 << 26)
# logistic mixing in fixed point: probabilities of 12 bits, logits of 8 fraction bits
_P = np.arange(4096)
_STRETCH = np.clip(np.round(np.log((_P + 0.5) / (4095.5 - _P)) * 256), -2047, 2047).astype(np.int64)
_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 16, 4080).astype(np.int64)


class _Model:
    """Adaptive state of many lanes."""

    def __init__(self, lanes: int, bits: int):
        levels = -(-bits // 4)
        size = [16 << (4 * i) for i in range(levels)]
        self.lane = np.arange(lanes)
        # order-0 counts of all id prefixes of 4, 8, ... bits, sixteen siblings in a row
        self.tree = np.zeros(lanes * sum(size), dtype=np.uint16)
        self.rows = self.tree.reshape(-1, 16)
        self.base = self.lane * sum(size)
        self.level = np.cumsum([0, *size[:-1]])
        self.shift = np.arange(4 * (levels - 1), -1, -4)
        self.leaf, self.places = int(self.level[-1]), np.arange(16)
        self.seen, self.kinds = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
        self.first = np.zeros(lanes << _TABLE, dtype=np.int32)   # id + 1, its record in the top bits
        self.second = np.zeros(lanes << _TABLE, dtype=np.int32)
        self.base12 = self.lane << _TABLE
        self.prob = np.full(lanes * 96, 2048, dtype=np.int64)    # three sets of adaptive estimates
        self.weight = np.full((lanes, 3), 1 << 15, dtype=np.int64)
        self.p1, self.p2 = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)

    def predict(self, k: np.ndarray):
        """Candidate of lanes k (-1: none), its mixed probability of 12 bits and the contexts used."""
        low = (1 << _TABLE) - 1
        at1 = self.base12[k] + (self.p1[k] * 40503 >> 3 & low)
        at2 = self.base12[k] + ((self.p2[k] * 40503 + self.p1[k]) * 2654435761 >> 9 & low)
        e1, e2 = self.first[at1], self.second[at2]
        id1, id2, r1, r2 = (e1 & 0xFFFFF) - 1, (e2 & 0xFFFFF) - 1, e1 >> 20, e2 >> 20
        cand = np.where(id2 >= 0, id2, id1)
        c0 = self.tree[self.base[k] + self.leaf + np.maximum(cand, 0)] // _STEP
        ctx = np.stack([r2 * 2 + (id2 >= 0), 32 + r1 * 2 + (id1 == cand),
                        64 + np.minimum(np.frexp(c0.astype(np.float64))[1], 15) * 2 + (id2 >= 0)], axis=1) + (k * 96)[:, None]
        p = self.prob[ctx]
        st = _STRETCH[np.clip(p, 0, 4095)]
        dot = (st * self.weight[k]).sum(axis=1) >> 16
        return cand, _SQUASH[np.clip(dot, -2047, 2047) + 2047], (at1, at2, id1, id2, r1, r2, ctx, p, st)

    def learn(self, k, x, cand, mixed, seen, hit) -> None:
        at1, at2, id1, id2, r1, r2, ctx, p, st = seen
        had = cand >= 0
        err = np.where(had, np.where(hit, 4095, 0) - mixed, 0)
        self.weight[k] = np.clip(self.weight[k] + ((st * err[:, None] + (1 << 12)) >> 13), -(1 << 18), 1 << 18)
        goal = np.where(hit, 4095, 0)[:, None]
        self.prob[ctx] = np.where(had[:, None], p + ((goal - p) >> 5), p)
        self.first[at1] = np.where(id1 == x, (np.minimum(r1 + 1, 15) << 20) | (x + 1),
                                   np.where((r1 > 1) & (id1 >= 0), e_dec(r1, id1), x + 1))
        self.second[at2] = np.where(id2 == x, (np.minimum(r2 + 1, 15) << 20) | (x + 1),
                                    np.where((r2 > 1) & (id2 >= 0), e_dec(r2, id2), x + 1))
        self._count(k, x)
        self.p2[k], self.p1[k] = self.p1[k], x

    def _paths(self, k, x):
        """Places of x's prefixes, one column for each level."""
        return self.base[k][:, None] + self.level + (x[:, None] >> self.shift)

    def _count(self, k, x) -> None:
        at = self._paths(k, x)
        self.kinds[k] += self.tree[at[:, -1]] == 0
        self.tree[at] += np.uint16(_STEP)
        self.seen[k] += _STEP

    def interval(self, k, x):
        """(sum of smaller ids' counts, own count)."""
        at = self._paths(k, x)
        smaller = self.places < (at & 15)[:, :, None]
        return (self.rows[at >> 4] * smaller).sum(axis=(1, 2), dtype=np.int64), self.tree[at[:, -1]].astype(np.int64)

    def locate(self, k, goal):
        """The id whose interval holds goal, with that interval."""
        x, cum, base = np.zeros(len(k), dtype=np.int64), np.zeros(len(k), dtype=np.int64), self.base[k]
        each = np.arange(len(k))
        for off in self.level:
            row = self.rows[(base + off + (x << 4)) >> 4]
            upto = np.cumsum(row, axis=1, dtype=np.int64)
            digit = np.minimum((upto <= (goal - cum)[:, None]).sum(axis=1), 15)
            own = row[each, digit].astype(np.int64)
            cum += upto[each, digit] - own
            x = (x << 4) + digit
        return x, cum, own


def e_dec(record, ident):
    """A predictor's entry after a miss: half the record, same id."""
    return ((record >> 1) << 20) | (ident + 1)


class _Coder:
    """Carry-less range coders of 64 bits, 32 bits moved at a time."""

    def __init__(self, lanes: int, words: list[np.ndarray] | None, room: int):
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        self.at = np.zeros(lanes, dtype=np.int64)
        self.read = words is not None
        width = max([room, *(len(w) for w in words or [])]) + 4
        self.buf = np.zeros((lanes, width), dtype=np.uint32)
        if self.read:
            for i, w in enumerate(words):
                self.buf[i, :len(w)] = w
            self.code = (self.buf[:, 0].astype(np.uint64) << _WORD) | self.buf[:, 1]
            self.at += 2

    def goal(self, k, total) -> np.ndarray:
        step = self.range[k] // total
        return np.minimum((self.code[k] - self.low[k]) // step, total - np.uint64(1))

    def narrow(self, k, cum, freq, total) -> None:
        step = self.range[k] // total
        low, rng = self.low[k] + cum * step, freq * step
        while True:
            same = (low ^ (low + rng)) < _TOP
            small = (rng < _BOT) & ~same
            move = same | small
            if not move.any():
                break
            rng = np.where(small, (~low + np.uint64(1)) & (_BOT - np.uint64(1)), rng)
            m = k[move]
            if self.read:
                self.code[m] = (self.code[m] << _WORD) | self.buf[m, np.minimum(self.at[m], self.buf.shape[1] - 1)]
            else:
                self.buf[m, self.at[m]] = (low[move] >> _WORD).astype(np.uint32)
            self.at[m] += 1
            low = np.where(move, low << _WORD, low)
            rng = np.where(move, rng << _WORD, rng)
        self.low[k], self.range[k] = low, rng

    def flush(self) -> list[np.ndarray]:
        for i in range(len(self.low)):
            n = self.at[i]
            self.buf[i, n], self.buf[i, n + 1] = self.low[i] >> _WORD, self.low[i] & np.uint64(0xFFFFFFFF)
        return [self.buf[i, :n + 2] for i, n in enumerate(self.at.tolist())]


_CERTAIN = np.uint64(4096)


def turns(n: int) -> list[tuple[int, int]]:
    """Bounds of as few runs of n blocks as ``LANES`` allows, of about the same length."""
    runs = -(-n // LANES)
    return [(i * n // runs, (i + 1) * n // runs) for i in range(runs)]


def encode_lanes(blocks: list[np.ndarray], vocab: int) -> list[np.ndarray]:
    """Each block's ids (below ``vocab``) as words of the range coder."""
    return _code(blocks, [len(b) for b in blocks], vocab, None)


def decode_lanes(words: list[np.ndarray], lengths: list[int], vocab: int) -> list[np.ndarray]:
    return _code(None, lengths, vocab, words)


def _code(blocks, lengths, vocab, words):
    n, bits = len(lengths), max(1, int(vocab - 1).bit_length())
    longest = max(lengths, default=0)
    model, coder = _Model(n, bits), _Coder(n, words, 8 + longest)
    size = np.asarray(lengths)
    ids = np.zeros((n, longest), dtype=np.int64)
    for i, b in enumerate(blocks or []):
        ids[i, :len(b)] = b
    k = np.arange(n)
    for t in range(longest):
        if size[k].min() <= t:
            k = k[size[k] > t]
        cand, mixed, seen = model.predict(k)
        had = np.flatnonzero(cand >= 0)
        hit = np.zeros(len(k), dtype=bool)
        x = ids[k, t]
        if len(had):
            p, kh = mixed[had].astype(np.uint64), k[had]
            if words is None:
                hit[had] = x[had] == cand[had]
            else:
                hit[had] = coder.goal(kh, _CERTAIN) < p
            right = hit[had]
            coder.narrow(kh, np.where(right, np.uint64(0), p), np.where(right, p, _CERTAIN - p), _CERTAIN)
        miss = np.flatnonzero(~hit)
        if len(miss):
            km = k[miss]
            seen0, new = model.seen[km], 2 + model.kinds[km]   # share of ids not yet seen in the block
            total = (seen0 + new).astype(np.uint64)
            if words is None:
                cum, freq = model.interval(km, x[miss])
                fresh = freq == 0
            else:
                goal = coder.goal(km, total).astype(np.int64)
                fresh = goal >= seen0
                x[miss], cum, freq = model.locate(km, np.where(fresh, 0, goal))
            cum, freq = np.where(fresh, seen0, cum), np.where(fresh, new, freq)
            coder.narrow(km, cum.astype(np.uint64), freq.astype(np.uint64), total)
            if fresh.any():
                kf, every = km[fresh], np.full(int(fresh.sum()), vocab, dtype=np.uint64)
                if words is not None:
                    x[miss[fresh]] = coder.goal(kf, every).astype(np.int64)
                coder.narrow(kf, x[miss[fresh]].astype(np.uint64), np.ones(len(kf), dtype=np.uint64), every)
        if words is not None:
            x = np.where(hit, cand, x)
            ids[k, t] = x
        model.learn(k, x, cand, mixed, seen, hit)
    return coder.flush() if words is None else [ids[i, :m] for i, m in enumerate(lengths)]


# ---- blocks ----------------------------------------------------------------------

def seal(words: np.ndarray, n: int, table: list[tuple[int, int, int, int]]) -> bytes:
    """A block's bytes: head, table of (document number, its ids in earlier
    blocks, ids here, all its ids), coder words, checksum."""
    rows = np.asarray(table, dtype="<i8").tobytes()
    body = MAGIC + struct.pack("<III", n, len(table), len(words)) + rows + words.astype("<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def unseal(block: bytes) -> tuple[np.ndarray, int, np.ndarray]:
    body, (crc,) = block[:-4], struct.unpack("<I", block[-4:])
    if body[:4] != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("damaged block of token ids")
    n, docs, words = struct.unpack("<III", body[4:16])
    at = 16 + 32 * docs
    return (np.frombuffer(body, "<u4", words, at), n, np.frombuffer(body, "<i8", 4 * docs, 16).reshape(docs, 4))


_FILE = "file int, block int, before long, ids long, doc_ids array<{}>, bytes binary"


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, id_col: str = "doc_id",
              text_col: str = "text", file_bytes: int = FILE_BYTES, block: int = BLOCK) -> None:
    """Encode all texts and write their ids in ascending order of ``id_col``.

    Files hold rows of blocks; ``before`` counts the ids of the file's earlier
    blocks, ``doc_ids`` are the documents with ids in the block.  Null texts
    are empty, null ids come first, repeated rows are written each, an empty
    table gives no blocks; other columns are ignored.  Equal ids are split
    over files by their texts.
    """
    slim = pick(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    total = slim.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0]
    ordered = (slim.withColumn("h", F.xxhash64("text"))
               .repartitionByRange(parts_for(total, file_bytes), "doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h"))
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    id_type = pa.int64() if kind == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, file = tokenizer(vocabulary), TaskContext.get().partitionId()
        vocab = tok.tok.get_vocab_size()
        done: list[tuple[np.ndarray, list, list]] = []   # full blocks: ids, table, document ids
        ids: list[np.ndarray] = []
        table: list[tuple[int, int, int, int]] = []
        names: list = []
        held, doc_no, number, before = 0, 0, 0, 0

        def close():
            nonlocal ids, table, names, held
            done.append((np.concatenate(ids), table, names))
            ids, table, names, held = [], [], [], 0

        def out():
            nonlocal done, number, before
            for a, z in turns(len(done)):
                coded = encode_lanes([d[0] for d in done[a:z]], vocab)
                rows = [[], [], [], [], [], []]
                for (b, tab, who), words in zip(done[a:z], coded):
                    for col, v in zip(rows, (file, number, before, len(b), who, seal(words, len(b), tab))):
                        col.append(v)
                    number, before = number + 1, before + len(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()),
                     pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.list_(id_type or of)), pa.array(rows[5], pa.binary())],
                    ["file", "block", "before", "ids", "doc_ids", "bytes"])
            done = []

        of = None
        for batch in batches:
            of = batch.schema.field("doc_id").type
            for b in in_blocks(batch, 1, BLOCK_BYTES // 4):
                for who, raw in zip(b.column("doc_id").to_pylist(), tok.encode(b.column("text"))):
                    doc, at = np.frombuffer(raw + end, dtype="<u4"), 0
                    while at < len(doc) or not len(doc):
                        part = doc[at:at + block - held]
                        ids.append(part)
                        table.append((doc_no, at, len(part), len(doc)))
                        names.append(who)
                        held, at = held + len(part), at + len(part)
                        if held == block:
                            close()
                            if len(done) == HELD:
                                yield from out()
                        if not len(doc):
                            break
                    doc_no += 1
        if table:
            close()
        yield from out()

    ordered.mapInArrow(run, _FILE.format(kind)).write.parquet(path)


def read_ids(spark, path: str, vocab: int) -> DataFrame:
    """Each block's part of each document, decoded, with checksums verified:
    ``file``, ``before`` (ids of the file before the part), ``doc_no``,
    ``doc_id``, ``at`` (ids of the document before it), ``total`` (ids of the
    document), ``crc`` (of a document that lies in one block) or else ``ids``.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["file", "before", "doc_no", "at", "total", "crc", "ids", "doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z in turns(batch.num_rows):
                b = batch.slice(a, z - a)
                opened = [unseal(x) for x in b.column("bytes").to_pylist()]
                decoded = decode_lanes([w for w, _, _ in opened], [n for _, n, _ in opened], vocab)
                rows: list[list] = [[] for _ in range(7)]
                for file, before, ids, (_, _, table) in zip(b.column("file").to_pylist(), b.column("before").to_pylist(),
                                                            decoded, opened):
                    raw, at = ids.astype("<u4").tobytes(), 0
                    for doc_no, so_far, n, total in table.tolist():
                        part = raw[4 * at:4 * (at + n)]
                        one = n == total
                        for col, v in zip(rows, (file, before + at, doc_no, so_far, total,
                                                 zlib.crc32(part) if one else None, None if one else part)):
                            col.append(v)
                        at += n
                kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
                yield pa.RecordBatch.from_arrays([*[pa.array(r, t) for r, t in zip(rows, kinds)],
                                                  b.column("doc_ids").flatten()], names)

    return blocks.mapInArrow(run, "file int, before long, doc_no long, at long, total long, crc long, ids binary, "
                                  f"doc_id {kind}")


def read_documents(spark, path: str, vocab: int) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, from the files
    alone: ids of all documents before it, its number of ids, the checksum of
    all its ids.  Only documents that span blocks are brought together."""
    files = spark.read.parquet(path).groupBy("file").agg(F.sum("ids").alias("ids"))
    offsets = prefix_offsets(files, "file", "ids").select("file", F.col("before").alias("file_before"))
    parts = materialize(read_ids(spark, path, vocab), "ids")
    whole = parts.where("ids IS NULL").select("file", "doc_id", "before", "total", "crc")
    put = F.aggregate(F.array_sort(F.collect_list(F.struct("at", "ids"))), F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    spread = (parts.where("ids IS NOT NULL").groupBy("file", "doc_no")
              .agg(F.first("doc_id", ignorenulls=True).alias("doc_id"), F.min("before").alias("before"),
                   F.max("total").alias("total"), F.crc32(put).alias("crc"))
              .select("file", "doc_id", "before", "total", "crc"))
    return (whole.unionByName(spread).join(F.broadcast(offsets), "file")  # one row per file
            .select("doc_id", (F.col("file_before") + F.col("before")).alias("start"),
                    F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32")))
