"""Near-duplicate vectors by a forest of random-projection trees.

Trees split recursively by random directions at the median, with overlap: a
band around the median (``SPILL`` of the rows to each side) goes to both
children.  The top of each tree is fitted on a bounded sample of vectors, but
every vector is sent down every tree; below that a task splits its group on,
until leaves hold at most ``LEAF`` vectors.  All pairs of a leaf are compared
in double precision, and each vector keeps one verified link towards the
smallest vector of its leaf component.  The links of all trees are united by
distributed union-find.

Numbers of links are then counted exactly within components: a component is
dealt into blocks, pairs of blocks are compared, and only counts leave a
task.  Equal vectors are one vector with a weight throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import materialize, pick
from playlens.llm.components import components

TREES = 10
SPILL = 0.06
LEAF = 1024
#: Vectors in the bounded sample that the tops of the trees are fitted on.
SAMPLE = 50_000
#: Sampled vectors a fitted node keeps at least.
NODE_SAMPLE = 60
SEED = 977
#: Vectors in a block of a component.
BLOCK = 1024


def _unit(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _direction(tree: int, node: int, dim: int) -> np.ndarray:
    return np.random.default_rng((SEED, tree, node)).standard_normal(dim)


def fit_tree(sample: np.ndarray, tree: int) -> dict[int, tuple[float, float]]:
    """Bands (low, high) of the fitted nodes; node 1 is the root, 2n and 2n+1
    are the children of n."""
    bands: dict[int, tuple[float, float]] = {}
    todo = [(1, np.arange(len(sample)))]
    while todo:
        node, at = todo.pop()
        if len(at) < 2 * NODE_SAMPLE:
            continue
        p = sample[at] @ _direction(tree, node, sample.shape[1])
        low, high = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
        bands[node] = (float(low), float(high))
        todo += [(2 * node, at[p <= high]), (2 * node + 1, at[p >= low])]
    return bands


def send_down(x: np.ndarray, tree: int, bands: dict[int, tuple[float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) for every fitted leaf that a row reaches."""
    rows, nodes, todo = [], [], [(1, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node not in bands:
            rows.append(at), nodes.append(np.full(len(at), node, dtype=np.int64))
            continue
        low, high = bands[node]
        p = x[at] @ _direction(tree, node, x.shape[1])
        todo += [(2 * node, at[p <= high]), (2 * node + 1, at[p >= low])]
    return (np.concatenate(rows), np.concatenate(nodes)) if rows else (np.zeros(0, int), np.zeros(0, int))


def leaves(x: np.ndarray, tree: int, node: int) -> list[np.ndarray]:
    """A group's rows, split on until at most LEAF are together."""
    out, todo = [], [(node, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if len(at) <= LEAF:
            out.append(at)
            continue
        p = x[at] @ _direction(tree, node, x.shape[1])
        low, high = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
        a, b = at[p <= high], at[p >= low]
        if max(len(a), len(b)) > 0.9 * len(at):  # ties on the band: halve by rank, a little shared
            order = at[np.argsort(p, kind="stable")]
            cut = len(at) // 2
            a, b = order[:cut + len(at) // 16], order[cut - len(at) // 16:]
        todo += [(2 * node % (1 << 62), a), ((2 * node + 1) % (1 << 62), b)]
    return out


def spanning(x: np.ndarray, names: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Verified links that span the components of a leaf."""
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    links, unseen = [], np.ones(len(x), dtype=bool)
    for start in np.argsort(names, kind="stable").tolist():
        if not unseen[start]:
            continue
        unseen[start] = False
        todo = [start]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(near[i] & unseen)
            unseen[new] = False
            links += [(int(names[j]), int(names[i])) for j in new]
            todo += new.tolist()
    return links


def vector_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 least: float = 0.95, trees: int = TREES) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links`` (other vectors
    linked directly), ``component_id`` (smallest id reachable), ``kept``.

    Null, empty and zero vectors, and those with null, infinite or NaN parts
    link with nothing; vectors of different length never link; rows with a
    null id link with nothing; repeated rows are vectors of their own; an
    empty table gives no rows; other columns are ignored.  ``least`` must be
    above zero.
    """
    v = pick(vectors, vec_id=id_col, vec=vec_col).withColumn("vec", F.col("vec").cast("array<double>"))
    sound = (F.col("vec_id").isNotNull() & (F.size("vec") > 0)
             & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("vec", lambda x: x != 0))
    v = v.withColumn("ok", F.coalesce(sound, F.lit(False)))
    # equal vectors are one, named by the smallest id
    same = v.where("ok").groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    reps = materialize(same, "vectors")
    member = v.where("ok").join(reps, "vec").select("vec_id", "rep")

    links = None
    for (dim,) in reps.select(F.size("vec")).distinct().collect():
        of = _forest_links(reps.where(F.size("vec") == dim), int(dim), least, trees)
        links = of if links is None else links.unionByName(of)
    if links is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    cc = components(materialize(links, "links"), "a", "b", "vcc")
    known = materialize(reps.join(cc, reps["rep"] == cc["node"], "left")
                        .select("rep", "vec", "weight", F.coalesce("root", "rep").alias("root"), F.col("root").isNotNull().alias("linked")),
                        "known")
    counts = _count_links(known.where("linked"), least)
    per_rep = (known.join(counts, "rep", "left")
               .select("rep", F.col("root").alias("component_id"),
                       (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    found = member.join(per_rep, "rep").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = v.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _forest_links(reps: DataFrame, dim: int, least: float, trees: int) -> DataFrame:
    """Verified links ``(a, b)`` found in any leaf of any tree."""
    drawn = reps.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toArrow()
    sample = _unit(drawn.column("vec").combine_chunks(), dim)
    forest = [fit_tree(sample, t) for t in range(trees)]

    def send(batches):
        for b in batches:
            x = _unit(b.column("vec"), dim)
            for t, bands in enumerate(forest):
                rows, nodes = send_down(x, t, bands)
                if len(rows):
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), t, dtype=np.int32)), pa.array(nodes), b.column("rep").take(at),
                         b.column("vec").take(at)], ["tree", "node", "rep", "vec"])

    def compare(group: pa.Table) -> pa.Table:
        x = _unit(group.column("vec").combine_chunks(), dim)
        names = group.column("rep").to_numpy()
        t, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        got = [link for at in leaves(x, t, node) for link in spanning(x[at], names[at], least)]
        return pa.table({"a": pa.array([a for a, _ in got], pa.int64()), "b": pa.array([b for _, b in got], pa.int64())})

    kind = reps.schema["rep"].dataType.simpleString()
    sent = reps.select("rep", "vec").mapInArrow(send, f"tree int, node long, rep {kind}, vec array<double>")
    return sent.groupBy("tree", "node").applyInArrow(compare, "a long, b long")


def _count_links(linked: DataFrame, least: float) -> DataFrame:
    """``(rep, near)``: weight of the other vectors of its component at
    ``least`` cosine or more.  Blocks of a component meet pairwise; a block's
    rows travel once per other block, counts travel instead of pairs."""
    sizes = linked.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    cut = linked.join(sizes, "root").select(
        "root", "rep", "vec", "weight", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # group (i, j) holds blocks i and j; (i, i) counts within a block
    cut = cut.withColumn("meet", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("root", "rep", "vec", "weight", "block",
                     F.least("block", "meet").alias("i"), F.greatest("block", "meet").alias("j"))

    def count(group: pa.Table) -> pa.Table:
        dim = len(group.column("vec")[0])
        x = _unit(group.column("vec").combine_chunks(), dim)
        w, names = group.column("weight").to_numpy(), group.column("rep").to_numpy()
        block = group.column("block").to_numpy()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        near = np.zeros(len(x), dtype=np.int64)
        for a in range(0, len(x), 512):
            hit = x[a:a + 512] @ x.T >= least
            hit &= (block[a:a + 512, None] != block[None, :]) if i != j else ~np.eye(len(x), dtype=bool)[a:a + 512]
            near[a:a + 512] = hit @ w
        return pa.table({"rep": pa.array(names, pa.int64()), "near": pa.array(near)})

    return (cut.groupBy("root", "i", "j").applyInArrow(count, "rep long, near long")
            .groupBy("rep").agg(F.sum("near").alias("near")))
