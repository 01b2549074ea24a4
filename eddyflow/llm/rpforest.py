"""Near-duplicate embeddings by a forest of random-projection trees.

* **Classes.** Equal vectors are one class, held by its smallest id, with a count;
  thousands of copies cost one vector.
* **Trees.** A node projects its vectors on a few random directions of its level
  and splits at the sample's median along the one with the fewest vectors near the
  median.  Vectors within the spill width of the cut go to both sides; the width is
  set by how far apart linked vectors can be, so that a linked pair is seldom parted
  and, over several trees, hardly ever in all.  A node is a leaf once it holds about
  ``LEAF`` vectors, or when no direction parts it (a dense group).  Trees are
  fitted on bounded samples (``SAMPLE`` vectors for a tree, then ``NODE_SAMPLE`` for
  each node that is still too large), in tasks; only cuts reach the driver, at most
  ``MAX_CUTS``.  Every vector is placed.
* **Leaves.** Vectors travel to their leaves in 16 bits a component, with a bound on
  the error.  A leaf compares all its vectors by blocks of a matrix product; a
  dense leaf is dealt in tiles over several tasks.  A pair is counted only in the
  first leaf that both have (each vector knows its leaves), so links are counted
  without listing pairs; a leaf gives a count and one edge a vector.
* **Verification.** Pairs that the rounding leaves undecided are computed from
  the vectors themselves, in double precision.  Edges are united to components.

Defined results: null, empty and zero vectors and those with null or non-finite
components link with nothing; vectors of different lengths do not link; rows with
one id and different vectors have their own links but are one point of a
component; a null id is never the smallest (a component of such rows alone has
null as its id); repeated rows are copies; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

COSINE = 0.95
TREES = 3
LEAF = 8192
SPILL = 0.8             # spill width in standard deviations of a linked pair's distance
DIRECTIONS = 4          # tried at each node
SAMPLE = 1 << 16
NODE_SAMPLE = 1 << 13
MIN_SAMPLE = 64         # a node with fewer sampled vectors is not split on that sample
MAX_LEVEL = 40
MAX_CUTS = 1 << 20
DENSE = 0.5             # share of a node inside the spill width from which it is a leaf
BLOCK_CELLS = 1 << 21
SEED = 13
NULL_IDS = 1 << 62      # points of rows without an id lie beyond all ids


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec, point, h1, h2, row``: rows whose vector can link; ``h1, h2`` are
    equal for equal vectors."""
    kind = rows.schema[vec_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    vec = F.transform(F.col(vec_col).cast(f"array<{kind}>"), lambda x: x + F.lit(0.0).cast(kind))  # no -0.0
    fits = (F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("vec", lambda x: x != 0))
    return (rows.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec"))
            .withColumn("h1", F.xxhash64(F.lit(1), "vec")).withColumn("h2", F.xxhash64(F.lit(2), "vec"))
            .withColumn("fits", F.coalesce(fits, F.lit(False)))
            .withColumn("point", point(F.col("id"), F.col("h1")))
            .withColumn("row", F.monotonically_increasing_id()))


def point(id_col: Column, h: Column) -> Column:
    return F.coalesce(id_col, F.shiftrightunsigned(h, 2) + F.lit(NULL_IDS))


def unit(vecs: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, whatever their scale."""
    vecs = vecs / np.abs(vecs).max(axis=1, keepdims=True)
    return vecs / np.sqrt((vecs * vecs).sum(axis=1, keepdims=True))


def by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) of each vector length in a batch."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, unit(flat[starts[at][:, None] + np.arange(d)].astype(np.float64))


def spill_width(dim: int, cosine: float, spill: float) -> float:
    """Half the distance by which linked vectors of the lowest cosine lie apart
    along a random direction, times ``spill``."""
    return spill / 2 * math.sqrt((2 - 2 * cosine) / dim)


def level_directions(tree: int, level: int, dim: int) -> np.ndarray:
    d = np.random.default_rng([SEED, tree, level, dim]).standard_normal((DIRECTIONS, dim))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


@dataclass
class Forest:
    """Cuts by (tree, vector length): node -> (direction, threshold).  Node 1 is
    the root, 2k and 2k+1 are the children of k.  ``tiles``: dense leaves."""

    trees: int
    cosine: float
    spill: float
    cuts: dict[tuple[int, int], dict[int, tuple[int, float]]] = field(default_factory=dict)
    tiles: dict[tuple[int, int, int], int] = field(default_factory=dict)

    def table(self, tree: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted nodes, their directions and thresholds."""
        rows = sorted((n, j, t) for n, (j, t) in self.cuts.get((tree, dim), {}).items())
        return (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
                np.array([r[2] for r in rows], np.float64))

    def place(self, vecs: np.ndarray, tree: int, tables: dict) -> tuple[np.ndarray, np.ndarray]:
        """(row, node) of every leaf that each vector reaches."""
        dim = vecs.shape[1]
        if (tree, dim) not in tables:
            tables[tree, dim] = self.table(tree, dim)
        nodes, js, ts = tables[tree, dim]
        w = spill_width(dim, self.cosine, self.spill)
        row, node = np.arange(len(vecs)), np.ones(len(vecs), np.int64)
        done, level = [], 0
        while len(row):
            at = np.minimum(np.searchsorted(nodes, node), max(len(nodes) - 1, 0))
            inner = nodes[at] == node if len(nodes) else np.zeros(len(row), bool)
            done.append((row[~inner], node[~inner]))
            row, node, at = row[inner], node[inner], at[inner]
            if len(row):
                x = (vecs @ level_directions(tree, level, dim).T)[row, js[at]] - ts[at]
                left, right = x <= w, x >= -w
                row, node = (np.concatenate([row[left], row[right]]),
                             np.concatenate([2 * node[left], 2 * node[right] + 1]))
            level += 1
        return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def fit_node(vecs: np.ndarray, tree: int, node: int, size: float, leaf: int, cosine: float, spill: float) -> list[tuple]:
    """Cuts below ``node`` from a sample of its vectors that stand for ``size``:
    (node, direction, threshold, size); direction -1: a leaf that is too
    large (dense), -2: one that needs a further sample."""
    dim, each = vecs.shape[1], size / max(1, len(vecs))
    w = spill_width(dim, cosine, spill)
    out, todo = [], [(node, np.arange(len(vecs)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) * each <= leaf:
            continue
        level = node.bit_length() - 1
        if len(rows) < MIN_SAMPLE:
            out.append((node, -2, 0.0, len(rows) * each))
            continue
        x = vecs[rows] @ level_directions(tree, level, dim).T
        cut = np.median(x, axis=0)
        near = (np.abs(x - cut) <= w).mean(axis=0)
        j = int(near.argmin())
        if near[j] > DENSE or level >= MAX_LEVEL:
            out.append((node, -1, 0.0, len(rows) * each))
            continue
        out.append((node, j, float(cut[j]), len(rows) * each))
        x = x[:, j] - cut[j]
        todo += [(2 * node, rows[x <= w]), (2 * node + 1, rows[x >= -w])]
    return out


def fit_forest(vecs: DataFrame, trees: int = TREES, leaf: int = LEAF, cosine: float = COSINE, spill: float = SPILL,
               sample: int = SAMPLE, node_sample: int = NODE_SAMPLE) -> Forest:
    """Fit on samples by hash: equal vectors are in or out together and count once."""
    forest = Forest(trees, cosine, spill)
    total = vecs.count()
    wanted: dict[tuple[int, int, int], float] | None = None  # (tree, dim, node) -> size; None: all roots
    rate = min(1.0, sample / max(1, total))
    while total > leaf:
        drawn = vecs.where(F.shiftrightunsigned("h2", 1) < F.lit(int(rate * (1 << 63)) - 1)).select("vec").distinct()

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables: dict = {}
            for b in batches:
                for at, u in by_length(b.column("vec")):
                    for tree in range(forest.trees):
                        row, node = forest.place(u, tree, tables)
                        if wanted is not None:
                            keep = np.array([(tree, u.shape[1], int(n)) in wanted for n in node], bool)
                            row, node = row[keep], node[keep]
                        n = len(row)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, tree, np.int32)), pa.array(np.full(n, u.shape[1], np.int32)), pa.array(node),
                             pa.array([v.tobytes() for v in u[row].astype(np.float32)], pa.binary())],
                            names=["tree", "dim", "node", "v"])

        def fit(group: pa.Table) -> pa.Table:
            tree, dim, node = (group.column(c)[0].as_py() for c in ("tree", "dim", "node"))
            v = np.frombuffer(b"".join(group.column("v").to_pylist()), np.float32).reshape(-1, dim).astype(np.float64)
            rows = fit_node(v, tree, node, len(v) / rate, leaf, cosine, spill)
            cols = list(zip(*rows)) or [(), (), (), ()]
            n = len(rows)
            return pa.table({"tree": pa.array([tree] * n, pa.int32()), "dim": pa.array([dim] * n, pa.int32()),
                             "node": pa.array(cols[0], pa.int64()), "j": pa.array(cols[1], pa.int32()),
                             "t": pa.array(cols[2], pa.float64()), "size": pa.array(cols[3], pa.float64())})

        found = (drawn.mapInArrow(placed, "tree int, dim int, node bigint, v binary").groupBy("tree", "dim", "node")
                 .applyInArrow(fit, "tree int, dim int, node bigint, j int, t double, size double").collect())
        wanted = {}
        for r in found:
            key = (r["tree"], r["dim"], r["node"])
            if r["j"] >= 0:
                forest.cuts.setdefault(key[:2], {})[key[2]] = (r["j"], r["t"])
            elif r["j"] == -1 or rate == 1.0:
                forest.tiles[key] = max(1, math.ceil(r["size"] / leaf))
            else:
                wanted[key] = r["size"]
        if not wanted or sum(map(len, forest.cuts.values())) + len(wanted) * 64 > MAX_CUTS:
            forest.tiles |= {k: max(1, math.ceil(size / leaf)) for k, size in wanted.items()}
            break
        rate = min(1.0, node_sample / max(wanted.values()))
    return forest


HEAD = np.dtype([("point", "<i8"), ("h1", "<i8"), ("weight", "<i8"), ("scale", "<f4"), ("dim", "<i4"), ("tile", "<i4"),
                 ("n_leaves", "<i4")])


def leaf_rows(classes: DataFrame, forest: Forest) -> DataFrame:
    """``leaf, a, b, body``: each class in each of its leaves (and, of a dense leaf,
    in each pair of tiles that its own tile is in).  The body holds the head, the
    leaves and the components in 16 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict = {}
        for b in batches:
            point, h1, weight = (b.column(c).to_numpy() for c in ("point", "h1", "weight"))
            for at, u in by_length(b.column("vec")):
                dim = u.shape[1]
                found = [forest.place(u, t, tables) for t in range(forest.trees)]
                row = np.concatenate([f[0] for f in found])
                node = np.concatenate([f[1] | t << 44 for t, f in enumerate(found)])
                order = np.lexsort((node, row))
                row, node = row[order], node[order]
                first = np.searchsorted(row, np.arange(len(u) + 1))
                scale = (np.abs(u).max(axis=1) / 32767).astype(np.float32)
                q = np.rint(u / scale[:, None]).astype("<i2")
                head = np.zeros(len(u), HEAD)
                head["point"], head["h1"], head["weight"] = point[at], h1[at], weight[at]
                head["scale"], head["dim"], head["n_leaves"] = scale, dim, np.diff(first)
                leaf, a, b_, body = [], [], [], []
                for i in range(len(u)):
                    own = node[first[i]:first[i + 1]]
                    tail = own.astype("<i8").tobytes() + q[i].tobytes()
                    for n in own.tolist():
                        k = forest.tiles.get((n >> 44, dim, n & (1 << 44) - 1), 1)
                        head["tile"][i] = tile = int(h1[at[i]]) % k
                        full = head[i].tobytes() + tail
                        for other in range(k):
                            leaf.append(n)
                            a.append(min(tile, other))
                            b_.append(max(tile, other))
                            body.append(full)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(leaf), dim, np.int32)), pa.array(leaf, pa.int64()), pa.array(a, pa.int32()),
                     pa.array(b_, pa.int32()), pa.array(body, pa.binary())], names=["dim", "leaf", "a", "b", "body"])

    return classes.select("vec", "point", "h1", "weight").mapInArrow(
        run, "dim int, leaf bigint, a int, b int, body binary")


FOUND = "point bigint, h1 bigint, links bigint, root bigint, v_point bigint, v_h1 bigint, weight bigint, v_weight bigint"


def compare_leaf(leaf: int, a: int, b: int, bodies: list[bytes], cosine: float) -> tuple[list[tuple], list[tuple]]:
    """(point, h1, links, root) of the vectors with links, and undecided pairs."""
    dim = int(np.frombuffer(bodies[0], HEAD, 1)["dim"][0])
    head = np.frombuffer(b"".join(x[:HEAD.itemsize] for x in bodies), HEAD)
    q = np.frombuffer(b"".join(x[-2 * dim:] for x in bodies), "<i2").reshape(-1, dim)
    vecs = q.astype(np.float32) * head["scale"][:, None]
    own = np.full((len(bodies), int(head["n_leaves"].max())), -1, np.int64)
    for i, x in enumerate(bodies):
        own[i, :head["n_leaves"][i]] = np.frombuffer(x, "<i8", head["n_leaves"][i], HEAD.itemsize)
    # Rounding: half a step a component and side, and the product's own.
    error = 2 * math.sqrt(dim) * float(head["scale"].max()) * 0.51 + 2e-7 * dim
    left = np.flatnonzero(head["tile"] == a) if a != b else np.arange(len(bodies))
    right = np.flatnonzero(head["tile"] == b) if a != b else left
    links, label = np.zeros(len(bodies), np.int64), np.arange(len(bodies))
    seen, undecided = np.zeros(len(bodies), bool), []
    step = max(1, BLOCK_CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at:at + step]
        cos = vecs[rows] @ vecs[right].T
        i, j = np.nonzero(cos >= cosine - error)
        sure = cos[i, j] >= cosine + error
        i, j = rows[i], right[j]
        keep = i < j if a == b else np.ones(len(i), bool)
        i, j, sure = i[keep], j[keep], sure[keep]
        for lo in range(0, len(i), BLOCK_CELLS // 32):
            x, y, ok = (v[lo:lo + BLOCK_CELLS // 32] for v in (i, j, sure))
            shared = (own[x][:, :, None] == own[y][:, None, :]).any(axis=2) & (own[x] >= 0)
            mine = own[x, shared.argmax(axis=1)] == leaf
            undecided += zip(x[mine & ~ok].tolist(), y[mine & ~ok].tolist())
            np.add.at(links, x[mine & ok], head["weight"][y[mine & ok]])
            np.add.at(links, y[mine & ok], head["weight"][x[mine & ok]])
            x, y = x[ok], y[ok]
            seen[x] = seen[y] = True
            heads = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else []
            for h, e in zip(heads, [*heads[1:], len(x)]):
                roots = np.unique(label[np.append(y[h:e], x[h])])
                if len(roots) > 1:
                    label[np.isin(label, roots[1:])] = roots[0]
    least = np.full(len(bodies), np.iinfo(np.int64).max)
    np.minimum.at(least, label, head["point"])
    rows = [(int(head["point"][i]), int(head["h1"][i]), int(links[i]), int(least[label[i]])) for i in np.flatnonzero(seen)]
    pairs = [(*(int(head[c][x]) for c in ("point", "h1")), *(int(head[c][y]) for c in ("point", "h1")),
              int(head["weight"][x]), int(head["weight"][y])) for x, y in undecided]
    return rows, pairs


def compared(rows: DataFrame, cosine: float) -> DataFrame:
    """All leaves' counts and edges (``root`` set), and undecided pairs (``v_point`` set)."""

    def run(group: pa.Table) -> pa.Table:
        leaf, a, b = (group.column(c)[0].as_py() for c in ("leaf", "a", "b"))
        sure, pairs = compare_leaf(leaf, a, b, group.column("body").to_pylist(), cosine)
        cols = list(zip(*[(*r, None, None, None, None) for r in sure], *[(p[0], p[1], None, None, *p[2:]) for p in pairs]))
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table({n: pa.array(cols[k] if cols else [], pa.int64()) for k, n in enumerate(names)})

    return rows.groupBy("dim", "leaf", "a", "b").applyInArrow(run, FOUND)


def verified(pairs: DataFrame, vecs: DataFrame, cosine: float) -> DataFrame:
    """The undecided ``pairs`` whose cosine, in double precision, reaches ``cosine``."""
    keys = pairs.select("point", "h1").union(pairs.select("v_point", "v_h1")).distinct().select(
        F.col("point").alias("k_point"), F.col("h1").alias("k_h1"))
    known = written(vecs.join(keys, (F.col("point") == F.col("k_point")) & (F.col("h1") == F.col("k_h1")), "left_semi")
                    .select(F.col("point").alias("k_point"), F.col("h1").alias("k_h1"), F.col("vec").cast("array<double>"))
                    .dropDuplicates(["k_point", "k_h1"]), "vectors")
    side = lambda name, p, h: known.select(
        F.col("k_point").alias(p), F.col("k_h1").alias(h), F.col("vec").alias(name))
    top = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    scaled = lambda v: F.transform(v, lambda x: x / top(v))
    dot = lambda v, w: F.aggregate(F.zip_with(v, w, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    both = pairs.join(side("x", "point", "h1"), ["point", "h1"]).join(side("y", "v_point", "v_h1"), ["v_point", "v_h1"])
    both = both.withColumn("x", scaled(F.col("x"))).withColumn("y", scaled(F.col("y")))
    return both.where(dot("x", "y") / (F.sqrt(dot("x", "x")) * F.sqrt(dot("y", "y"))) >= cosine).drop("x", "y")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
                 **fitting) -> DataFrame:
    """Per row: its id, ``n_links``, ``component_id`` and ``kept``."""
    named = vectors(rows, id_col, vec_col)
    vecs = named.where("fits")
    # Classes of equal vectors; only those with copies need a join with the vectors.
    classes = written(vecs.groupBy("h1", "h2").agg(
        F.min(F.struct("point", "row")).alias("least"), F.count(F.lit(1)).alias("weight"))
        .select("h1", "h2", F.col("least.point").alias("point"), F.col("least.row").alias("row"), "weight"), "classes")
    copied = classes.where("weight > 1").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"),
                                                F.col("point").alias("c_point"), F.col("row").alias("c_row"), "weight")
    single = vecs.join(copied, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left").where(
        F.col("c_row").isNull() | (F.col("c_row") == F.col("row"))).withColumn("weight", F.coalesce("weight", F.lit(1)))
    forest = fit_forest(vecs, cosine=cosine, **fitting)
    found = written(compared(leaf_rows(single, forest), cosine), "links")
    late = written(verified(found.where("v_point is not null").select(
        "point", "h1", "v_point", "v_h1", "weight", "v_weight"), vecs, cosine), "verified")
    counts = found.where("root is not null").select("point", "h1", "links").unionByName(
        late.select("point", "h1", F.col("v_weight").alias("links"))).unionByName(
        late.select(F.col("v_point").alias("point"), F.col("v_h1").alias("h1"), F.col("weight").alias("links")))
    counts = counts.groupBy(F.col("point").alias("l_point"), F.col("h1").alias("l_h1")).agg(F.sum("links").alias("links"))
    united = components(found.where("root is not null").select("point", F.col("root").alias("to")).union(
        late.select("point", "v_point")))
    facts = written(
        classes.join(counts, (F.col("point") == F.col("l_point")) & (F.col("h1") == F.col("l_h1")), "left")
        .join(united, F.col("point") == F.col("node"), "left")
        .select(F.col("h1").alias("f1"), F.col("h2").alias("f2"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "point").alias("least")), "facts")
    out = named.select("id", "point", F.when(F.col("fits"), F.col("h1")).alias("h1"), "h2").join(
        facts, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left")
    least = F.coalesce("least", "point")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(least < NULL_IDS, least).alias("component_id"), (least == F.col("point")).alias("kept"))
