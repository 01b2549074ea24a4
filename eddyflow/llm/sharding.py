"""K-d tree sharding: split at exact weighted medians until leaves reach the
target bytes.

Dimensions are metadata of the text alone (bytes, bytes beyond one per
character, lines), so equal texts have the same coordinates.  A node is split
along its widest dimension (extent as a share of the whole table's extent) at
the weighted median of ``(coordinate, text CRC, row hash, row number)``; the later
keys only order rows inside a tie, so a group of equal texts stays together
unless the cut falls inside it.  The row number is fixed once the metadata are
written; it tells equal rows apart, so any group can be cut.  A cut inside a group is moved to the nearer
edge of the group if that shifts less than ``tolerance`` of the node's bytes;
a larger group is split, as no other cut keeps the sizes near equal.

The median is found by distributed histograms: every round counts the bytes in
at most ``BINS`` intervals of every open node's current range and zooms into the
interval that holds the middle; only those counts reach the driver, and at last
the keys of at most ``FEW`` rows a node, however many rows there are.

Defined results: a null text has size 1 and CRC 0; all rows are placed, repeated
rows too (each gets its own slot); an empty table gives an empty result; a table
of equal rows is split by row hash and, when even that ties, kept whole; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, text_of, written

DIMS = ("d_bytes", "d_wide", "d_lines")
BINS = 1024
FEW = 512
FULL = (0, (1 << 62) - 1)  # keys after the first are not negative
SHARDS = 8
TOLERANCE = 0.005


def metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32`` and the dimensions of each row."""
    t = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    size = F.octet_length("text").cast("long")
    return t.select("doc_id", (size + 1).alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
                    F.xxhash64("doc_id", "text").bitwiseAND(F.lit(FULL[1])).alias("row_hash"),
                    F.monotonically_increasing_id().alias("row"), (size + 1).alias("d_bytes"),
                    (size - F.char_length("text")).cast("long").alias("d_wide"),
                    (size - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).cast("long")
                    .alias("d_lines"))


def _per_node(values: dict[int, int | None], kind: str = "long") -> Column:
    """The value of the row's node, from one literal array."""
    top = max(values, default=0)
    return F.get(F.array(*[F.lit(values.get(n)).cast(kind) for n in range(top + 1)]), F.col("node"))


def _at_most(keys: list[str], cut: dict[int, list[int]], strict: bool = False) -> Column:
    """Lexicographic ``keys <= cut`` of the row's node (or ``<``)."""
    cond = F.lit(not strict)
    for i, k in reversed(list(enumerate(keys))):
        v = _per_node({n: c[i] for n, c in cut.items()})
        cond = (F.col(k) < v) | ((F.col(k) == v) & cond)
    return cond


def _middle(rows: DataFrame, keys: list[str], goals: dict[int, float], span: dict[int, tuple[int, int]]
            ) -> dict[int, list[int]]:
    """Per node the smallest key tuple at which the running bytes reach the
    goal: a row is left of the cut if its tuple is not above it.  ``span``: the
    first key's range.  Each round counts the bytes of every open node in ``BINS``
    intervals of its current key, and zooms into the one with the middle; an
    interval of one value goes on with the next key, and one of ``FEW`` rows is
    finished from those rows."""
    fixed: dict[int, list[int]] = {n: [] for n in goals}
    below = {n: 0.0 for n in goals}
    found: dict[int, list[int]] = {}
    while open_ := [n for n in goals if n not in found]:
        key = F.get(F.array(*keys), _per_node({n: len(fixed[n]) for n in open_}, "int"))
        inside = rows.where(F.col("node").isin(open_))
        for j in range(max(len(fixed[n]) for n in open_)):
            v = _per_node({n: fixed[n][j] for n in open_ if j < len(fixed[n])})
            inside = inside.where(v.isNull() | (F.col(keys[j]) == v))
        inside = inside.withColumn("key", key).withColumn("low", _per_node({n: span[n][0] for n in open_}))
        inside = inside.where(F.col("key").between(F.col("low"), _per_node({n: span[n][1] for n in open_})))
        width = {n: max(1, -(-(span[n][1] - span[n][0] + 1) // BINS)) for n in open_}
        counts = (inside.withColumn("width", _per_node(width))
                  .groupBy("node", F.expr("(key - low) div width").alias("bin"))
                  .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"),
                       F.max("key").alias("hi")).collect())  # at most nodes x BINS rows
        few = []
        for n in open_:
            mine = sorted((r["bin"], r) for r in counts if r["node"] == n)
            for _, r in mine:
                if below[n] + r["bytes"] >= goals[n] or r is mine[-1][1]:
                    break
                below[n] += r["bytes"]
            span[n] = (r["lo"], r["hi"])
            if r["n"] <= FEW:
                few.append(n)
            elif r["lo"] == r["hi"]:
                fixed[n].append(r["lo"])
                span[n] = FULL
        if few:
            here = inside.where(F.col("node").isin(few) & F.col("key").between(
                _per_node({n: span[n][0] for n in few}), _per_node({n: span[n][1] for n in few})))
            held = here.select("node", *keys, "size").collect()  # at most nodes x FEW rows
            for n in few:
                mine = sorted(tuple(r[k] for k in (*keys, "size")) for r in held if r["node"] == n)
                for r in mine:
                    below[n] += r[-1]
                    if below[n] >= goals[n]:
                        break
                found[n] = list(r[:-1])
    return found


def _group_edges(rows: DataFrame, cut: dict[int, list[int]], goals: dict[int, float], slack: float) -> dict[int, str]:
    """For cuts inside a group of equal texts: the edge ('below' or 'above' the
    group) that is near enough in bytes, if any."""
    keys = ["axis", "text_crc32"]
    side = F.when(_at_most(keys, cut, strict=True), "less").when(_at_most(keys, cut), "group")
    sums = {n: {"less": 0, "group": 0} for n in cut}
    for r in rows.where(F.col("node").isin(list(cut))).groupBy("node", side.alias("side")).agg(
            F.sum("size").alias("bytes")).collect():  # three rows per node
        sums[r["node"]][r["side"]] = r["bytes"]
    out = {}
    for n, s in sums.items():
        under, over = goals[n] - s["less"], s["less"] + s["group"] - goals[n]
        if min(under, over) <= slack:
            out[n] = "below" if under <= over and s["less"] > 0 else "above"
    return out


def assign_shards(meta: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``meta`` with ``shard``: the leaves of a k-d tree of ``shards`` leaves."""
    rows = meta.withColumn("node", F.lit(0))
    whole: dict = {}
    leaves = {0: shards}  # a node is named by its first leaf -> leaves below it
    keys = ["axis", "text_crc32", "row_hash", "row"]
    while any(k > 1 for k in leaves.values()):
        stats = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[F.min(d).alias(f"lo_{d}") for d in DIMS],
            *[F.max(d).alias(f"hi_{d}") for d in DIMS]).collect()}  # at most `shards` rows
        if not stats:
            break
        whole = whole or {"bytes": stats[0]["bytes"]} | {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"])
                                                         for d in DIMS}
        axis, goals = {}, {}
        for n, k in leaves.items():
            if k > 1 and n in stats:
                s = stats[n]
                axis[n] = max(range(len(DIMS)), key=lambda i: ((s[f"hi_{DIMS[i]}"] - s[f"lo_{DIMS[i]}"])
                                                               / whole[DIMS[i]], -i))
                goals[n] = s["bytes"] * (k // 2) / k
        rows = rows.withColumn("axis", F.get(F.array(*DIMS), _per_node(axis, "int")))
        span = {n: (stats[n][f"lo_{DIMS[i]}"], stats[n][f"hi_{DIMS[i]}"]) for n, i in axis.items()}
        cut = _middle(rows, keys, goals, span)
        edge = _group_edges(rows, cut, goals, whole["bytes"] / shards * tolerance)
        # At a group's edge the CRC alone decides: -1 or the end of the hashes.
        last = {n: [*c[:2], *{"below": (-1, 0), "above": FULL[1:] * 2}.get(edge.get(n), c[2:])] for n, c in cut.items()}
        step = _per_node({n: leaves[n] // 2 for n in cut}, "int")
        right = F.col("node").isin(list(cut)) & ~_at_most(keys, last)
        rows = written(rows.withColumn("node", F.when(right, F.col("node") + step).otherwise(F.col("node")))
                       .drop("axis"), "sharding")
        leaves = {m: k for n, old in leaves.items()
                  for m, k in ([(n, old // 2), (n + old // 2, old - old // 2)] if old > 1 else [(n, old)])}
    return rows.withColumnRenamed("node", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row."""
    meta = written(metadata(docs, id_col, text_col), "sharding")
    placed = assign_shards(meta, shards, tolerance)
    return (numbered(placed, ["shard"], ["row_hash", "row"], "slot", F.xxhash64("row"))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
