"""Prefix trie of conversations, by double arrays.

1. **Rebuilding.** Turns are range-sorted by conversation and turn; one pass over
   the sorted partitions puts the shared opening turns of a conversation's lead in
   front of it.  What a partition must know of those before it (rows of a
   conversation cut by the edge, the lead's opening turns) is one row a
   partition.  Turns travel as digests with their length, never as texts.
2. **Segments.** A conversation is cut at fixed depths into segments of ``BAND``
   turns, so the length of a conversation bounds nothing.  A node's key is the
   XOR of its turns' digests, each mixed with its position: the key of a
   segment's root comes from the segments above it.  Equal segments under one
   root become one with a count.
3. **Prefix shards.** Distinct segments are range-sorted by root and turns, so a
   shard is a contiguous piece of the trie, of bounded size however many
   conversations share an opening.  Each shard packs a double array over dense
   turn ids: the child of state ``s`` by turn ``c`` is ``t = BASE[s] + c`` if
   ``CHECK[t] = s``.  Walking the array gives its nodes.
4. **Upper nodes.** Only nodes on a shard's first or last path, and those above a
   segment that goes on, can have members or descendants elsewhere ("open").  All
   other nodes are final in their shard.  Open nodes are merged by key, and sums
   over their subtrees are gathered by doubling: in round i each open node adds
   what it holds to its ancestor 2^i above.

The digest of the members that end in a node is taken over their sorted ids, in
pieces; SHA-256 must see its input in order, so one task streams the ids (not the
rows) of a node, in constant memory.

Defined results: rows without a conversation id are left out; null roles and
texts are empty; null turns come first, rows of equal turn by the digest of role
and text; repeated rows are turns of their own; very long texts are digested where
they stand; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .common import written

GROUP = 100        # conversations that share the opening turns of their lead
MAX_SHARED = 6     # shared opening turns are crc32(id) mod this
BAND = 16          # turns a segment
SHARD_TURNS = 1 << 18
ITEM = 24          # digest (16 bytes), code points (8 bytes)
IDS_BYTES = 32 << 10
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

_ITEM = np.dtype([("a", ">u8"), ("b", ">u8"), ("n", ">u8")])


def mixed(digest: np.ndarray, position: np.ndarray, salt: int) -> np.ndarray:
    """64-bit digests mixed with their positions (a multiply-xorshift)."""
    with np.errstate(over="ignore"):
        x = digest.astype(np.uint64) + (position.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15 ^ salt)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def item_keys(items: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mixed(items["a"], position, 0), mixed(items["b"], position, 0x5A5A5A5A)


def shared_turns(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % MAX_SHARED


def sorted_turns(convs: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``c, lead, item`` in the order of the conversations, kept as partitions."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    c = F.col(id_col).cast("bigint")
    turns = convs.where(F.col(id_col).isNotNull()).select(
        c.alias("c"), (c - c % GROUP).alias("lead"), F.col(turn_col).alias("turn"),
        F.concat(F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)),
                 F.unhex(F.lpad(F.hex(F.length(text).cast("bigint")), 16, "0"))).alias("item"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.col("lead"), F.col("c") != F.col("lead"), F.col("c"), F.col("turn").asc_nulls_first(), F.col("item"),
             F.col("row")]
    checkpoint_root(convs.sparkSession)
    return (turns.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "lead", "item")
            .checkpoint())


def _edges(ordered: DataFrame) -> dict[int, tuple]:
    """What each partition takes over from those before it: the conversation that
    was last, its rows so far, its group, and the lead's opening turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = group = None
        n, opening = 0, []
        for b in batches:
            for c, lead, item in zip(*(b.column(i).to_pylist() for i in range(3))):
                first = c if first is None else first
                n = n + 1 if c == last else 1
                if lead != group:
                    group, opening = lead, []
                if c == lead and len(opening) < MAX_SHARED - 1:
                    opening.append(item)
                last = c
        if first is not None:
            yield pa.RecordBatch.from_pydict({
                "pid": pa.array([TaskContext.get().partitionId()], pa.int32()), "first": [first], "last": [last],
                "n": [n], "grp": [group], "opening": pa.array([b"".join(opening)], pa.binary())})

    rows = ordered.mapInArrow(run, "pid int, first bigint, last bigint, n bigint, grp bigint, opening binary").collect()
    out, last, n, group, opening = {}, None, 0, None, b""
    for r in sorted(rows, key=lambda r: r["pid"]):
        out[r["pid"]] = (last, n, group, opening)
        n = n + r["n"] if r["first"] == r["last"] == last else r["n"]
        opening = (opening if r["grp"] == group else b"") + bytes(r["opening"])
        opening = opening[:ITEM * (MAX_SHARED - 1)]
        last, group = r["last"], r["grp"]
    return out


SEGMENTS = "c bigint, band bigint, at int, whole boolean, items binary, x1 bigint, x2 bigint"


def segments(ordered: DataFrame) -> DataFrame:
    """The rebuilt conversations in segments; a segment cut by a partition's edge
    comes as fragments (``whole`` false, ``at``: its first turn in the segment)."""
    edges = _edges(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last, own, group, taken = edges.get(TaskContext.get().partitionId(), (None, 0, None, b""))
        opening = [taken[i:i + ITEM] for i in range(0, len(taken), ITEM)]
        held: list[bytes] = []
        at, fresh, shared = 0, False, 0
        if last is not None:
            shared = 0 if last == group else shared_turns(last)
            at = own if last == group else min(shared, len(opening)) + max(0, own - shared)
        start = at  # position of the first held turn

        def close(ended: bool) -> None:
            """Give the held turns as a segment."""
            nonlocal start
            if held or at == 0:
                whole = start % BAND == 0 and (len(held) == BAND or (ended and fresh))
                rows.append((last, start // BAND, start % BAND, whole, b"".join(held)))
            held.clear()
            start = at

        def add(item: bytes) -> None:
            nonlocal at
            held.append(item)
            at += 1
            if at % BAND == 0:
                close(False)

        def flush() -> pa.RecordBatch:
            conv, band, offset, whole, items = zip(*rows)
            sizes = np.array([len(x) // ITEM for x in items])
            ends = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(items), dtype=_ITEM)
            place = np.repeat(np.array(band) * BAND + np.array(offset) - (ends - sizes), sizes) + np.arange(len(flat))
            x1, x2 = (np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(k)]) for k in item_keys(flat, place))
            cols = [pa.array(conv, pa.int64()), pa.array(band, pa.int64()), pa.array(offset, pa.int32()),
                    pa.array(whole), pa.array(items, pa.binary())]
            cols += [pa.array((x[ends] ^ x[ends - sizes]).view(np.int64)) for x in (x1, x2)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, names=["c", "band", "at", "whole", "items", "x1", "x2"])

        for b in batches:
            for c, lead, item in zip(*(b.column(i).to_pylist() for i in range(3))):
                if c != last:
                    if last is not None:
                        close(True)
                    if lead != group:
                        group, opening = lead, []
                    last, own, at, start, fresh = c, 0, 0, 0, True
                    shared = 0 if c == lead else shared_turns(c)
                    for x in opening[:shared]:
                        add(x)
                if c == lead and len(opening) < MAX_SHARED - 1:
                    opening.append(item)
                if own >= shared:
                    add(item)
                own += 1
            if rows:
                yield flush()
        if own:
            close(False)
        if rows:
            yield flush()

    return ordered.mapInArrow(run, SEGMENTS)


def joined_fragments(parts: DataFrame) -> DataFrame:
    """``c, band, items, x1, x2``: fragments put together, at most a few a partition."""
    pieces = parts.where(~F.col("whole")).groupBy("c", "band").agg(
        F.array_sort(F.collect_list(F.struct("at", "items"))).alias("p"),
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    put = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["items"]))
    return parts.where("whole").select("c", "band", "items", "x1", "x2").unionByName(
        pieces.select("c", "band", put.alias("items"), "x1", "x2"))


def rooted(segs: DataFrame) -> DataFrame:
    """``segs`` with ``r1, r2``, the key of each segment's root: the XOR of the
    segments above it, summed up in two steps so that no window holds more than a
    thousandth of a long conversation."""
    span = 1024
    many = segs.where((F.col("band") > 0) | (F.octet_length("items") == BAND * ITEM)).withColumn(
        "sup", F.floor(F.col("band") / span))
    sums = many.groupBy("c", "sup").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    outer, inner = before(Window.partitionBy("c").orderBy("sup")), before(Window.partitionBy("c", "sup").orderBy("band"))
    bases = sums.select(F.col("c").alias("bc"), F.col("sup").alias("bsup"),
                        *[F.coalesce(F.bit_xor(f"s{i}").over(outer), zero).alias(f"b{i}") for i in (1, 2)])
    deep = (many.select("*", *[F.coalesce(F.bit_xor(f"x{i}").over(inner), zero).alias(f"i{i}") for i in (1, 2)])
            .where("band > 0").join(bases, (F.col("c") == F.col("bc")) & (F.col("sup") == F.col("bsup"))))
    cols = ["c", "band", "items", "x1", "x2"]
    return segs.where("band = 0").select(*cols, zero.alias("r1"), zero.alias("r2")).unionByName(deep.select(
        *cols, F.col("b1").bitwiseXOR(F.col("i1")).alias("r1"), F.col("b2").bitwiseXOR(F.col("i2")).alias("r2")))


def ends_digests(segs: DataFrame) -> DataFrame:
    """``e1, e2, sha``: per node in which conversations end, the SHA-256 of their
    sorted ids, comma-joined."""
    ends = segs.groupBy("c").agg(F.bit_xor("x1").alias("e1"), F.bit_xor("x2").alias("e2"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, no, key, ids, size, rows = TaskContext.get().partitionId(), 0, None, [], 0, []

        def close():
            nonlocal no, size
            if ids:
                rows.append((*key, pid, no, ",".join(ids)))
                no += 1
            ids.clear()
            size = 0

        schema = pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("pid", pa.int32()), ("no", pa.int64()),
                            ("ids", pa.string())])

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return out

        for b in batches:
            for e1, e2, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (e1, e2) != key or size >= IDS_BYTES:
                    close()
                    key = (e1, e2)
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if rows:
                yield flush()
        close()
        if rows:
            yield flush()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, done = None, None, []

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                                              pa.array([d[2] for d in done])], names=["e1", "e2", "sha"])
            done.clear()
            return out

        for b in batches:
            for e1, e2, ids in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (e1, e2) != key:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (e1, e2), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if done:
                yield batch()
        if key is not None:
            done.append((*key, sha.hexdigest()))
            yield batch()

    packed = ends.repartitionByRange("e1", "e2", "c").sortWithinPartitions("e1", "e2", "c").select(
        "e1", "e2", "c").mapInArrow(pack, "e1 bigint, e2 bigint, pid int, no bigint, ids string")
    return (packed.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "pid", "no").select("e1", "e2", "ids")
            .mapInArrow(digest, "e1 bigint, e2 bigint, sha string"))


class DoubleArray:
    """``BASE`` and ``CHECK`` over states; built level by level."""

    FREE, ROOT = -1, -2
    TRIES = 64  # free places tried for the children of a node before they go to the end

    def __init__(self, roots: int):
        self.base = np.zeros(roots, np.int64)
        self.check = np.full(roots, self.ROOT, np.int64)

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, len(self.check) * 3 // 2) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, self.FREE, np.int64)])

    def add_children(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Place the distinct (parent, code) pairs of one level, sorted by parent.
        Families find a place where all their codes are free; only children fill
        the gaps that are left."""
        heads = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.append(heads, len(parents)))
        free = np.flatnonzero(self.check == self.FREE)
        used, lowest = int(np.flatnonzero(self.check != self.FREE)[-1]) + 1, 0
        for h, k in zip(heads[counts > 1], counts[counts > 1]):
            c = codes[h:h + k] - codes[h]
            while lowest < len(free) and self.check[free[lowest]] != self.FREE:
                lowest += 1
            places = free[lowest:lowest + self.TRIES, None] + c
            fits = (places[:, -1] < len(self.check)) & (
                self.check[np.minimum(places, len(self.check) - 1)] == self.FREE).all(axis=1)
            if fits.any():
                to = places[fits.argmax()]
            else:
                to = used + c
                self._grow(int(to[-1]) + 1)
                free = np.concatenate([free[lowest:], np.arange(to[0] + 1, to[-1])])
                lowest = 0
            used = max(used, int(to[-1]) + 1)
            self.check[to], self.base[parents[h]] = parents[h], to[0] - codes[h]
        one = heads[counts == 1]
        self._grow(len(self.check) + max(0, len(one) - int((self.check == self.FREE).sum())))
        to = np.flatnonzero(self.check == self.FREE)[:len(one)]
        self.check[to], self.base[parents[one]] = parents[one], to - codes[one]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of ``states`` by ``codes``."""
        to = self.base[states] + codes
        if not (self.check[to] == states).all():
            raise ValueError("no such child")
        return to


NODES = ("is_open boolean, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv bigint, parent_conv bigint, depth bigint, "
         "n bigint, chars bigint, children bigint, leaves bigint, saved bigint, sha string")


def shard_nodes(band, root, items, n, conv, sha) -> pa.RecordBatch:
    """The nodes of one shard: final where closed, partial sums where open."""
    m = len(band)
    size = np.array([len(x) // ITEM for x in items])
    ends = np.cumsum(size)
    begins = ends - size
    flat = np.frombuffer(b"".join(items), dtype=_ITEM)
    seg = np.repeat(np.arange(m), size)
    place = np.arange(len(flat)) - begins[seg]
    # Keys of the nodes along each segment.
    keys = []
    for k, r in zip(item_keys(flat, band[seg] * BAND + place), root):
        run = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(k)])
        keys.append(run[1:] ^ run[begins[seg]] ^ r[seg])
    # Dense ids, by first use.
    _, first, code = np.unique(flat.view(f"V{ITEM}"), return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    code = rank[code]
    tries = np.concatenate([[0], np.cumsum((band[1:] != band[:-1]) | (root[0][1:] != root[0][:-1])
                                           | (root[1][1:] != root[1][:-1]))])
    n_tries = int(tries[-1]) + 1
    array = DoubleArray(n_tries)
    state = tries.copy()
    for d in range(int(size.max(initial=0))):
        here = np.flatnonzero(size > d)
        c = code[begins[here] + d]
        pair = np.unique(np.stack([state[here], c]), axis=1)
        array.add_children(pair[0], pair[1])
        state[here] = array.base[state[here]] + c
    # Walk the array: members, smallest member, key and openness of every node.
    slots = len(array.check)
    members, least = np.zeros(slots, np.int64), np.full(slots, np.iinfo(np.int64).max)
    key = [np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)]
    depth, chars = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    is_open, digests = np.zeros(slots, bool), np.full(slots, None, object)
    cut = size == BAND
    cut[[0, -1]] = True
    state = tries.copy()
    is_open[:n_tries] = True
    for i in (0, 1):
        key[i][tries] = root[i]
    depth[tries] = band * BAND
    top = band == 0
    np.add.at(members, tries[top], n[top])
    np.minimum.at(least, tries[top], conv[top])
    levels = []
    for d in range(int(size.max(initial=0))):
        here = np.flatnonzero(size > d)
        at = begins[here] + d
        to = array.step(state[here], code[at])
        np.add.at(members, to, n[here])
        np.minimum.at(least, to, conv[here])
        is_open[to[cut[here]]] = True
        for i in (0, 1):
            key[i][to] = keys[i][at]
        depth[to], chars[to] = band[here] * BAND + d + 1, flat["n"][at]
        state[here] = to
        levels.append(np.unique(to))
    digests[state] = sha
    # Sums over closed subtrees, from the deepest level up.
    saved = np.where(members > 0, (members - 1) * chars, 0)
    children, leaves, below = (np.zeros(slots, np.int64) for _ in range(3))
    for nodes in reversed(levels):
        closed = nodes[~is_open[nodes]]
        leaves[closed] += children[closed] == 0
        below[closed] += saved[closed]
        up = array.check[closed]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[closed])
        np.add.at(below, up, below[closed])
    nodes = np.flatnonzero(array.check != DoubleArray.FREE)
    opened, up = is_open[nodes], array.check[nodes]
    is_root = up == DoubleArray.ROOT
    own_parent = ~opened & ~is_open[np.maximum(up, 0)]
    signed = [k.view(np.int64) for k in key]
    no_key = ~opened
    cols = [
        pa.array(opened), *[pa.array(k[nodes], mask=no_key) for k in signed],
        *[pa.array(k[np.maximum(up, 0)], mask=is_root | own_parent) for k in signed],
        pa.array(least[nodes], mask=members[nodes] == 0),
        pa.array(least[np.maximum(up, 0)], mask=~own_parent), pa.array(depth[nodes]), pa.array(members[nodes]),
        pa.array(chars[nodes]), pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(below[nodes]),
        pa.array(list(digests[nodes]), pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in NODES.split(", ")])


def trie_nodes(segs: DataFrame, ends: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of all shards (``NODES``)."""
    distinct = rooted(segs).groupBy("band", "r1", "r2", "items", "x1", "x2").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("conv"))
    on = ((F.col("r1").bitwiseXOR(F.col("x1")) == F.col("e1")) & (F.col("r2").bitwiseXOR(F.col("x2")) == F.col("e2")))
    order = ["band", "r1", "r2", "items"]
    shards = distinct.join(ends, on, "left").repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, "n", "conv", "sha")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        turns = 0

        def pack():
            band, r1, r2, items, n, conv, sha = zip(*held)
            held.clear()
            ints = lambda x: np.array(x, np.int64)
            return shard_nodes(ints(band), (ints(r1).view(np.uint64), ints(r2).view(np.uint64)), items, ints(n),
                               ints(conv), np.array(sha, object))

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(row)
                turns += len(row[3]) // ITEM + 1
                if turns >= shard_turns:
                    yield pack()
                    turns = 0
        if held:
            yield pack()

    return shards.mapInArrow(run, NODES)


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``k1, k2, leaves, saved``: sums over subtrees, by doubling: about log2 of
    the greatest depth rounds over the open nodes."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    held = nodes.select("k1", "k2", F.col("p1").alias("j1"), F.col("p2").alias("j2"), "leaves", "saved")
    step = 1
    while step <= deepest:
        given = held.where("j1 is not null").groupBy(F.col("j1").alias("g1"), F.col("j2").alias("g2")).agg(
            F.sum("leaves").alias("gl"), F.sum("saved").alias("gs"))
        over = held.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("j1").alias("n1"), F.col("j2").alias("n2"))
        held = written(
            held.join(given, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left")
            .join(over, (F.col("j1") == F.col("o1")) & (F.col("j2") == F.col("o2")), "left")
            .select("k1", "k2", F.col("n1").alias("j1"), F.col("n2").alias("j2"),
                    (F.col("leaves") + F.coalesce("gl", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("gs", F.lit(0))).alias("saved")), "subtrees")
        step *= 2
    return held.select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), F.col("leaves").alias("all_leaves"),
                       F.col("saved").alias("all_saved"))


def conversation_trie(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    segs = written(joined_fragments(segments(sorted_turns(convs, id_col, turn_col, role_col, text_col))), "segments")
    nodes = written(trie_nodes(segs, ends_digests(segs), shard_turns), "nodes")
    part = nodes.where("is_open").groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv").alias("conv"), F.max("depth").alias("depth"),
        F.sum("n").alias("n"), F.max("chars").alias("chars"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("sha").alias("sha"))
    part = written(part, "open")
    below = part.where("p1 is not null").groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(
        F.count(F.lit(1)).alias("open_children"))
    whole = written(
        part.join(below, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left").select(
            "k1", "k2", "p1", "p2", "conv", "depth", "n", "sha",
            (F.col("children") + F.coalesce("open_children", F.lit(0))).alias("children"), "leaves",
            (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved"))
        .withColumn("leaves", F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0)), "upper")
    sums = subtree_sums(whole)
    parents = whole.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("up_conv"))
    to_parent = (F.col("p1") == F.col("u1")) & (F.col("p2") == F.col("u2"))
    upper = (whole.join(sums, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")))
             .join(parents, to_parent, "left")
             .select("conv", "depth", F.col("up_conv").alias("parent"), "n", "children",
                     F.col("all_leaves").alias("leaves"), F.col("all_saved").alias("saved"), "sha"))
    lower = nodes.where(~F.col("is_open")).join(parents, to_parent, "left").select(
        "conv", "depth", F.coalesce("up_conv", "parent_conv").alias("parent"), "n", "children", "leaves", "saved", "sha")
    return upper.unionByName(lower).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(NO_MEMBERS)).alias("ends_sha256"))
