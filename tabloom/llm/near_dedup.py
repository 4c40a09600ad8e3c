"""MinHash near-dedup by a multi-index Hamming join.

A document's signature has POSITIONS MinHash values of BITS bits. Signatures that differ in at
most DISTANCE positions have, by pigeonhole, one of CHUNKS chunks with at most one difference; a
key for each chunk and each position left out of it finds all those pairs. A pair with more
differences is still found unless every chunk has two: at a similarity of 0.85 that leaves out
about 3 pairs in 10 million, at 0.8 about 2 in 100,000. Pairs that meet are compared by signature
up to the distance that a similarity at the threshold exceeds once in a million times.

Groups are never expanded into pairs. Equal sets are collapsed first. A key's members are
compared by signature, of which only a spanning forest leaves (candidates). Candidate components
are then verified on full sets, which gives a spanning forest of the true links, and the
components of these are the result.

Both steps compare a small group at once. The members of a large one are compared with a
representative first, then what isn't linked to it with a second one: work that grows with the
members alone. Members that are connected by then, by whatever links, need no further comparison; the rest
are compared in pairs of blocks, but for pairs of blocks that lie in one component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, find_words, hash_words, materialise, mix64, release, row_slices, utf8_column

#: Positions of a signature and bits of each; the signature distance (positions that differ) up to
#: which every pair is found.
POSITIONS, BITS, DISTANCE = 60, 16, 19
#: Words of a shingle, and the similarity that links: 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 80
#: Pigeonhole: with one difference allowed in a chunk, CHUNKS * 2 > DISTANCE.
CHUNKS = DISTANCE // 2 + 1
#: Members of a key, and of a candidate component, that are compared in one block; larger groups go by representatives.
KEY_BLOCK, SET_BLOCK = 2048, 512
#: Edges (both ways) that one task holds: 16 MB.
TASK_EDGES = 1 << 20
#: Representatives that a large group's members are compared with before blocks are.
REPRESENTATIVES = 2
#: A set that this part of all rows has is joined to them by a broadcast.
HOT_PARTS = 2000
#: Elements for which a member counts at least when blocks of sets are cut.
SET_ELEMENTS = 2000

_rng = np.random.Generator(np.random.PCG64(99))
_MUL = _rng.integers(1, 2**63, POSITIONS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(1, 2**63, POSITIONS, dtype=np.uint64)
_ORDER = _rng.integers(1, 2**63, 32, dtype=np.uint64) | np.uint64(1)  # for the places of words in a shingle


def far(percent: int) -> int:
    """Differing positions that two documents of this similarity exceed about once in a million times."""
    p = 1 - percent / 100
    return min(POSITIONS, max(DISTANCE, math.ceil(POSITIONS * p + 5 * math.sqrt(POSITIONS * p * (1 - p)))))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(elements of the rows' sets end to end, sorted within each row; first element of each row and one more)."""
    starts, ends, rows = find_words(data, offsets)
    h = hash_words(data, starts, ends)
    n_rows = len(offsets) - 1
    first = np.searchsorted(rows, np.arange(n_rows + 1))
    counts = np.diff(first)
    parts, owners = [], []
    if len(h) >= size:
        s = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            s = mix64(s ^ (h[k : len(h) - size + 1 + k] * _ORDER[k]))
        whole = rows[: len(s)] == rows[size - 1 :]
        parts.append(s[whole])
        owners.append(rows[: len(s)][whole])
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        s = np.array([counts[i]], np.uint64)
        for k in range(first[i], first[i + 1]):
            s = mix64(s ^ (h[k : k + 1] * _ORDER[-1]))
        parts.append(s)
        owners.append(np.array([i]))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    sets, own = np.concatenate(parts), np.concatenate(owners)
    # Rows in the top bits, so that one sort orders rows and elements alike; elements keep 52 bits.
    keyed = np.sort((own.astype(np.uint64) << np.uint64(52)) | (sets >> np.uint64(12)))
    keyed = keyed[np.concatenate([[True], keyed[1:] != keyed[:-1]])]
    own = (keyed >> np.uint64(52)).astype(np.int64)
    return keyed & np.uint64((1 << 52) - 1), np.searchsorted(own, np.arange(n_rows + 1))


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """BITS-bit MinHash values, rows x POSITIONS; rows with an empty set get zeros."""
    out = np.zeros((len(first) - 1, POSITIONS), np.uint16)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        at = first[:-1][full]
        for k in range(POSITIONS):
            v = sets * _MUL[k] + _ADD[k]
            v ^= v >> np.uint64(32)
            v *= _MUL[k]
            out[full, k] = (mix64(np.minimum.reduceat(v, at)) >> np.uint64(64 - BITS)).astype(np.uint16)
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit keys of each signature, rows x POSITIONS.

    Chunks are runs of positions. For each chunk and each position in it the key holds the other
    positions' values: signatures whose chunks differ in at most one position share a key.
    """
    bounds = [POSITIONS * c // CHUNKS for c in range(CHUNKS + 1)]
    out = np.zeros(sig.shape, np.uint64)
    wide = sig.astype(np.uint64)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        for left_out in range(a, b):
            h = np.full(len(sig), left_out + 1, np.uint64)
            for k in range(a, b):
                if k != left_out:
                    h = mix64((h ^ wide[:, k]) * _ORDER[0])
            out[:, left_out] = h
    return out


def _sketch(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n, digest of the set, signature)."""
    for batch in batches:
        data, offsets = utf8_column(batch.column(1))
        counts, digests, sigs = [], [], []
        for a, b in row_slices(offsets):
            sets, first = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
            sig = signatures(sets, first)
            for k in range(b - a):
                own = sets[first[k] : first[k + 1]]
                counts.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                sigs.append(sig[k].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "n", "digest", "sig"])
    release()


def _sig_array(column: pa.Array, kind=np.uint16) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(nid, sig) to a row (key, nid) for every key."""
    for batch in batches:
        if batch.num_rows:
            keys = chunk_keys(_sig_array(batch.column(1)))
            nid = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(nid, keys.shape[1]))], names=["key", "nid"])


def forest(close: np.ndarray, left: np.ndarray, right: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that span the components of a boolean matrix of links, as (node, node of its component).

    With right the matrix is between two lists of nodes, otherwise symmetric over left.
    """
    out = []
    if right is None:
        free = np.ones(len(left), bool)
        for i in range(len(left)):
            if not free[i]:
                continue
            free[i] = False
            todo = [i]
            while todo:
                k = todo.pop()
                new = np.flatnonzero(close[k] & free)
                free[new] = False
                out += [(int(left[i]), int(left[j])) for j in new]
                todo += new.tolist()
        return out
    free_l, free_r = np.ones(len(left), bool), np.ones(len(right), bool)
    for i in range(len(left)):
        if not free_l[i]:
            continue
        free_l[i] = False
        todo = [(True, i)]
        while todo:
            on_left, k = todo.pop()
            new = np.flatnonzero((close[k] & free_r) if on_left else (close[:, k] & free_l))
            (free_r if on_left else free_l)[new] = False
            nodes = right if on_left else left
            out += [(int(left[i]), int(nodes[j])) for j in new]
            todo += [(not on_left, j) for j in new.tolist()]
    return out


def _near(sig_a, n_a, sig_b, n_b, percent: int) -> np.ndarray:
    """Which signatures are no further than far() and whose set sizes allow a link. Low bytes are compared: never more differences."""
    differ = np.zeros((len(sig_a), len(sig_b)), np.uint8)
    for k in range(POSITIONS):
        differ += sig_a[:, k, None] != sig_b[None, :, k]
    small = np.minimum(n_a[:, None], n_b[None, :]) * 100 >= percent * np.maximum(n_a[:, None], n_b[None, :])
    return small & (differ <= far(percent))


def _candidates(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, i, j, side, nid, n, sig), sorted by the first three, to candidate edges (u, v)."""

    def one(rows):
        nid, n, sig, side = rows
        if side.all() or not side.any():
            return forest(_near(sig, n, sig, n, percent), nid)
        a, b = ~side, side
        return forest(_near(sig[a], n[a], sig[b], n[b], percent), nid[a], nid[b])

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j = (batch.column(k).to_numpy() for k in range(3))
        side = batch.column(3).to_numpy(zero_copy_only=False)
        nid, n = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        sig = _sig_array(batch.column(6)).astype(np.uint8)
        new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        bounds = [0, *new.tolist(), len(key)]
        edges: list[tuple[int, int]] = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            name = (key[a], i[a], j[a])
            rows = (nid[a:b], n[a:b], sig[a:b], side[a:b])
            if last is not None and name != last:
                edges += one([np.concatenate(x) for x in zip(*held, strict=True)])
                held = []
            last = name
            held.append(rows)
        if edges:
            e = np.array(edges, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["u", "v"])
    if held:
        edges = one([np.concatenate(x) for x in zip(*held, strict=True)])
        if edges:
            e = np.array(edges, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["u", "v"])
    release()


def around_leaders(rows: DataFrame, group: str, block: int) -> DataFrame:
    """Adds (i, j, side): each group's members (side false) in blocks of about `block`, each with a copy of the group's smallest (side true).

    rows: group, m (members of the group), nid, lead (whether the row may be the representative), and what is to be compared.
    """
    leaders = rows.where("lead").groupBy(group).agg(F.min("nid").alias("nid"))
    leaders = rows.join(leaders, [group, "nid"], "left_semi")
    blocks = F.ceil(F.col("m") / block).cast("int")
    members = rows.withColumns({"i": F.pmod(F.xxhash64("nid"), blocks).cast("int"), "side": F.lit(False)})
    copies = leaders.withColumns({"i": F.explode(F.sequence(F.lit(0), blocks - 1)), "side": F.lit(True)})
    return members.unionByName(copies).withColumn("j", F.lit(-1))


def block_pairs(rows: DataFrame, group: str, block: int, weight: Column) -> DataFrame:
    """Adds (i, j, side): a row for every pair of blocks of its group that its own is in, but for pairs within one component.

    rows: group, m, nid, root (component so far), and what is to be compared; each counts by its weight. Components of more than `block`
    members have blocks of their own; smaller ones share blocks, which are paired with themselves too.
    """
    sizes = rows.groupBy(group, "root").agg(F.sum(weight).alias("_n"))
    large = sizes.where(F.col("_n") > block)
    rows = rows.join(large.select(group, "root", F.lit(True).alias("_large")), [group, "root"], "left").withColumn("_of", F.when(F.col("_large"), F.col("root")).otherwise(-1)).drop("_large")
    sizes = sizes.withColumn("_of", F.when(F.col("_n") > block, F.col("root")).otherwise(-1)).groupBy(group, "_of").agg(F.ceil(F.sum("_n") / block).cast("int").alias("_b"))
    rows = rows.join(sizes, [group, "_of"]).withColumn("_own", F.pmod(F.xxhash64("nid"), F.col("_b")).cast("int")).drop("_b")
    # Pairs of components are few; only those of one group's blocks that are left are made.
    other = sizes.select(group, F.col("_of").alias("_of2"), F.col("_b").alias("_b2"))
    pairs = sizes.join(other, group).where((F.col("_of") < F.col("_of2")) | (F.col("_of") == -1) & (F.col("_of2") == -1))
    pairs = pairs.withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("_b2") - 1)))
    pairs = pairs.where((F.col("_of") != F.col("_of2")) | (F.col("_x") <= F.col("_y")))
    name = [F.xxhash64("_of", "_x").alias("i"), F.xxhash64("_of2", "_y").alias("j")]
    left = pairs.select(group, "_of", F.col("_x").alias("_own"), *name, F.lit(False).alias("side"))
    right = pairs.where((F.col("_of") != F.col("_of2")) | (F.col("_x") != F.col("_y"))).select(group, F.col("_of2").alias("_of"), F.col("_y").alias("_own"), *name, F.lit(True).alias("side"))
    return rows.join(left.unionByName(right), [group, "_of", "_own"]).drop("_of", "_own")


def linked(small: DataFrame, large: DataFrame, group: str, block: int, compare: Callable[[DataFrame], DataFrame], name: str, weight: Column) -> DataFrame:
    """Components (node, root) of the links that compare() finds in each group.

    small, large: rows (group, m, nid, ...) of groups of at most, and more than, `block` members.
    compare: from rows with (i, j, side) to links (u, v) of each (group, i, j).
    """
    edges = compare(small.withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(False)}))
    large = materialise(large, f"{name}-large")
    used = [large]
    if large.isEmpty():
        discard(large)
        return components(edges, name)
    edges, large = materialise(edges, f"{name}-links"), large.withColumn("lead", F.lit(True))
    used.append(edges)
    for k in range(REPRESENTATIVES + 1):
        more = compare(around_leaders(large, group, block) if k < REPRESENTATIVES else block_pairs(large.drop("lead"), group, block, weight))
        used.append(materialise(more, f"{name}-links"))
        edges = edges.union(used[-1])
        found = components(edges, name)
        if k == REPRESENTATIVES:
            break
        # Groups that are one component are settled; in the others a member of another component than the first comes next.
        large = large.drop("root", "lead").join(found.select(F.col("node").alias("nid"), "root"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
        state = large.groupBy(group).agg(F.min_by("root", "nid").alias("_first"), (F.min("root") != F.max("root")).alias("_open")).where("_open")
        large = materialise(large.join(state, group).withColumn("lead", F.col("root") != F.col("_first")).drop("_first", "_open"), f"{name}-large")
        used += [found, large]
        if large.isEmpty():
            break
    discard(*[df for df in used if df is not found])
    return found


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is some node of its component.

    Each round hooks every node to its smallest neighbour, jumps pointers twice and contracts the
    edges; what a round hooked is written to the shared folder. As soon as at most TASK_EDGES are
    left, one task joins them. Numbers are hashed order, so rounds grow with the logarithm of the
    largest component.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v").distinct()
    both, steps = materialise(both, f"{name}-edges"), []
    while n := both.count():
        if n <= TASK_EDGES:
            steps.append(materialise(both.where("u < v").repartition(1).mapInArrow(_join_edges, "u long, p long"), f"{name}-rest"))
            break
        hook = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p")), f"{name}-hook")
        first = hook
        for _ in range(2):
            far = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))
            hook = hook.join(far, "p").select("u", F.col("q").alias("p"))
        hook = materialise(hook, f"{name}-jump")
        discard(first)
        steps.append(hook)
        one = both.join(hook, "u").select(F.col("p").alias("a"), "v")
        two = one.join(hook.select(F.col("u").alias("v"), F.col("p").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
        up = hook.select(F.col("u").alias("w"), F.col("p").alias("q"))
        left = hook.select(F.col("p").alias("w")).distinct().join(up, "w").where("w != q")
        rest = two.where("u != v").union(left.select("w", "q")).union(left.select("q", "w")).distinct()
        done, both = both, materialise(rest, f"{name}-edges")
        discard(done)
    if not steps:
        return materialise(both.select(F.col("u").alias("node"), F.col("v").alias("root")), f"{name}-roots")  # empty
    out = steps[0].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for step in steps[1:]:
        far = step.select(F.col("u").alias("root"), F.col("p").alias("q"))
        out = out.join(far, "root", "left").select("node", F.coalesce("q", "root").alias("root"))
    out = materialise(out, f"{name}-roots")
    discard(both, *steps)
    return out


def _join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) to (node, smallest node of its component)."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not held:
        return
    u, v = (np.concatenate(x) for x in zip(*held, strict=True))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    parent = np.arange(len(nodes))
    while len(a):
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[parent])], names=["u", "p"])


def _set_rows(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(nid, c, m, digest, text) to (nid, c, m, set) where the text's set has that digest."""
    for batch in batches:
        data, offsets = utf8_column(batch.column(4))
        want, keep, out = batch.column(3).to_pylist(), [], []
        for a, b in row_slices(offsets):
            sets, first = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
            for k in range(b - a):
                raw = sets[first[k] : first[k + 1]].tobytes()
                if hashlib.blake2b(raw, digest_size=16).digest() == want[a + k]:
                    keep.append(a + k)
                    out.append(raw)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(3)], pa.array(out, pa.binary())], names=["nid", "c", "m", "elements"])
    release()


def intersections(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets[rows] with sets[columns], exactly."""
    out = np.zeros((len(rows), len(columns)), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    name = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]]))
    shared = np.bincount(name)[name] > 1  # the others are in no intersection
    name, owner = name[shared], owner[shared]
    if not len(name):
        return out
    name = np.cumsum(np.concatenate([[0], name[1:] != name[:-1]]))
    for a in range(0, int(name[-1]) + 1, width):
        lo, hi = np.searchsorted(name, [a, a + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[lo:hi], name[lo:hi] - a] = 1
        out += m[rows] @ m[columns].T
    return out


def _verify(percent: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of one pair of blocks (nid, side, elements) to a spanning forest of their links (u, v)."""
    sets = [np.frombuffer(x, np.uint64) for x in pdf["elements"]]
    nid, side = pdf["nid"].to_numpy(), pdf["side"].to_numpy().astype(bool)
    n = np.array([len(s) for s in sets])
    across = side.any() and not side.all()
    rows = np.flatnonzero(~side) if across else np.arange(len(nid))
    columns = np.flatnonzero(side) if across else rows
    both = intersections(sets, rows, columns).astype(np.int64)
    close = both * 100 >= percent * (n[rows][:, None] + n[columns][None, :] - both)
    edges = forest(close, nid[rows], nid[columns] if across else None)
    return pd.DataFrame(edges, columns=["u", "v"], dtype="int64")


def near_dedup(docs: DataFrame, text: str = "text", ident: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each input row: identifier, n_shingles, component_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a set holds the distinct shingles of
    `words` words, or the whole sequence of a shorter text. Documents with 100 * intersection >=
    percent * union are linked; component_id is the smallest identifier that can be reached, and the row
    with it is kept. Null texts count as empty; an empty set is linked with nothing. Rows with a
    null identifier are linked with nothing and kept, with a null component_id. Rows that share an
    identifier share its component. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    given = docs.select(docs[ident].alias("id"), docs[text].alias("text"))
    rows = materialise(given.mapInArrow(partial(_sketch, words), f"id {kind}, n long, digest binary, sig binary"), "near-sketch")
    named = rows.where("id IS NOT NULL AND n > 0")
    # Rows of one identifier with different texts are one document: its sets are linked from the start.
    nodes = named.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies"))
    nodes = materialise(nodes.withColumn("nid", F.monotonically_increasing_id()), "near-nodes")

    keys = nodes.select("nid", "sig").mapInArrow(_keys, "key long, nid long")
    shared = materialise(keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "near-keys")

    def members(some: DataFrame) -> DataFrame:
        return keys.join(some, "key").join(nodes.select("nid", "n", "sig"), "nid")

    def near_signatures(rows: DataFrame) -> DataFrame:
        rows = rows.select("key", "i", "j", "side", "nid", "n", "sig").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return rows.mapInArrow(partial(_candidates, percent), "u long, v long")

    candidates = linked(members(shared.where(F.col("m") <= KEY_BLOCK)), members(shared.where(F.col("m") > KEY_BLOCK)), "key", KEY_BLOCK, near_signatures, "near-candidates", F.lit(1))
    discard(shared)

    group = candidates.select(F.col("node").alias("nid"), F.col("root").alias("c")).join(nodes.select("nid", "id", "digest", "n"), "nid")
    # Members, or thousands of elements: blocks of large sets have fewer members.
    sizes = group.groupBy("c").agg(F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") / SET_ELEMENTS)).alias("m"))
    group = group.join(sizes, "c").select("nid", "id", "digest", "c", "m")
    texts = group.join(given, "id").select("nid", "c", "m", "digest", "text")
    sets = texts.mapInArrow(partial(_set_rows, words), "nid long, c long, m long, elements binary").dropDuplicates(["nid"])
    sets = materialise(sets, "near-sets")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        return _verify(percent, pdf)

    def near_sets(rows: DataFrame) -> DataFrame:
        return rows.groupBy("c", "i", "j").applyInPandas(verify, "u long, v long")

    found = linked(sets.where(F.col("m") <= SET_BLOCK), sets.where(F.col("m") > SET_BLOCK), "c", SET_BLOCK, near_sets, "near-links", F.greatest(F.lit(1), F.ceil(F.octet_length("elements") / (8 * SET_ELEMENTS))))
    discard(sets, candidates)

    # Sets of one identifier are linked whatever their similarity.
    code = F.xxhash64("digest")
    several = named.groupBy("id").agg(F.min(code).alias("_least"), F.max(code).alias("_most")).where("_least != _most").select("id")
    several = named.join(several, "id").select("id", "digest").distinct().join(nodes.select("digest", "nid"), "digest")
    several = several.join(several.groupBy("id").agg(F.min("nid").alias("u")), "id").where("u != nid").select("u", F.col("nid").alias("v"))
    several = materialise(several, "near-several")
    if not several.isEmpty():
        found = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).union(several), "near-all")

    least = found.join(nodes.select(F.col("nid").alias("node"), "id", "digest"), "node")
    least = least.join(least.groupBy("root").agg(F.min("id").alias("component")), "root").select("digest", "component")
    named = nodes.join(least, "digest", "left").select("digest", F.coalesce("component", "id").alias("component"), "copies")
    named = materialise(named, "near-components")
    # Sets that many rows have are few and go to every task, so that no task gathers a set's rows.
    many = F.col("copies") > rows.count() / HOT_PARTS
    marked = rows.join(F.broadcast(named.where(many).select("digest", "component")), "digest", "left")
    rest = marked.where("component IS NULL").drop("component").join(named.where(~many).select("digest", "component"), "digest", "left")
    rows = marked.where("component IS NOT NULL").unionByName(rest)
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return rows.select(
        F.col("id").alias(ident), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )
