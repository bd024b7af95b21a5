"""Near-duplicates by MinHash with tensored banding.

A document is the set of its shingles (runs of words, as 64-bit hashes). Two collections of ``COLLECTION`` half keys, each
made of ``HALF`` minhashes, are computed per set; every pair of a half key of the first and one of the second collection
is a table key. COLLECTION squared tables cost 2 * COLLECTION * HALF minhashes. Two sets of similarity s miss all tables
with probability 2 * (1 - s^HALF)^COLLECTION at most: 0.0015 at 0.8, 0.0002 at 0.85.

1. Equal sets are one class (a 128-bit digest of the sorted set); only classes go on.
2. Table keys travel packed, one row per task and range of keys. Tables where a few classes meet give all their pairs.
   A larger table gives links of all members to one of them and, in some tables, to their neighbours in an order of its
   own, and its members once per task. A text stands in many tables, so this is a sample of its partners that joins a group.
3. Pairs are confirmed on the full sets; confirmed pairs make components.
4. Members of larger tables that share a half key of the first collection, as all members of a table do, are a group: at
   most COLLECTION rows per member instead of COLLECTION squared. In a group of several components, the pairs between
   components are confirmed as well, so no pair that meets in a table is left out. Pairs that could not change a component
   are not looked at, nor pairs whose sets do not share one of their rarest shingles, as similar sets must, or whose
   sketches show that they differ too much.

A key with many classes in one task is settled there: the task links them and passes on one of them, so that no key is
more than ``TABLE`` rows per task. Documents are shuffled once, narrow rows otherwise; all links stay distributed.

A document without words has an empty set, is linked with nothing and is its own component. Repeated rows and rows that
share an id get a row each. Components are named by their smallest id; NULL ids only name a component of nothing else.
Further columns do not matter, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, nested, shuffle_partitions, stored, texts_for_python, unnested
from .components import components
from .textwords import STEP, blank_separated, mix, shingles, slices, text_arrays

SHINGLE = 5
PERCENT = 80
COLLECTION = 10
HALF = 3
TABLE = 16
LINKED_TABLES = 8
ROW_ENTRIES = 1024
CHUNK = 8192
SKETCH_LONGS = 16

_rng = np.random.default_rng(20240501)
_FLIPS = _rng.integers(0, 1 << 63, 2 * COLLECTION * HALF, dtype=np.uint64)
_ODDS = _rng.integers(0, 1 << 63, 2 * COLLECTION * HALF, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def half_keys(found: np.ndarray) -> np.ndarray:
    """The half keys of a set: COLLECTION of the first and COLLECTION of the second collection."""
    least = np.full(len(_ODDS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 2048):
        np.minimum(least, ((found[start : start + 2048, None] ^ _FLIPS) * _ODDS).min(axis=0), out=least)
    groups = least.reshape(2 * COLLECTION, HALF)
    keys = groups[:, 0]
    for column in range(1, HALF):
        keys = mix(keys * STEP + groups[:, column])
    return keys


def _sets(batch: pa.RecordBatch, column: int, words, size: int):
    """The sorted distinct shingles of each text of a batch."""
    hashes, firsts = words.hashes(*text_arrays(batch.column(column)))
    runs, owners = shingles(hashes, firsts, size)
    cuts = np.searchsorted(owners, np.arange(batch.num_rows + 1))
    for row in range(batch.num_rows):
        yield np.unique(runs[cuts[row] : cuts[row + 1]])


def _digest(found: np.ndarray) -> str:
    return hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest()


def signatures(documents: DataFrame, size: int) -> DataFrame:
    """doc_key, doc_id, n_shingles, digest (NULL for an empty set), halves (packed half keys)."""
    words = blank_separated()

    def sign(batches):
        for batch in slices(batches, 2):
            counts, digests, halves = [], [], []
            for found in _sets(batch, 2, words, size):
                counts.append(len(found))
                digests.append(_digest(found) if len(found) else None)
                halves.append(half_keys(found).tobytes() if len(found) else None)
            arrays = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(halves, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_key", "doc_id", "n_shingles", "digest", "halves"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    keyed = texts_for_python(documents.select(F.xxhash64("doc_id", "text").alias("doc_key"), "doc_id", "text"))
    return keyed.mapInArrow(sign, f"doc_key long, doc_id {kind}, n_shingles long, digest string, halves binary")


def _groups(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and nodes by key and node without repeats, where each key begins, and how many nodes it has."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys, nodes, starts, np.diff(np.append(starts, len(keys)))


def _small_pairs(nodes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All pairs within tables of up to TABLE nodes, without repeats."""
    parts = []
    for count in range(2, TABLE + 1):
        at = starts[counts == count]
        if len(at):
            a, b = np.triu_indices(count, 1)
            parts.append(np.stack([nodes[at[:, None] + a].ravel(), nodes[at[:, None] + b].ravel()], axis=1))
    return np.unique(np.concatenate(parts), axis=0) if parts else np.zeros((0, 2), np.int64)


def _large_tables(keys, nodes, counts, large) -> tuple[np.ndarray, np.ndarray]:
    """Of larger tables: pairs of every node with one node of the table, and in one of LINKED_TABLES tables also with its
    neighbour; the nodes of all members, each once.

    The one node is the first in an order that all tasks share, so tables of the same texts give the same pairs.
    """
    if not large.any():
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    inside = np.repeat(large, counts)
    keys, nodes, counts = keys[inside], nodes[inside], counts[large]
    table = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((mix(nodes.astype(np.uint64)), table))
    middle = np.repeat(nodes[order][np.concatenate([[0], np.cumsum(counts)[:-1]])], counts)
    other = middle != nodes
    pairs = [np.stack([np.minimum(middle, nodes)[other], np.maximum(middle, nodes)[other]], axis=1)]
    order = np.lexsort((mix(keys ^ (nodes.astype(np.uint64) * STEP)), table))
    near, far = order[:-1], order[1:]
    linked = (table[near] == table[far]) & (keys[near] % np.uint64(LINKED_TABLES) == 0)
    near, far = nodes[near[linked]], nodes[far[linked]]
    pairs.append(np.stack([np.minimum(near, far), np.maximum(near, far)], axis=1))
    return np.unique(np.concatenate(pairs), axis=0), np.unique(nodes)


def _found_batch(pairs: np.ndarray, nodes: np.ndarray, part=None, packed=None) -> pa.RecordBatch:
    """Rows of the exchange: x and y of a pair; or x of a member; or packed keys and nodes for a part."""
    n, m = len(pairs), len(nodes)
    extra = 0 if part is None else len(part)
    empty = lambda kind, size: pa.nulls(size, kind)
    x = pa.concat_arrays([pa.array(pairs[:, 0]), pa.array(nodes), empty(pa.int64(), extra)])
    y = pa.concat_arrays([pa.array(pairs[:, 1]), empty(pa.int64(), m + extra)])
    spread = (np.concatenate([pairs[:, 0], nodes]) % 997).astype(np.int32)  # rows that only pass through
    part_column = pa.concat_arrays([pa.array(spread), pa.array(part if extra else [], pa.int32())])
    packed_columns = [pa.concat_arrays([empty(pa.binary(), n + m), pa.array([p[i] for p in packed or []], pa.binary())]) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([part_column, x, y, *packed_columns], ["part", "x", "y", "keys", "nodes"])


_FOUND = "part int, x long, y long, keys binary, nodes binary"


def _meeting(classes: DataFrame) -> DataFrame:
    """x, y of candidate pairs, and x of the members of larger tables (y is NULL there)."""
    partitions = shuffle_partitions(classes.sparkSession)
    parts = 4 * partitions

    def keyed(batches):
        def packed(node_parts, half_parts):
            nodes = np.concatenate(node_parts)
            halves = np.frombuffer(b"".join(half_parts), np.uint64).reshape(len(nodes), 2 * COLLECTION)
            first = mix(halves[:, :COLLECTION] + np.arange(COLLECTION, dtype=np.uint64))[:, :, None]
            second = mix(halves[:, COLLECTION:] ^ (np.arange(COLLECTION, dtype=np.uint64) * STEP))[:, None, :]
            keys = mix(first * STEP + second).reshape(-1)
            keys, members, starts, counts = _groups(keys, np.repeat(nodes, COLLECTION * COLLECTION))
            large = counts > TABLE
            pairs, large_nodes = _large_tables(keys, members, counts, large)
            # Of a table that is settled here one node goes on, as its complement: the table is then a larger one everywhere.
            keep = np.repeat(~large, counts)
            keep[starts[large]] = True
            members[starts[large]] = ~members[starts[large]]
            keys, members = keys[keep], members[keep]
            target = (keys >> np.uint64(32)).astype(np.int64) * parts >> 32
            cuts = np.searchsorted(target, np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts)).astype(np.int32)
            pieces = [(p, a, min(a + ROW_ENTRIES, cuts[p + 1])) for p in full for a in range(cuts[p], cuts[p + 1], ROW_ENTRIES)]
            blobs = [(keys[a:b].tobytes(), members[a:b].tobytes()) for _, a, b in pieces]
            return _found_batch(pairs, large_nodes, np.array([p for p, _, _ in pieces], np.int32), blobs)

        node_parts, half_parts, held = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                node_parts.append(piece.column(0).to_numpy())
                half_parts += piece.column(1).to_pylist()
                held += piece.num_rows
                if held >= CHUNK:
                    yield packed(node_parts, half_parts)
                    node_parts, half_parts, held = [], [], 0
        if held:
            yield packed(node_parts, half_parts)

    def meet(batches):
        def settled(keys, nodes):
            keys, nodes = np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(nodes), np.int64)
            settled_before = np.unique(keys[nodes < 0])
            keys, nodes, starts, counts = _groups(keys, np.where(nodes < 0, ~nodes, nodes))
            large = (counts > TABLE) | (np.isin(keys[starts], settled_before) & (counts > 1))
            pairs, large_nodes = _large_tables(keys, nodes, counts, large)
            small = _small_pairs(nodes, starts[~large], counts[~large])
            return _found_batch(np.concatenate([small, pairs]), large_nodes)

        current, keys, nodes = None, [], []
        for batch in batches:
            passing = batch.filter(pa.compute.is_null(batch.column("keys")))
            if passing.num_rows:
                yield passing
            packed = batch.filter(pa.compute.is_valid(batch.column("keys")))
            for part, key, node in zip(*(packed.column(name).to_pylist() for name in ("part", "keys", "nodes"))):
                if part != current and keys:
                    yield settled(keys, nodes)
                    keys, nodes = [], []
                current = part
                keys.append(key)
                nodes.append(node)
        if keys:
            yield settled(keys, nodes)

    dealt = classes.select("node", "halves").mapInArrow(keyed, _FOUND).repartition(partitions, "part")
    return dealt.sortWithinPartitions("part").mapInArrow(meet, _FOUND).select("x", "y")


def _shingle_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, found (the sorted set, packed) of the wanted classes (node, digest, doc_key)."""
    words = blank_separated()

    def pack(batches):
        for batch in slices(batches, 1):
            found = [one.tobytes() for one in _sets(batch, 1, words, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "found"])

    keyed = documents.select(F.xxhash64("doc_id", "text").alias("doc_key"), "text")
    sets = keyed.join(wanted.select("node", "doc_key"), "doc_key").select("node", "text").mapInArrow(pack, "node long, found binary")
    return sets.dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets have the similarity."""

    def compare(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                small, large = min(len(a), len(b)), max(len(a), len(b))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    held = pairs.join(sets.select(F.col("node").alias("y"), F.col("found").alias("found_y")), "y")
    held = held.join(sets.select(F.col("node").alias("x"), F.col("found").alias("found_x")), "x")
    return held.select("x", "y", "found_x", "found_y").mapInArrow(compare, "x long, y long")


def _sketch() -> list[Column]:
    """For the shingles of a set: columns b0, b1, ...; a bit is set if an odd number of them falls on it.

    Each shingle that only one of two sets has flips one bit, so the sketches differ in as many bits at most as the sets
    have shingles apart. Where few shingles fall on a bit, that is nearly their number.
    """
    lane, bit = f"shingle & {SKETCH_LONGS - 1}", "CAST(shiftrightunsigned(shingle, 32) & 63 AS INT)"
    return [F.expr(f"coalesce(bit_xor(CASE WHEN {lane} = {i} THEN shiftleft(1L, {bit}) END), 0L)").alias(f"b{i}") for i in range(SKETCH_LONGS)]


def _crossing(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """x, y: pairs of members (table, x, component, n) of different components that could be similar.

    Only members of tables with several components are looked at; any grouping whose tables hold all pairs in question does.
    Two sets of n and m shingles must share ``least = percent * (n + m) / (100 + percent)``. So of any order of the
    shingles they share one among the first n - least + 1 of one and the first m - least + 1 of the other; in the order
    of frequency few sets meet there. A set also shares no more shingles than stand in sets of other components at all.
    Within a shingle only the members outside its most frequent component look for partners. Sets that differ in more
    bits of their sketches than they may in shingles are not similar; of a large group of variants few others are left.
    """

    def spread(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                found = [np.frombuffer(value.as_buffer(), np.int64) for value in piece.column(2)]
                counts = [len(one) for one in found]
                columns = [np.repeat(piece.column(i).to_numpy(), counts) for i in (0, 1)]
                columns += [np.concatenate(found), np.repeat(counts, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "component", "shingle", "n"])

    # Tables with several components, and the smallest set that a member meets in its tables.
    tables = members.groupBy("table").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.min("n").alias("smallest"))
    nodes = members.join(tables.filter("a <> b").select("table", "smallest"), "table").groupBy(F.col("x").alias("node"), "component")
    nodes = stored(nodes.agg(F.min("smallest").alias("m")), "split-members")
    held = nodes.join(sets, "node").select("node", "component", "found")
    rows = held.mapInArrow(spread, "node long, component long, shingle long, n long")
    often = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("often"), (F.min("component") != F.max("component")).alias("across")
    )
    ranked = rows.join(often, "shingle").groupBy("node", "component", "n")
    ranked = ranked.agg(
        F.sort_array(F.collect_list(F.struct("often", "across", "shingle"))).alias("ranked"),
        F.sum(F.col("across").cast("long")).alias("outer"),
        *_sketch(),
    )
    ranked = stored(ranked, "ranked")

    least = F.greatest(
        F.ceil(F.col("n") * percent / 100 - 1e-9), F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent) - 1e-9)
    )
    entries = ranked.join(nodes.select("node", "m"), "node").filter(F.col("outer") >= least)
    first = F.slice("ranked", 1, (F.col("n") - least + 1).cast("int"))
    bits = [f"b{i}" for i in range(SKETCH_LONGS)]
    entries = entries.select("node", "component", "n", "outer", *bits, F.posexplode(first).alias("place", "s")).filter("s.across")
    entries = stored(entries.select("node", "component", "n", "outer", *bits, "place", F.col("s.shingle").alias("shingle")), "entries")

    groups = entries.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("k"))
    groups = groups.groupBy("shingle").agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count(F.lit(1)).alias("n"))
    seeking = entries.join(groups.filter("n > 1").select("shingle", "main"), "shingle").filter("component <> main")
    common = F.least("a.outer", "b.outer")
    both = F.col("a.n") + F.col("b.n")
    shared = F.ceil(both * percent / (100 + percent) - 1e-9)
    apart = reduce(add, [F.bit_count(F.col(f"a.{b}").bitwiseXOR(F.col(f"b.{b}"))) for b in bits])
    able = (
        (F.col("a.component") != F.col("b.component"))
        & (common * 100 >= (both - common) * percent)
        & (F.col("a.place") <= F.col("a.n") - shared)
        & (F.col("b.place") <= F.col("b.n") - shared)
        & (apart <= both - 2 * shared)
    )
    met = seeking.alias("a").join(entries.alias("b"), (F.col("a.shingle") == F.col("b.shingle")) & able)
    return met.select(F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")).distinct()


def _first_halves() -> Column:
    """One row per half key of the first collection; members of a table share one of them."""
    return F.explode(F.transform(F.sequence(F.lit(0), F.lit(COLLECTION - 1)), lambda i: F.xxhash64(i, F.substring("halves", 8 * i + 1, 8))))


def _classes(signed: DataFrame) -> DataFrame:
    """node, digest, doc_key, smallest doc_id, halves, n: one row per distinct set."""
    classes = signed.filter("digest IS NOT NULL").groupBy("digest")
    classes = classes.agg(F.min("doc_id").alias("first_id"), F.first("doc_key").alias("doc_key"), F.first("halves").alias("halves"), F.first("n_shingles").alias("n"))
    return stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")


def near_duplicates(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_key, doc_id, n_shingles, digest, component (its node), component_id, kept of every row."""
    signed = stored(signatures(documents, size), "signatures")
    classes = _classes(signed)
    found = stored(_meeting(classes), "meetings")
    pairs = stored(found.filter("y IS NOT NULL").select("x", "y").distinct(), "pairs")
    members = found.filter("y IS NULL").select("x").distinct()

    nodes = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).union(members.select("x")).distinct()
    wanted = classes.select("node", "digest", "doc_key").join(nodes, "node")
    sets = stored(_shingle_sets(documents, wanted, size), "sets")
    links = stored(_confirmed(pairs, sets, percent), "links")
    labels = components(links)

    # Pairs between the components that may still meet in a larger table.
    known = classes.select("node", "n", "halves").join(labels, "node", "left").withColumnRenamed("node", "x")
    placed = members.join(known, "x").select(_first_halves().alias("table"), "x", F.coalesce("component", "x").alias("component"), "n")
    placed = stored(placed, "members")
    crossing = stored(_crossing(placed, sets, percent).join(pairs, ["x", "y"], "left_anti"), "crossing")
    more = stored(_confirmed(crossing, sets, percent), "links")
    if not more.isEmpty():
        name = {end: labels.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")) for end in ("x", "y")}
        joined = more.join(name["x"], "x", "left").join(name["y"], "y", "left")
        joined = components(joined.select(F.coalesce("of_x", "x").alias("x"), F.coalesce("of_y", "y").alias("y")))
        # Nodes that had no link before are components of their own.
        single = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
        later = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
        labels = labels.union(single).join(later, "component", "left")
        labels = stored(labels.select("node", F.coalesce("top", "component").alias("component")), "labels")
    named = classes.join(labels, "node", "left").select("digest", "first_id", F.coalesce("component", "node").alias("component"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "component").select("digest", "component", "component_id")
    result = signed.drop("halves").join(named, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_key", "doc_id", "n_shingles", "digest", "component", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def near_duplicate_report(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(documents, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def without_near_duplicates(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id, NULL last; of repeated rows one stays."""
    rows = near_duplicates(documents, size, percent)
    # A text without words is in no component and stays for itself.
    groups = rows.groupBy("component", F.when(F.col("component").isNull(), F.col("doc_key")).alias("single"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key"))
    kept = groups.agg(first.alias("first")).select("first.doc_key").distinct()
    keyed = nested(documents).withColumn("doc_key", F.xxhash64(f"{ROW}.doc_id", f"{ROW}.text"))
    return unnested(keyed.join(kept, "doc_key").dropDuplicates(["doc_key"]), documents.columns)
