"""N-gram Jaccard join over a count-vector R-tree.

1. Each document becomes the set of its hashed word n-grams.  Documents with equal sets are one node, named
   by a hash over the set, so exact copies never meet one another.
2. The space is partitioned without loss.  Two sets that link differ in at most r members, where r follows
   from their sizes.  Dealt by hash into r + 1 blocks or more, they agree in at least one whole block, so
   the hash of a block (with its number and a size class) is a key under which linked nodes meet.  Should
   all blocks in which they agree be empty, both have more empty blocks than the spare ones; such nodes also
   meet under the first members of their sets in hash order (prefix filter).  Keys travel packed, once per
   slice of documents and node, and shortened to 40 bits within a part of the hash space: nodes that meet by
   chance are refuted later like all others.
3. Nodes under one key are a group; equal groups count once, and groups that share nodes form a region.  In
   each group the points of the nodes (n-grams hashed, counted) are indexed by a packed R-tree; the sum of
   smaller coordinates bounds what two nodes share, and pairs that survive are verified on the sets
   themselves.  Pairs that are linked already over others are not looked at.  A task takes whole regions; the
   groups of a region of more than `region_bytes` are dealt out by their smallest node.  A group that is larger
   itself is cut by hash into pieces: each is searched with the group's smallest node, and then only the
   nodes that are not linked with that one are compared with all pieces.
4. Connected components of the links, by alternating stars, give each document its class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, MIX_A, MIX_B, NOT_SPACE, U64, Words, mix, part_of, runs, text_bytes
from tidemark.llm.chunks import carried, slices
from tidemark.llm.components import components
from tidemark.llm.count_tree import linked
from tidemark.llm.storage import stored

SHINGLE, PERCENT = 3, 90
REGION_BYTES = 16_000_000  # of sets in one task
PART_KEYS = 1_000_000
KEY_BITS = U64((1 << 40) - 1)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members, first, name): the sorted set members[first[i]:first[i + 1]] of each text, and a hash over it."""
    words = Words(*text_bytes(texts), NOT_SPACE)
    hashes = words.hashes(LOWER)
    n = len(texts)
    count = np.diff(words.first)
    start = np.flatnonzero(words.left_in_text() >= shingle)
    grams, owner = [runs(hashes, shingle)[start]], [np.searchsorted(words.first, start, "right") - 1]
    for few in range(1, shingle):  # texts of fewer words are one shingle
        short = np.flatnonzero(count == few)
        grams.append(mix(runs(hashes, few)[words.first[short]] + U64(few)))
        owner.append(short)
    grams, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.append([True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))[:len(grams)]
    grams, owner = grams[new], owner[new]
    first = np.searchsorted(owner, np.arange(n + 1))
    total = np.zeros(len(grams) + 1, dtype=U64)
    np.cumsum(mix(grams ^ MIX_A), out=total[1:])
    return grams, first, mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(U64) * MIX_B)


class SizeClasses:
    """Classes of set sizes such that sets that link are in one class or in neighbouring ones, and the blocks for each."""

    def __init__(self, largest: int, percent: int):
        low, high, differ, blocks = [], [], [], []
        least = 1
        while least <= max(largest, 1):
            most = max(least, 100 * least // percent)
            # Sets of a and b members that link differ in at most (a + b)(100 - percent) / (100 + percent).
            r = (most + 100 * most // percent) * (100 - percent) // (100 + percent)
            spare = 0.0
            for _ in range(20 if least >= 40 else 0):
                empty = (r + 1 + spare) * math.exp(-least / (r + 1 + spare))
                spare = min(empty + 3 * math.sqrt(empty), r + 1)
            low.append(least)
            high.append(most)
            differ.append(r)
            blocks.append(r + 1 + math.ceil(spare))
            least = most + 1
        self.low, self.differ, self.blocks = (np.array(x, dtype=np.int64) for x in (low, differ, blocks))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


def meeting_keys(members: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, set) such that any two sets that link, and are not equal, have a key in common."""
    sizes = np.diff(first)
    classes = SizeClasses(int(sizes.max(initial=0)), percent)
    own = classes.of(sizes)
    keys, owners = [], []
    for label in (own, own - 1):  # pairs within a class, and with the next class
        use = np.flatnonzero((sizes > 0) & (label >= 0) & (classes.differ[label] > 0))
        if not len(use):
            continue
        label, size = label[use], sizes[use]
        owner = np.repeat(np.arange(len(use)), size)
        value = members[np.arange(size.sum()) + np.repeat(first[use] - (np.cumsum(size) - size), size)]
        blocks = classes.blocks[label]
        base = np.concatenate([[0], np.cumsum(blocks)])
        block = (((mix(value ^ MIX_B) >> U64(32)) * blocks[owner].astype(U64)) >> U64(32)).astype(np.int64) + base[owner]
        total = np.zeros(base[-1], dtype=U64)
        np.add.at(total, block, mix(value))
        filled = np.bincount(block, minlength=base[-1]) > 0
        where = np.repeat(np.arange(len(use)), blocks)
        number = np.arange(base[-1]) - base[where]
        key = mix(total + mix((label[where].astype(U64) << U64(32)) + number.astype(U64)))
        keys.append(key[filled])
        owners.append(use[where[filled]])
        empty = blocks - np.bincount(where[filled], minlength=len(use))
        lacking = empty >= blocks - classes.differ[label]
        prefix = size + 1 - -(-percent * size // 100)
        at = np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
        chosen = lacking[owner] & (at < prefix[owner])
        keys.append(mix(value[chosen] + mix(~label[owner[chosen]].astype(U64))))
        owners.append(use[owner[chosen]])
    if not keys:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT, region_bytes: int = REGION_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key (a hash of the text) and class, one row per row of `docs`.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a document's set are its distinct runs of
    `shingle` words, or all its words as one where it has fewer.  Two documents link when
    100 * intersection >= percent * union.  component_id is the smallest doc_id that can be reached over
    links, the document's own included.

    Nulls: a null text, or one without words, has an empty set and links with nothing, so its component is
    its own id; a null id takes part in links, but names a component only if all its ids are null.
    Repeated rows have equal sets and share a component.  Empty tables give no rows.  Texts are never cut.
    Sets are compared by 64 bit hashes of their members.
    """
    rows = carried(docs, id_col, text_col, False).withColumn("text_key", F.xxhash64("text"))

    def name(batches):
        for batch in slices(batches, "text"):
            _, first, names = shingle_sets(batch.column("text"), shingle)
            size = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(size), pa.array(names.view(np.int64), mask=size == 0)],
                names=["doc_id", "text_key", "n_shingles", "set"])

    named = stored(rows.mapInArrow(name, "doc_id long, text_key long, n_shingles long, set long"), "jaccard-sets")
    total = named.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(1, math.ceil(total * 2.4 * (100 - percent) / (100 + percent) / PART_KEYS))

    def keys(batches):
        for batch in slices(batches, "text"):
            members, first, names = shingle_sets(batch.column("text"), shingle)
            _, once = np.unique(names, return_index=True)
            keep = np.zeros(len(names), dtype=bool)
            keep[once] = True
            size = np.diff(first)
            members = members[np.repeat(keep, size)]
            key, owner = meeting_keys(members, np.concatenate([[0], np.cumsum(size[keep])]), percent)
            yield pa.RecordBatch.from_pydict(_packed_keys(key, owner, names[keep], parts), schema=_PACKED)

    def meet(table: pa.Table) -> pa.Table:
        key, node = _unpacked_keys(table)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.append([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[:len(key)]
        key, node = key[new], node[new]
        begin = np.flatnonzero(np.append([True], key[1:] != key[:-1])[:len(key)])
        size = np.diff(np.append(begin, len(key)))
        group = mix(np.add.reduceat(mix(node), begin) + size.astype(U64)) if len(key) else key
        _, once = np.unique(group, return_index=True)
        once = once[size[once] > 1]
        at = np.arange(size[once].sum()) + np.repeat(begin[once] - (np.cumsum(size[once]) - size[once]), size[once])
        return pa.table({"gid": np.repeat(group[once], size[once]).view(np.int64), "node": node[at].view(np.int64),
                         "leader": np.repeat(node[begin[once]], size[once]).view(np.int64)})

    met = rows.drop("text_key").mapInArrow(keys, "part int, top binary, low binary, node binary, names binary").groupBy("part").applyInArrow(
        meet, "gid long, node long, leader long")
    met = stored(met.distinct(), "jaccard-groups")
    regions = components(met.select(F.col("node").alias("a"), F.col("leader").alias("b")), "jaccard-regions")

    # Of each node one document that has it, by id and text, for many documents may have no id.
    one = named.filter("set IS NOT NULL").groupBy("set").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("of"), (8 * F.min("n_shingles")).alias("size"))
    nodes = stored(regions.join(one, F.col("node") == F.col("set")).select(
        "node", "of.doc_id", "of.text_key", "size", F.col("root").alias("region")), "jaccard-nodes")
    units = nodes.groupBy("region").agg(F.sum("size").alias("bytes")).select("region", _share("bytes", region_bytes, 3).alias("units"))
    met = met.join(nodes.select("node", "size", "region"), "node").join(units, "region")
    cuts = met.groupBy("gid").agg(F.sum("size").alias("bytes")).select("gid", _share("bytes", region_bytes, 2).alias("pieces"))
    met = stored(met.join(cuts, "gid"), "jaccard-members")

    def compare(groups: DataFrame) -> DataFrame:
        """(node, root) of the links within the groups (node, size, gid, unit); a unit is searched in one task."""
        groups = stored(groups, "jaccard-units")
        placed = groups.select("node", "unit", "size").distinct()
        bins = max(1, math.ceil(4 * (placed.agg(F.sum("size")).first()[0] or 0) / region_bytes))
        task = F.pmod(F.xxhash64("unit"), F.lit(bins)).alias("task")
        # The sets of the nodes, each from one document that has it, in every unit that has the node.
        wanted = placed.groupBy("node").agg(F.collect_list("unit").alias("units")).join(nodes.select("node", "doc_id", "text_key"), "node")
        wanted = rows.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "text").join(
            wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))).select("text", "node", "units")
        sets = wanted.mapInArrow(fetch, "members binary, node long, units array<long>").select("members", "node", F.explode("units").alias("unit"))
        links = sets.select(task, "unit", "node", "members").groupBy("task").cogroup(
            groups.select(task, "unit", "node", "gid").groupBy("task")).applyInArrow(link, "node long, root long")
        return components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "jaccard-links")

    def fetch(batches):
        for batch in slices(batches, "text"):
            members, first, names = shingle_sets(batch.column("text"), shingle)
            same = np.flatnonzero(names.view(np.int64) == batch.column("node").to_numpy())
            sets = pa.array([members[first[i]:first[i + 1]].tobytes() for i in same], pa.binary())
            at = pa.array(same)
            yield pa.RecordBatch.from_arrays([sets, *(batch.column(c).take(at) for c in ("node", "units"))], names=["members", "node", "units"])

    def link(sets: pa.Table, groups: pa.Table) -> pa.Table:
        return _linked_rows(sets, groups, percent)

    def own_unit(df: DataFrame, *key) -> DataFrame:
        name = F.xxhash64(*key)
        return df.select("node", "size", name.alias("gid"), name.alias("unit"))

    # First all groups that fit a task, and of larger ones each piece together with the group's smallest node.
    unit = F.xxhash64("region", F.pmod(F.xxhash64("leader"), F.col("units")))
    fitting = met.filter("pieces = 1").select("node", "size", "gid", unit.alias("unit"))
    cut = met.filter("pieces > 1").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")))
    every = cut.filter("node = leader").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces").cast("long") - 1)))
    links = compare(fitting.unionByName(own_unit(cut, "gid", "piece")).unionByName(own_unit(every, "gid", "piece")).distinct())
    if not cut.isEmpty():
        # Then the nodes that are not linked with the smallest one, the rest, against all pieces.  Two nodes that
        # are linked with it need no further comparison.
        root = links.select(F.col("node").alias("of"), "root")
        home = cut.select("gid", "leader").distinct().join(root, F.col("leader") == F.col("of"), "left").select(
            "gid", F.coalesce("root", "leader").alias("home"))
        marked = cut.join(root, F.col("node") == F.col("of"), "left").drop("of").join(home, "gid")
        marked = stored(marked.withColumn("rest", F.coalesce("root", "node") != F.col("home")), "jaccard-rest")
        parts_of = marked.filter("rest").groupBy("gid").agg(F.sum("size").alias("bytes")).select(
            "gid", _share("bytes", region_bytes, 2).cast("long").alias("parts"))
        marked = marked.join(parts_of, "gid")
        part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
        against = marked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        rest = marked.filter("rest").withColumn("part", part).withColumn(
            "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces").cast("long") - 1)))
        more = compare(own_unit(against, "gid", "piece", "part").unionByName(own_unit(rest, "gid", "piece", "part")).distinct())
        links = components(links.unionByName(more).select(F.col("node").alias("a"), F.col("root").alias("b")), "jaccard-all-links")

    classes = named.join(links, F.col("set") == F.col("node"), "left").select(
        "doc_id", "n_shingles", "text_key", F.coalesce("root", "set").alias("class"))
    least = classes.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least")).withColumnRenamed("class", "of")
    least = stored(least, "jaccard-least")  # so that the join below reads plain shuffles, which can be split at a large class
    return classes.join(least, F.col("class") == F.col("of"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        "text_key", "class")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
                region_bytes: int = REGION_BYTES) -> DataFrame:
    """The rows of `docs`, of each class of linked documents only the one with the smallest id (null last; then by
    a hash of the text, and of equal rows any).  Documents without words all stay.  See `ngram_jaccard_join`.
    """
    joined = stored(ngram_jaccard_join(docs, id_col, text_col, shingle, percent, region_bytes), "jaccard-classes")
    # The smallest row of a class is an aggregation with partial results, so a class may have any size.
    stay = joined.filter("class IS NOT NULL").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("least"))
    stay = stay.select("least.doc_id", "least.text_key", F.lit(False).alias("alone")).unionByName(
        joined.filter("class IS NULL").select("doc_id", "text_key", F.lit(True).alias("alone")).distinct())
    rows = carried(docs, id_col, text_col, True).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), "row")
    rows = rows.join(stay, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")))
    copy = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.lit(1)))
    return rows.withColumn("copy", copy).filter("copy = 1 OR alone").select("row.*")


_PACKED = pa.schema([("part", pa.int32()), *((name, pa.binary()) for name in ("top", "low", "node", "names"))])


def _packed_keys(key: np.ndarray, owner: np.ndarray, names: np.ndarray, parts: int) -> dict[str, list]:
    """A row per part: the sorted keys' upper 8 and lower 32 of 40 bits, and for each its node's place among the names."""
    part, key = part_of(key, parts), key & KEY_BITS
    order = np.lexsort((key, part))
    part, key, owner = part[order], key[order], owner[order]
    begins = np.flatnonzero(np.append([True], part[1:] != part[:-1])[:len(part)])
    rows: dict[str, list] = {name: [] for name in _PACKED.names}
    for i, j in zip(begins, np.append(begins[1:], len(part))):
        own, place = np.unique(owner[i:j], return_inverse=True)
        rows["part"].append(int(part[i]))
        rows["top"].append((key[i:j] >> U64(32)).astype(np.uint8).tobytes())
        rows["low"].append(key[i:j].astype(np.uint32).tobytes())
        rows["node"].append(place.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32).tobytes())
        rows["names"].append(names[own].tobytes())
    return rows


def _unpacked_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, nodes = [np.zeros(0, U64)], [np.zeros(0, U64)]
    for top, low, node, names in zip(*(table.column(c).to_pylist() for c in ("top", "low", "node", "names"))):
        keys.append(np.frombuffer(top, np.uint8).astype(U64) << U64(32) | np.frombuffer(low, np.uint32))
        place = np.frombuffer(node, np.uint16 if len(node) == 2 * len(top) else np.uint32)
        nodes.append(np.frombuffer(names, U64)[place])
    return np.concatenate(keys), np.concatenate(nodes)


def _share(column: str, most: int, times: int):
    """1 for a number up to `most`, and else in how many parts to cut it, each `times` below that bound."""
    return F.when(F.col(column) <= most, 1).otherwise(F.ceil(times * F.col(column) / most)).cast("int")


def _linked_rows(sets: pa.Table, groups: pa.Table, percent: int) -> pa.Table:
    """(node, root) of the links found in the units of a task: (unit, node, members) of sets, (unit, node, gid) of groups."""
    unit, node = sets.column("unit").to_numpy(), sets.column("node").to_numpy()
    order = np.lexsort((node, unit))
    new = np.append([True], (unit[order][1:] != unit[order][:-1]) | (node[order][1:] != node[order][:-1]))[:len(order)]
    order = order[new]  # a set comes twice where a document does
    unit, node = unit[order], node[order]
    members = sets.column("members").combine_chunks()
    in_group = np.lexsort((groups.column("node").to_numpy(), groups.column("gid").to_numpy(), groups.column("unit").to_numpy()))
    g_unit, g_node, gid = (groups.column(c).to_numpy()[in_group] for c in ("unit", "node", "gid"))
    found_node, found_root = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    begins = np.flatnonzero(np.append([True], unit[1:] != unit[:-1])[:len(unit)])
    for i, j in zip(begins, np.append(begins[1:], len(unit))):
        low, high = np.searchsorted(g_unit, [unit[i], unit[i] + 1]) if unit[i] < np.iinfo(np.int64).max else (
            np.searchsorted(g_unit, unit[i]), len(g_unit))
        place = np.searchsorted(node[i:j], g_node[low:high])
        there = (place < j - i) & (node[i:j][np.minimum(place, j - i - 1)] == g_node[low:high])
        place, of = place[there], gid[low:high][there]
        inside = np.split(place, np.flatnonzero(of[1:] != of[:-1]) + 1) if len(place) else []
        values = [np.frombuffer(members[int(x)].as_buffer(), dtype=np.uint64) for x in order[i:j]]
        first = np.concatenate([[0], np.cumsum([len(x) for x in values])])
        roots = linked(np.concatenate(values), first, percent, [np.unique(x) for x in inside])
        found_node.append(node[i:j])
        found_root.append(node[i:j][roots])
    return pa.table({"node": np.concatenate(found_node), "root": np.concatenate(found_root)})
