"""N-gram Jaccard join: near duplicates as components of links, by tries over globally ordered shingle sets.

A document's set is its distinct shingles of n words as 64-bit hashes, ordered by hash, the same global order for all
sets. Two sets link when 100 * intersection >= p * union. ``Likeness`` holds n and p: 4 and 85 by the contract of the query
(``CONTRACT``), 5 and 80 where no contract says otherwise (``USUAL``). Equal sets are one node from the start.

Prefixes. A set is a path of a trie in the global order. A set of s shingles shares at least a = ceil(p s / 100) of them with any set
it links to, so the first s - a + t shingles of two linked paths have t in common (``spare``: t is one and a sixteenth of the
smaller set). A node is entered under the shingles of its prefix; nodes meet under them as
prefixes of tries that share a branch. A node that meets others under fewer shingles than it must share links with nothing and goes.
Of the others each leaves out the t - 1 shingles that most nodes meet under: of the t that two linked sets share, the rarest is
left out by neither. Passages that many documents hold make no candidates this way, unless they are a large part of a set.

Links. Every shard (the nodes of a shingle) has a pivot, the node that shares the most shards; the family of a pivot is every node of its shards,
so two sets that link are together in some family. A family's sets form a trie of ``STEP`` shingles a level. The pivot
walks it first, then every set that is not yet in one component with all others: the overlap of a shared path is counted
once, and a subtree ends when the overlap so far plus the remaining length of either side cannot reach the required one.
Only links that connect something new are returned, so no pairs are listed; a large group of near copies costs its size
where the pivot links to them, and no rows in any case. Families of more than ``GROUP_SHINGLES`` shingles are cut in blocks,
which all have the pivot; what is then outside the pivot's component meets the other blocks too.

What is sent. Inside an Arrow batch the nodes of a shingle find each other before the shuffle, and only one of them meets other
batches under it. Prefixes are sent packed, a row a bucket and batch. Sets are read from the documents again for the nodes that
are in a family (a bitmap of fixed size, ``SLOTS`` bits, keeps the others from being sent; a fuller one only sends more). Scratch tables are
dropped as soon as they have been used.

Cases: null and empty texts have an empty set and link with nothing; a text of fewer words than a shingle is one shingle.
Rows that repeat a doc_id and set are one row; with different sets they are rows of their own, each with its component. A
null doc_id takes part and has the smallest id of its component, null if there is none. Other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import drop_stored, free_name, map_batches, stored
from tidemark.llm.components import components
from tidemark.llm.words import SPACED, Words, each_piece, grams, mix, signed

WHOLE = 100
STEP = 64
SLOTS = 1 << 22
GROUP_SHINGLES = 2_000_000
SPARE = 16
PREFIX_KEYS = 1 << 19  # of an Arrow batch that are sorted at once


class Likeness(NamedTuple):
    """When two sets link: words of a shingle, and the least intersection in hundredths of the union."""

    shingle: int
    part: int

    def least(self, size):
        """Least overlap of a set of ``size`` shingles with any set it links to."""
        return -(-self.part * size // WHOLE)


CONTRACT, USUAL = Likeness(4, 85), Likeness(5, 80)


def shingle_sets(words: Words, like: Likeness = CONTRACT) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ordered by text and hash, and the bounds of each text."""
    value, at = grams(words, like.shingle)
    text = words.text[at].astype(np.int64)
    count = np.diff(words.first)
    for n in range(1, like.shingle):
        short = np.flatnonzero(count == n)
        if len(short):
            own, where = grams(words, n)
            mine = np.isin(words.text[where], short)
            value = np.concatenate((value, mix(own[mine] ^ np.uint64(n))))
            text = np.concatenate((text, words.text[where[mine]]))
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    if len(value):
        fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])))
        value, text = value[fresh], text[fresh]
    return value, np.searchsorted(text, np.arange(len(count) + 1))


def nodes_of(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty one."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(0x5851F42D4C957F2D)))))
    size = np.diff(first)
    return np.where(size > 0, mix((total[first[1:]] - total[first[:-1]]) ^ size.astype(np.uint64)), np.uint64(0))


def spare(size):
    """How many shingles the prefixes of two linked sets share, the smaller of ``size`` shingles."""
    return 1 + size // SPARE


def prefixes(value: np.ndarray, first: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the texts' prefixes and the text of each."""
    size = np.diff(first)
    length = np.minimum(size, size - like.least(size) + spare(size))
    text = np.repeat(np.arange(len(size)), length)
    return value[first[text] + np.arange(len(text)) - (np.cumsum(length) - length)[text]], text


def document_sets(documents: DataFrame, like: Likeness = CONTRACT, keyed: bool = False) -> DataFrame:
    """doc_id, n_shingles and node of each document, and where ``keyed`` text_key, a hash of the text."""
    keys = ["text_key"] if keyed else []

    def work(batch: pa.RecordBatch):
        for low, high, words in each_piece(batch.column(1), SPACED):
            value, first = shingle_sets(words, like)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.array(np.diff(first)), pa.array(signed(nodes_of(value, first))),
                 *(batch.column(k).slice(low, high - low) for k in keys)], ["doc_id", "n_shingles", "node", *keys])

    source = documents.select("doc_id", "text", *(F.xxhash64("text").alias(k) for k in keys))
    return map_batches(source, work, ", ".join([f"doc_id {dict(source.dtypes)['doc_id']}, n_shingles long, node long", *(f"{k} long" for k in keys)]))


_PACKED = "bucket int, mates boolean, keys binary, at binary, nodes binary, counts binary"


def prefix_rows(documents: DataFrame, like: Likeness, buckets: int) -> DataFrame:
    """Prefixes, packed: of each shingle of a batch one node and the number of its nodes there, dealt by the shingle; the other
    nodes (``mates``) dealt by themselves, since they need to meet no more."""
    def packed(key: np.ndarray, node: np.ndarray, count: np.ndarray, bucket: np.ndarray, mates: bool):
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            here = order[cuts[b]:cuts[b + 1]]
            nodes, at = np.unique(node[here], return_inverse=True)
            yield (int(b), mates, key[here].tobytes(), at.astype(np.uint16 if len(nodes) <= 1 << 16 else np.uint32).tobytes(),
                   nodes.tobytes(), count[here].astype(np.uint32).tobytes())

    def work(batch: pa.RecordBatch):
        keys, nodes = [], []
        for _, _, words in each_piece(batch.column(0), SPACED):
            value, first = shingle_sets(words, like)
            key, text = prefixes(value, first, like)
            keys.append(key)
            nodes.append(nodes_of(value, first)[text])
            if sum(map(len, keys)) >= PREFIX_KEYS:
                yield from sent(np.concatenate(keys), np.concatenate(nodes))
                keys, nodes = [], []
        if any(map(len, keys)):
            yield from sent(np.concatenate(keys), np.concatenate(nodes))

    def sent(key: np.ndarray, node: np.ndarray):
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node = key[fresh], node[fresh]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.concatenate((head, [len(key)])))
        mate = np.ones(len(key), dtype=bool)
        mate[head] = False
        rows = [*packed(key[head], node[head], count, (key[head] % np.uint64(buckets)).astype(np.int64), False),
                *packed(key[mate], node[mate], np.zeros(int(mate.sum())), (mix(node[mate]) % np.uint64(buckets)).astype(np.int64), True)]
        bucket, mates, *data = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), pa.array(mates), *(pa.array(column, pa.binary()) for column in data)],
            [field.split()[0] for field in _PACKED.split(", ")])

    return map_batches(documents.select("text"), work, _PACKED)


def _meet(table: pa.Table) -> pa.Table:
    """key and node of the shingles of a bucket that several nodes have, with their number, and of mates, without."""
    out: dict[bool, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {False: [], True: []}
    for row in table.to_pylist():
        keys = np.frombuffer(row["keys"], dtype=np.uint64)
        at = np.frombuffer(row["at"], dtype=np.uint16 if len(row["at"]) == 2 * len(keys) else np.uint32)
        out[row["mates"]].append((keys, np.frombuffer(row["nodes"], dtype=np.uint64)[at], np.frombuffer(row["counts"], dtype=np.uint32)))
    tables = []
    if out[True]:
        key, node, _ = map(np.concatenate, zip(*out[True]))
        tables.append(pa.table({"key": signed(key), "node": signed(node), "size": pa.nulls(len(key), pa.int64())}))
    if out[False]:
        key, node, count = map(np.concatenate, zip(*out[False]))
        order = np.lexsort((-count.astype(np.int64), node, key))
        key, node, count = key[order], node[order], count[order]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node, count = key[fresh], node[fresh], count[fresh].astype(np.int64)
        head = np.concatenate(([True], key[1:] != key[:-1]))
        size = np.add.reduceat(count, np.flatnonzero(head))[np.cumsum(head) - 1]
        several = size > 1
        tables.append(pa.table({"key": signed(key[several]), "node": signed(node[several]), "size": size[several]}))
    return pa.concat_tables(tables)


def candidates(documents: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """key and node: the shingles that nodes which may link with others meet under."""
    spark = documents.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = stored(prefix_rows(documents, like, buckets).groupBy("bucket").applyInArrow(_meet, "key long, node long, size long"), "jaccard_members")
    sizes = members.filter("size IS NOT NULL").select("key", "size").distinct()
    held = (members.select("key", "node").distinct().join(sizes, "key").groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("size", "key")), asc=False).alias("keys")))
    least = F.expr(f"int(1 + ceil({like.part} * n_shingles / {WHOLE}) div {SPARE})")
    rare = (held.join(nodes.select("node", "n_shingles"), "node").withColumn("least", least).filter(F.size("keys") >= F.col("least"))
            .select("node", F.explode(F.slice("keys", F.col("least"), F.size("keys"))).alias("key")).select("key.key", "node"))
    found = stored(rare, "jaccard_rare")
    drop_stored(members)
    return found


def sets_for(documents: DataFrame, needed: DataFrame, like: Likeness) -> DataFrame:
    """node and set (bytes of ordered hashes) of the ``needed`` nodes, each once."""
    slots = needed.select(F.expr(f"int(node & {SLOTS - 1})").alias("slot")).distinct().toArrow()["slot"].to_numpy()
    bits = np.zeros(SLOTS // 8, dtype=np.uint8)
    np.bitwise_or.at(bits, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def work(batch: pa.RecordBatch):
        for _, _, words in each_piece(batch.column(0), SPACED):
            value, first = shingle_sets(words, like)
            node = nodes_of(value, first)
            slot = (node & np.uint64(SLOTS - 1)).astype(np.int64)
            kept = np.flatnonzero(((shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1) & (np.diff(first) > 0))
            _, once = np.unique(node[kept], return_index=True)
            kept = kept[once]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(node[kept])), pa.array([value[first[i]:first[i + 1]].tobytes() for i in kept], pa.binary())],
                ["node", "set"])

    found = map_batches(documents.select("text"), work, "node long, set binary")
    return found.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"])


class Trie:
    """Ordered sets as a trie, ``STEP`` shingles a level; equal paths are one node, met once by a probe."""

    def __init__(self, sets: list[np.ndarray], part: int):
        self.part = part
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        # ids in the order of the hashes
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.width = flat.astype(np.int32), len(names)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        path = np.zeros(len(sets), dtype=np.uint64)
        here, depth = np.arange(len(sets)), 0
        while len(here):
            count = np.minimum(self.size[here] - depth, STEP)
            bounds = np.concatenate(([0], np.cumsum(count)[:-1]))
            where = np.repeat(self.start[here] + depth - bounds, count) + np.arange(count.sum())
            edge = np.add.reduceat(mix(self.flat[where].astype(np.uint64) + np.uint64(1)), bounds)
            path[here] = mix(path[here] ^ mix(edge ^ count.astype(np.uint64)))
            _, rep, node = np.unique(path[here], return_index=True, return_inverse=True)
            of = np.full(len(sets), -1, dtype=np.int64)
            of[here] = node
            self.levels.append((here[rep], of, count[rep]))
            depth += STEP
            here = here[self.size[here] > depth]

    def linked_with(self, probe: int, among: np.ndarray) -> np.ndarray:
        """Which of the sets ``among`` link with the set ``probe``."""
        mine = self.flat[self.start[probe]:self.start[probe] + self.size[probe]]
        flag = np.zeros(self.width, dtype=bool)
        flag[mine] = True
        need = -(-self.part * (self.size + self.size[probe]) // (self.part + WHOLE))
        alive = among[np.minimum(self.size[among], self.size[probe]) >= need[among]]
        overlap = np.zeros(len(self.size), dtype=np.int64)
        found = []
        for depth, (rep, of, count) in enumerate(self.levels):
            if not len(alive):
                break
            asked, back = np.unique(of[alive], return_inverse=True)
            width = count[asked]
            bounds = np.concatenate(([0], np.cumsum(width)[:-1]))
            where = np.repeat(self.start[rep[asked]] + depth * STEP - bounds, width) + np.arange(width.sum())
            hits = np.add.reduceat(flag[self.flat[where]].astype(np.int64), bounds)
            overlap[alive] += hits[back]
            reached = np.minimum(self.size[alive], (depth + 1) * STEP)
            left = self.size[alive] - reached
            # what the probe has beyond the last shingle of the path
            beyond = len(mine) - np.searchsorted(mine, self.flat[self.start[alive] + reached - 1], side="right")
            done = left == 0
            found.append(alive[done & (overlap[alive] >= need[alive])])
            alive = alive[~done & (overlap[alive] + np.minimum(left, beyond) >= need[alive])]
        return np.concatenate(found) if found else alive


def family_links(sets: list[np.ndarray], lead: int, asking: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Links of a family of sets: of all with ``lead``, then of each ``asking`` set that is in another component than
    some sets, with those. Enough links to connect what is connected by sets that ask."""
    trie = Trie(sets, least)
    part = np.arange(len(sets))
    out = []

    def join(one: int, others: np.ndarray) -> None:
        for other in others:
            if part[other] != part[one]:
                out.append((one, int(other)))
                part[part == part[other]] = part[one]

    order = [lead, *[int(i) for i in asking if i != lead]]
    everyone = np.arange(len(sets))
    for one in order:
        rest = everyone[part != part[one]]
        if len(rest):
            join(one, trie.linked_with(one, rest))
    return out


_LINKS = "a long, b long"


def _no_links() -> pa.Table:
    return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def _compare(table: pa.Table, least: int) -> pa.Table:
    """Links within the families of a bucket; each family (pivot, block) has its own trie."""
    if not table.num_rows:
        return _no_links()
    pivot, block, node, asks = (table[c].to_numpy(zero_copy_only=False) for c in ("pivot", "block", "node", "asks"))
    data = table["set"]
    order = np.lexsort((node, block, pivot))
    pivot, block, node, asks = pivot[order], block[order], node[order], asks[order]
    cuts = [0, *(np.flatnonzero((pivot[1:] != pivot[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(order)]
    out = []
    for low, high in zip(cuts, cuts[1:]):
        if high - low > 1:
            sets = [np.frombuffer(data[int(i)].as_py(), dtype=np.uint64) for i in order[low:high]]
            lead = np.flatnonzero(node[low:high] == pivot[low])
            asking = np.flatnonzero(asks[low:high])
            first = int(lead[0]) if len(lead) else int(asking[0]) if len(asking) else 0
            out += [(int(node[low + i]), int(node[low + j])) for i, j in family_links(sets, first, asking, least)]
    if not out:
        return _no_links()
    found = np.array(out, dtype=np.int64)
    return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})


def compared(rows: DataFrame, sets: DataFrame, shingles: int, least: int) -> DataFrame:
    """Links within each (pivot, block) of ``rows`` (pivot, block, node, asks), dealt into buckets of bounded size."""
    buckets = int(shingles // GROUP_SHINGLES) + 1
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("pivot", "block"), F.lit(buckets)))

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, least)

    return (dealt.join(sets, "node").select("bucket", "pivot", "block", "node", "asks", "set")
            .groupBy("bucket").applyInArrow(compare, _LINKS))


def families(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """pivot, node, n_shingles and block of the families of several nodes: every node with the pivots of its shards; a pivot
    is in its own family.

    A shard's pivot is its node that meets others in the most shards: in a group of near copies the one they were made
    from, to which most of the others link.
    """
    busy = members.groupBy("node").agg(F.count("*").alias("shards"))
    pivots = (members.join(busy, "node").groupBy("key").agg(F.max_by("node", F.struct("shards", "node")).alias("pivot"), F.count("*").alias("n"))
              .filter("n > 1").select("key", "pivot"))
    pairs = members.join(pivots, "key").select("pivot", "node").distinct()
    pairs = pairs.join(nodes.select("node", "n_shingles"), "node").select("pivot", "node", "n_shingles")
    blocks = pairs.groupBy("pivot").agg(F.ceil(F.sum("n_shingles") / GROUP_SHINGLES).alias("blocks"))
    return pairs.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")))


def links(documents: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """Links (a, b) between nodes, enough to connect every component."""
    members = candidates(documents, nodes, like)
    dealt = stored(families(members, nodes), "jaccard_families")
    drop_stored(members)
    total, large = dealt.agg(F.sum("n_shingles"), F.max("blocks")).first()
    needed = dealt.select("node").distinct()
    # every block has the pivot; within a block all are compared that the pivot leaves apart
    leads = (dealt.filter("node = pivot AND blocks > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("pivot", F.col("block").cast("long").alias("block"), "node"))
    inside = dealt.select("pivot", "block", "node").union(leads).distinct().withColumn("asks", F.lit(True))
    found = stored(compared(inside, sets_for(documents, needed, like), total or 0, like.part), "jaccard_links")
    if not large or large == 1:
        drop_stored(dealt)
        return found
    # families of several blocks: what is not in the pivot's component meets the other blocks too
    labels = components(found)
    several = dealt.filter("blocks > 1").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    main = several.filter("node = pivot").select("pivot", F.col("label").alias("main"))
    several = several.join(main, "pivot")
    asking = several.filter("label <> main").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = lambda x, y: F.xxhash64(F.least(x, y), F.greatest(x, y))
    side = asking.filter("other <> block").select("pivot", pair(F.col("block"), F.col("other").cast("long")).alias("block"), "node", F.lit(True).alias("asks"))
    open_blocks = asking.groupBy("pivot", F.col("block").alias("from")).agg(F.count("*"))
    met = (several.join(open_blocks.select("pivot", "from"), "pivot").filter("from <> block")
           .select("pivot", pair(F.col("block"), F.col("from")).alias("block"), "node", F.lit(False).alias("asks")))
    across = side.union(met).groupBy("pivot", "block", "node").agg(F.max("asks").alias("asks"))
    sets = sets_for(documents, dealt.filter("blocks > 1").select("node").distinct(), like)
    all_links = stored(found.union(compared(across, sets, total, like.part)), "jaccard_all_links")
    drop_stored(dealt, found)
    return all_links


def component_labels(documents: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """node, label (of its component) and first_id (its smallest doc_id) of each set with words."""
    nodes = sets.filter("n_shingles > 0").groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.min("doc_id").alias("first_id"))
    nodes = stored(nodes, "jaccard_nodes")
    found = links(documents, nodes, like)
    labels = components(found)
    drop_stored(found)
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "first_id")


def near_duplicates(documents: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """doc_id, n_shingles and component_id of each document."""
    sets = stored(document_sets(documents, like), "jaccard_documents")
    placed = component_labels(documents, sets, like)
    least = placed.groupBy("label").agg(F.min("first_id").alias("component_id"))
    known = placed.join(least, "label").select("node", "component_id")
    return (sets.distinct().join(known, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(documents: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """One row of each component: of its smallest doc_id, and of that the smallest set. Rows without words stay, one of
    each doc_id and text."""
    sets = stored(document_sets(documents, like, True), "jaccard_documents")
    labels = component_labels(documents, sets, like)
    # a set without words is a component of its own
    placed = (sets.join(labels.select("node", "label"), "node", "left")
              .withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node")))
              .withColumn("own", F.when(F.col("n_shingles") == 0, F.xxhash64("doc_id", "text_key"))))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "text_key"))
    winners = placed.groupBy("label", "own").agg(first.alias("first")).select("first.doc_id", "first.text_key")
    repeated = sets.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"))
    kept = stored(_same(winners, repeated, "inner").select("doc_id", "text_key", "copies"), "jaccard_kept")
    key = free_name(documents, "_text_key")
    rows = documents.withColumn(key, F.xxhash64("text"))
    once = _same(rows, kept.filter("copies = 1"), "left_semi", key)
    several = _same(rows, kept.filter("copies > 1"), "left_semi", key).dropDuplicates(["doc_id", key])
    return once.unionByName(several).select(*[F.col(f"`{c}`") for c in documents.columns])


def _same(rows: DataFrame, others: DataFrame, how: str, key: str = "text_key") -> DataFrame:
    """Join on doc_id, null equal to null, and the hash of the text."""
    id_name, key_name = free_name(rows, "_other_id"), free_name(rows, "_other_key")
    others = others.withColumnsRenamed({"doc_id": id_name, "text_key": key_name})
    return rows.join(others, rows["doc_id"].eqNullSafe(others[id_name]) & (rows[key] == others[key_name]), how)


def op9_jaccard(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents, CONTRACT)
