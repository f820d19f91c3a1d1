"""Texts whose sets of word n-grams overlap: a T-occurrence search on inverted lists.

Two sets of sizes a and b that are alike (Jaccard similarity of 0.85 or more, as the query
states it) share at least T = 0.85 a and 0.85 b of their members. Who occurs in at least T
of a set's inverted lists is found as in DivideSkip: the longest lists are put aside, the
others are merged by a heap that jumps over what cannot reach the rest of T, and what does
is looked up in the long lists by binary search. A passage that many texts share makes long
lists; these are only looked up, so unlike texts that have it in common are never paired.

So that a search stays inside one task, Spark brings together what can meet:

1. The first hashes of a set are looked at, 0.15 a and k = 0.05 a more. Alike sets share k of
   these, the smaller k of the two; a set of whose first hashes fewer occur elsewhere goes.
2. For the others, lists are counted over all. Ordered by that, the first 0.15 a + 1 lists
   of a set are its short ones, and alike sets share a short list. Sets that are connected
   by short lists are a cluster; clusters are searched each for itself.
3. A large cluster is dealt into blocks, all of which also get two sets of the cluster to
   meet at. Sets that are then not in the cluster's largest component are searched for in
   every other block with which they share a short list. Any two sets that are in
   different components have been compared by that.

Equal sets are one node. A search leaves out whatever is in a component it has already met.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.llm.common import carried, discard, offsets, settle, sifted, utf8
from visitfold.llm.components import components
from visitfold.llm.simhash import shingle_hashes

# What the query states.
SHINGLE_WORDS = 4
SIMILAR_PERCENT = 85

#: Shared shingles of the sets that a task searches at a time.
BLOCK_SHINGLES = 300_000
# Weight of a look-up against a heap step, which decides how many lists are put aside.
LOOK_UP = 0.0085


def shingle_set(text: bytes, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of a text's lower-cased shingles, in order."""
    return np.unique(shingle_hashes(text, shingle))


def set_node(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.astype("<u8").tobytes())


def least_shared(size: int | np.ndarray) -> int | np.ndarray:
    """How many members a set of that size shares with any alike one, at least."""
    return (SIMILAR_PERCENT * size + 99) // 100


def also_shared(size: int | np.ndarray) -> int | np.ndarray:
    """How many of their first hashes two alike sets of at least that size share."""
    return 1 + size // 20


def alike(one: int, two: int, shared: int) -> bool:
    return (100 + SIMILAR_PERCENT) * shared >= SIMILAR_PERCENT * (one + two)


def _sets(rows: DataFrame, shingle: int, whole: bool) -> DataFrame:
    """doc, key, node, size and the first hashes of every set, or all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text")
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                held = [shingle_set(raw[i].as_py(), shingle) for i in range(a, a + part.num_rows)]
                firsts = [len(one) - least_shared(len(one)) + also_shared(len(one)) for one in held]
                taken = held if whole else [one[:count] for one, count in zip(held, firsts)]
                ends = offsets(np.fromiter(map(len, taken), np.int64, len(taken)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        part.column("key"),
                        pa.array(np.array([set_node(one) for one in held], np.uint64).view(np.int64)),
                        pa.array(np.fromiter(map(len, held), np.int64, len(held))),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(np.concatenate(taken).view(np.int64))
                        ),
                    ],
                    names=["doc", "key", "node", "size", "shingles"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc {kind}, key long, node long, size long, shingles array<long>")


# ---- search in a task ---------------------------------------------------------


def occurrences(
    lists: list[list[int]], least: int, wanted: Callable[[int], bool] = lambda _: True
) -> Iterator[tuple[int, int]]:
    """Who is wanted and is in at least so many of the lists, which ascend, and in how many."""
    if len(lists) < least:
        return
    lists = sorted(lists, key=len)
    aside = min(least - 1, int(least / (LOOK_UP * log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    among_short = least - aside
    heap = [(one[0], k, 0) for k, one in enumerate(short)]
    heapify(heap)
    while len(heap) >= among_short:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap))
        if len(popped) >= among_short:
            if wanted(top):
                found = len(popped)
                for one in long:
                    at = bisect_left(one, top)
                    found += at < len(one) and one[at] == top
                if found >= least:
                    yield top, found
            onward = top + 1
        else:
            while heap and len(popped) < among_short - 1:
                popped.append(heappop(heap))
            if not heap:
                return
            onward = heap[0][0]
        for _, k, at in popped:
            at = bisect_left(short[k], onward, at)
            if at < len(short[k]):
                heappush(heap, (short[k][at], k, at))


class Lists:
    """Inverted lists of numbered sets."""

    def __init__(self) -> None:
        self.of: dict[int, list[int]] = {}
        self.held: set[int] = set()

    def add(self, number: int, members: list[int]) -> None:
        self.held.add(number)
        for member in members:
            insort(self.of.setdefault(member, []), number)

    def drop(self, number: int, members: list[int]) -> None:
        self.held.discard(number)
        for member in members:
            one = self.of[member]
            del one[bisect_left(one, number)]
            if not one:
                del self.of[member]

    def search(
        self, members: list[int], least: int, wanted: Callable[[int], bool]
    ) -> Iterator[tuple[int, int]]:
        """Sets that share at least so many of the members, and how many."""
        return occurrences([self.of[one] for one in members if one in self.of], least, wanted)


def connect(sizes: list[int], sets: list[list[int]]) -> list[tuple[int, int]]:
    """Links between alike sets that keep all components of them.

    Sets of the largest component have lists of their own: one hit in there is enough.
    """
    root = list(range(len(sets)))
    parts = [[one] for one in root]
    main, rest = Lists(), Lists()
    links = []
    for one, members in enumerate(sets):
        met: dict[int, int] = {}
        for lists in (main, rest):
            for other, shared in lists.search(members, least_shared(sizes[one]), lambda at: root[at] not in met):
                if alike(sizes[one], sizes[other], shared):
                    met[root[other]] = other
                    if lists is main:
                        break
        links += [(one, other) for other in met.values()]
        into = max(met, key=lambda at: len(parts[at]), default=one)
        for old in {*met, one} - {into}:
            for moved in parts[old]:
                root[moved] = into
            parts[into] += parts[old]
            parts[old] = []
        # the first component, or one that has become twice as large, gets the lists of its own
        in_main = bool(main.held) and root[next(iter(main.held))] == into
        if not in_main and len(parts[into]) > 2 * len(main.held):
            for moved in list(main.held):
                main.drop(moved, sets[moved])
                rest.add(moved, sets[moved])
            in_main = True
        for moved in parts[into]:
            if in_main and moved not in main.held:
                if moved in rest.held:
                    rest.drop(moved, sets[moved])
                main.add(moved, sets[moved])
        if not in_main:
            rest.add(one, members)
    return links


def look_up(
    sizes: list[int], sets: list[list[int]], part: list[int], asked: list[bool], main: int
) -> list[tuple[int, int]]:
    """Links between sets that are asked for and others of another part; ``main`` is the largest part."""
    held = {True: Lists(), False: Lists()}
    for one, members in enumerate(sets):
        if not asked[one]:
            held[part[one] == main].add(one, members)
    links = []
    for one, members in enumerate(sets):
        if asked[one]:
            met = {part[one]}
            for is_main, lists in held.items():
                for other, shared in lists.search(members, least_shared(sizes[one]), lambda at: part[at] not in met):
                    if alike(sizes[one], sizes[other], shared):
                        met.add(part[other])
                        links.append((one, other))
                        if is_main:
                            break
    return links


def _searched(rows: DataFrame, found: Callable[[dict[str, list]], list[tuple[int, int]]]) -> DataFrame:
    """Links a, b that ``found`` makes of all rows of one cluster and block, task by task."""
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple[int, int] | None = None
        held: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).to_pydict()
            links = found(table)
            if links:
                node = np.array(table["node"], np.int64)
                pairs = np.array(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], names=["a", "b"]
                )

        for batch in batches:
            where = np.column_stack([np.asarray(batch.column(name)) for name in ("cluster", "block")])
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if b > a:
                    now = (int(where[a, 0]), int(where[a, 1]))
                    if held and now != group:
                        yield from close()
                        held = []
                    group = now
                    held.append(batch.slice(a, b - a))
        if held:
            yield from close()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "cluster", "block").sortWithinPartitions("cluster", "block", "node")
    return dealt.select(*names).mapInArrow(work, "a long, b long")


# ---- clusters -----------------------------------------------------------------


def _ranked(slim: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """node, size, lists: sets that may have partners, with the shingles they share, rare ones first."""
    prefix = rows.where("size > 0").select("node", F.explode("shingles").alias("shingle"))
    several = prefix.groupBy("shingle").agg((F.min("node") < F.max("node")).alias("several")).where("several")
    several = settle(several.select("shingle"), "shared")  # a table, so that a join splits a hot one
    hits = prefix.join(several, "shingle", "left_semi").groupBy("node").agg(F.count("*").alias("hits"))
    copies = rows.groupBy("node").agg(
        F.max("size").alias("size"), F.count("*").alias("copies"), F.min("key").alias("key")
    )
    # a partner is at least as large as what is shared; each copy of a set has made its hits
    smaller = F.expr(f"(size * {SIMILAR_PERCENT} + 99) div 100")
    enough = F.col("hits") >= (1 + F.floor(smaller / 20)) * F.col("copies")
    keys = settle(hits.join(copies, "node").where(enough).select("key"), "keys")
    # not a semi-join, which would be moved below the sieve
    texts = sifted(slim, keys, ["key"]).join(keys, "key").dropDuplicates(["key"])
    empty = F.struct(F.lit(0).alias("none")).alias("doc")
    sets = settle(_sets(texts.select(empty, "key", "text"), shingle, True).select("node", "size", "shingles"), "sets")
    discard(several, keys)
    each = sets.select("node", "size", F.explode("shingles").alias("shingle"))
    counts = settle(each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    lists = F.array_sort(F.collect_list(F.struct("n", "shingle")))
    ranked = each.join(counts, "shingle").groupBy("node", "size").agg(lists.alias("lists"))
    enough = 100 * F.size("lists") >= SIMILAR_PERCENT * F.col("size")
    ranked = settle(ranked.where(enough).select("node", "size", F.col("lists.shingle").alias("lists")), "ranked")
    discard(sets, counts)
    return ranked


def _short_lists(ranked: DataFrame, *also: str) -> DataFrame:
    """node, shingle: of each set the short lists."""
    need = F.expr(f"cast((size * {SIMILAR_PERCENT} + 99) div 100 as int)")
    short = F.slice("lists", F.lit(1), F.size("lists") - need + 1)
    return ranked.select("node", *also, F.explode(short).alias("shingle"))


def links(slim: DataFrame, rows: DataFrame, shingle: int, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links a, b between alike sets that keep all components of them."""
    ranked = _ranked(slim, rows, shingle)
    short = settle(_short_lists(ranked), "short")
    first = settle(short.groupBy("shingle").agg(F.min("node").alias("first"), F.max("node").alias("last")), "first")
    stars = short.join(first.where("first < last"), "shingle").select(F.col("node").alias("a"), F.col("first").alias("b"))
    clusters = components(stars).select("node", F.col("root").alias("cluster"))
    placed = settle(ranked.join(clusters, "node"), "placed")
    discard(short, first, ranked)
    ends = F.struct(F.xxhash64("node").alias("h"), "node")
    sizes = placed.groupBy("cluster").agg(
        F.ceil(F.sum(F.size("lists")) / block_shingles).cast("int").alias("blocks"),
        F.min(ends)["node"].alias("one"),
        F.max(ends)["node"].alias("two"),
    )
    sized = placed.join(settle(sizes, "clusters"), "cluster")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    meets = F.col("node").isin(F.col("one"), F.col("two"))
    places = F.when(meets, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = sized.select("cluster", "node", "size", "lists", "blocks", F.explode(places).alias("block"))
    dealt = settle(dealt, "dealt")
    discard(placed)
    near = settle(_searched(dealt, lambda rows: connect(rows["size"], rows["lists"])), "links")
    across = _across(dealt.where("blocks > 1"), near)
    return near if across is None else near.unionByName(across)


def _across(dealt: DataFrame, near: DataFrame) -> DataFrame | None:
    """Links between blocks of the same cluster, for sets outside of its largest component."""
    if dealt.isEmpty():
        return None
    parts = settle(components(near).select("node", F.col("root").alias("part")), "parts")
    dealt = dealt.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    dealt = settle(dealt, "dealt")
    count = dealt.select("cluster", "node", "part").distinct().groupBy("cluster", "part").agg(F.count("*").alias("n"))
    main = settle(count.groupBy("cluster").agg(F.max_by("part", F.struct("n", "part")).alias("main")), "main")
    dealt = dealt.join(main, "cluster").withColumn("asked", F.lit(False))
    minor = settle(dealt.where("part <> main").dropDuplicates(["node"]), "minor")
    if minor.isEmpty():
        return None
    there = settle(_short_lists(dealt, "cluster", "block").drop("node").distinct(), "there")
    asks = _short_lists(minor, "cluster", F.col("block").alias("home"))
    asks = asks.join(there, ["cluster", "shingle"]).where("block <> home").select("node", "block").distinct()
    asked = minor.drop("block", "asked").join(settle(asks, "asks"), "node").withColumn("asked", F.lit(True))
    rows = dealt.unionByName(asked)

    def found(rows: dict[str, list]) -> list[tuple[int, int]]:
        return look_up(rows["size"], rows["lists"], rows["part"], rows["asked"], rows["main"][0])

    return settle(_searched(rows, found), "across")


def similar_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    columns: list[str] | None = None,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Every row as ``doc`` with n_shingles, group and component_id.

    ``doc`` has all columns but the text, or those given, the id among them. A text's set are
    its distinct lower-cased shingles; a shorter one is a single shingle. Texts are linked if
    their sets have a Jaccard similarity of 0.85 or more, told apart by 64-bit hashes;
    ``group`` names what is linked and component_id is the smallest doc_id in it. Null, empty
    and blank texts have an empty set, no group, and their own id as component_id. A null
    doc_id does not count, and a group without ids has a null one. Repeated rows are kept; an
    empty table gives no rows.
    """
    names = columns or [name for name in docs.columns if name != text]
    key = F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"])
    slim = docs.select(
        carried(docs, names, text, doc_id).alias("doc"), key.alias("key"), utf8(docs[f"`{text}`"]).alias("text")
    )
    rows = settle(_sets(slim, shingle, False), "sets")
    group = components(links(slim.drop("doc"), rows.drop("doc"), shingle, block_shingles))
    group = settle(group.select("node", F.col("root").alias("group")), "groups")
    number = F.col(f"doc.`{doc_id}`")
    nodes = rows.where("size > 0").groupBy("node").agg(F.min(number).alias("first"))
    nodes = nodes.join(group, "node", "left").withColumn("group", F.coalesce("group", "node"))
    nodes = settle(nodes, "rooted")
    smallest = settle(nodes.groupBy("group").agg(F.min("first").alias("component_id")), "smallest")
    named = settle(nodes.join(smallest, "group").select("node", "group", "component_id"), "components")
    whole = rows.select("doc", F.when(F.col("size") > 0, F.col("node")).alias("node"), F.col("size").alias("n_shingles"))
    return whole.join(named, "node", "left").select(
        "doc",
        "n_shingles",
        "group",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(number).alias("component_id"),
    )
