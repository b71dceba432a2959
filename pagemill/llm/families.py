"""Candidate pairs from signature lists without emitting all pairs of a family of copies.

Rows of an index are (signature, node, n): a node of set size n carries a signature. The nodes of a list are
ordered by size and paired with the first and with the one before, a number of pairs in proportion to the list.
What these links leave in different components is then compared in full: as pairs in lists of up to SMALL nodes, whose
number stays in proportion to the rows, and as blocks of bounded size in larger lists. A task compares two blocks and
returns only links that join components, so no task holds a whole family and no pairs of a family become rows.

Both comparisons begin with sketches, about one bit for each token: the parities of a set's tokens over a power of two of
places. Where two parities differ, the sets differ in a token, so pairs with too many such places can't be links. Only
what passes is compared by its tokens, and tokens are made and moved for these sets alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import components, stored

#: Lists of up to so many nodes are compared as rows.
SMALL = 24
#: Nodes of a block of a larger list.
BLOCK = 1024


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of a set's 64-bit tokens over as many places as the next power of two, 64 at least, as 64-bit words."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _differing(one: str, two: str) -> Column:
    """In how many places two sketches differ, the longer one folded; null if one is more than twice as long."""
    size, longer = F.least(F.size(one), F.size(two)), F.greatest(F.size(one), F.size(two))

    def folded(words: str) -> Column:
        halves = F.zip_with(F.slice(words, 1, size), F.slice(words, size + 1, size), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(words) > size, halves).otherwise(F.col(words))

    bits = F.zip_with(folded(one), folded(two), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.when(longer <= 2 * size, F.aggregate(bits, F.lit(0), lambda n, b: n + b))


def possible_pairs(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may reach the threshold, by the sizes and sketches (node, n, sketch) of their sets."""
    for end in ("a", "b"):
        pairs = pairs.join(marks.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("sketch").alias(f"s{end}")), end)
    # d different tokens leave (na + nb - d) / 2 of (na + nb + d) / 2 in common.
    differ = F.greatest(_differing("sa", "sb"), F.abs(F.col("na") - F.col("nb")))
    return pairs.where((100 - percent) * (F.col("na") + F.col("nb")) >= (100 + percent) * differ).select("a", "b")


def listed(indexed: DataFrame) -> DataFrame:
    """Every node of a list but its first, with the first and the one before (structs of n and node)."""
    order = Window.partitionBy("signature").orderBy("n", "node")
    return (
        indexed.withColumn("before", F.lag(F.struct("n", "node")).over(order))
        .withColumn("first", F.first(F.struct("n", "node")).over(order))
        .where("before.node <> node")
    )


def listed_nodes(lists: DataFrame) -> DataFrame:
    """The distinct nodes that share a signature with another."""
    return lists.select("node").union(lists.select("first.node")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def near_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) along the lists whose sizes allow a Jaccard similarity of ``percent`` hundredths."""
    return (
        lists.select("node", "n", F.explode(F.array("first", "before")).alias("other"))
        .where(F.col("other.n") * 100 >= F.col("n") * percent)
        .select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b"))
        .where("a <> b").distinct()
    )


def _rows(lists: DataFrame, joined: DataFrame) -> DataFrame:
    """Every node of a list, with the list's first node and size and the node's component (``part``)."""
    rows = lists.select("signature", "node", "n", F.col("first.node").alias("pivot")).union(
        lists.select("signature", "first.node", "first.n", "first.node")
    ).distinct()
    sizes = lists.groupBy("signature").agg((F.count("*") + 1).alias("size"))
    # Lists of up to three nodes have been paired in full.
    rows = rows.join(sizes.where("size > 3"), "signature").join(joined, "node", "left")
    return rows.withColumn("part", F.coalesce("component", "node")).drop("component")


def _open(rows: DataFrame, key: str) -> DataFrame:
    parts = rows.groupBy(key).agg(F.min("part").alias("p"), F.max("part").alias("q"))
    return rows.join(parts.where("p <> q").select(key), key)


def across(rows: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in small lists that ``done`` doesn't hold."""
    rows = _open(rows.where(F.col("size") <= SMALL), "signature")
    left = rows.select("signature", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("part").alias("px"))
    right = rows.select("signature", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("part").alias("py"))
    pairs = left.join(right, "signature").where(
        (F.col("px") < F.col("py")) & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
    )
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(
        done, ["a", "b"], "left_anti"
    )


def possible_members(rows: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """What has to be compared in large lists. Lists with one first node are taken together; their nodes are dealt to
    blocks by hash, and a task compares the sketches of two blocks (or of one with itself). A node stays in those
    comparisons (pivot, i, j) where a node of another component may reach the threshold with it."""
    members = _open(rows.where(F.col("size") > SMALL).select("pivot", "node", "part").distinct(), "pivot")
    blocks = members.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(blocks, "pivot").join(marks, "node").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "part", "n", "sketch")

    def compare(group: pa.Table) -> pa.Table:
        own, part, n = (group[c].to_numpy() for c in ("own", "part", "n"))
        met = _possible(own, part, n, group["sketch"].combine_chunks(), percent)
        return group.select(["pivot", "i", "j", "own", "node", "part"]).filter(pa.array(met))

    return dealt.groupBy("pivot", "i", "j").applyInArrow(compare, "pivot long, i int, j int, own int, node long, part long")


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different components of large lists, from the comparisons that are left."""

    def compare(group: pa.Table) -> pa.Table:
        own, node, part = (group[c].to_numpy() for c in ("own", "node", "part"))
        links = _joining(own, node, part, group["tokens"].combine_chunks(), percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return members.join(sets, "node").groupBy("pivot", "i", "j").applyInArrow(compare, "a long, b long")


def _sides(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of one block stand against those of the other; a block alone, against itself."""
    return np.flatnonzero(own == own.min(initial=own.max(initial=0))), np.flatnonzero(own == own.max(initial=0))


def _possible(own: np.ndarray, part: np.ndarray, n: np.ndarray, sketches: pa.ListArray, percent: int) -> np.ndarray:
    """Which rows may reach the threshold with one of another part on the other side."""
    words, ends = sketches.flatten().to_numpy(), np.append(0, np.cumsum(sketches.value_lengths().to_numpy()))
    length, met, (left, right) = np.diff(ends), np.zeros(len(own), dtype=bool), _sides(own)

    def signs(at: np.ndarray, size: int, first: int, stop: int) -> np.ndarray:
        """Sketches folded to ``size`` words, of which some; a place as 1 or -1."""
        some = np.stack([np.bitwise_xor.reduce(words[ends[i] : ends[i + 1]].reshape(-1, size)[:, first:stop], axis=0) for i in at])
        return 1 - 2 * np.unpackbits(some.view(np.uint8), axis=1).astype(np.float32)

    for one in np.unique(length[left]):
        for two in np.unique(length[right]):
            x, y, size = left[length[left] == one], right[length[right] == two], int(min(one, two))
            if 100 * min(n[x].max(), n[y].max()) < percent * max(n[x].min(), n[y].min()):
                continue
            alike = np.zeros((len(x), len(y)), dtype=np.float32)
            for first in range(0, size, 32):
                alike += signs(x, size, first, first + 32) @ signs(y, size, first, first + 32).T
            both = n[x][:, None] + n[y][None, :]
            differ = np.maximum((64 * size - alike) / 2, np.abs(n[x][:, None] - n[y][None, :]))
            near = ((100 - percent) * both >= (100 + percent) * differ) & (part[x][:, None] != part[y][None, :])
            met[x[near.any(axis=1)]] = True
            met[y[near.any(axis=0)]] = True
    return met


def _joining(own: np.ndarray, node: np.ndarray, part: np.ndarray, tokens: pa.ListArray, percent: int) -> list[tuple[int, int]]:
    """Links between different parts, no more than needed to join them. Shared tokens are counted by products of
    small 0/1 matrices over the tokens that occur twice."""
    sizes = np.diff(tokens.offsets.to_numpy())
    _, column, count = np.unique(tokens.flatten().to_numpy(), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(node), dtype=np.int32), sizes)
    keep = count[column] > 1
    row, column = row[keep], (np.cumsum(count > 1, dtype=np.int32) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left, right = _sides(own)
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(column.max(initial=-1)) + 1, 2048):
        a, b = np.searchsorted(column, [low, low + 2048])
        some = np.zeros((len(node), 2048), dtype=np.float32)
        some[row[a:b], column[a:b] - low] = 1
        used = np.zeros(len(node), dtype=bool)
        used[row[a:b]] = True
        x, y = np.flatnonzero(used[left]), np.flatnonzero(used[right])
        shared[np.ix_(x, y)] += some[left[x]] @ some[right[y]].T
    root = {int(p): int(p) for p in part}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    out = []
    for at, x in enumerate(left):
        near = right[(100 * shared[at] >= percent * (sizes[x] + sizes[right] - shared[at])) & (part[right] != part[x])]
        for y in near:
            p, q = find(int(part[x])), find(int(part[y]))
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((int(node[x]), int(node[y])))
    return out


def family_components(lists: DataFrame, percent: int, marks: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) over all links of the nodes that share a signature. ``marks`` (node, n, sketch) holds their
    sizes and sketches; ``sets_of`` makes the sets (node, tokens) of some nodes."""
    close = stored(possible_pairs(near_pairs(lists, percent), marks, percent))
    found = stored(jaccard_links(close, stored(sets_of(_ends(close))), percent))
    joined = stored(components(found))
    rows = stored(_rows(lists, joined))
    others = stored(possible_pairs(across(rows, close, percent), marks, percent))
    members = stored(possible_members(rows, marks, percent))
    if others.isEmpty() and members.isEmpty():
        return joined
    sets = stored(sets_of(_ends(others).union(members.select("node")).distinct()))
    rest = stored(jaccard_links(others, sets, percent).union(block_links(members, sets, percent)))
    return joined if rest.isEmpty() else stored(components(found.union(rest)))


def jaccard_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (node, tokens) reach the threshold, exactly."""
    one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.where(100 * shared >= percent * (F.size("ta") + F.size("tb") - shared)).select("a", "b")
