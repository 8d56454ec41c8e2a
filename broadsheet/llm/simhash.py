"""SimHash fingerprints and near-duplicate groups found with BK-trees.

A fingerprint's 64 bits are cut into blocks. Two fingerprints that differ in at most `radius` bits agree on all bits of at
least `agree` of `radius + agree` blocks, so equi keys made of every choice of `agree` blocks bring all such pairs
together. Each key's fingerprints are a shard: they form a BK-tree (children keyed by their integer Hamming distance to
the parent), and a search follows only edges within the radius. A shard that is too large for one task is dealt into
pieces, and each piece's tree is sent to all the other pieces of its shard. A task returns no pairs but, for each
fingerprint that has a link, the least fingerprint it is connected with, so rows stay in proportion to fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.components import components
from broadsheet.llm.words import hashes, shingles, slices, words
from broadsheet.session import stored

PIECE = 1024  # fingerprints of one tree, and of one set of probes


def folded(h: np.ndarray) -> int:
    """64 bits; a bit is 1 if it is set in over half the hashes. Zero for none."""
    if not len(h):
        return 0
    bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(h)
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def fingerprint(items: list[bytes]) -> int:
    """The fingerprint of the items' XXH64 hashes."""
    return folded(hashes(items))


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 features: Callable[[list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, fp) for every row: the fingerprint of the text's shingles of `size` words, or of what `features` makes of its
    words. Null and wordless texts have fingerprint zero; repeated and null ids keep their rows; other columns are not read."""
    take = features or (lambda tokens: shingles(tokens, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            prints = [fingerprint(take(words(t))) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.int64())], ["id", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, fp long"))


# --- BK-trees -------------------------------------------------------------------------------------------------------

def bk_tree(values: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """Nodes (index of the value, {distance: child node}); node 0 is the root. Values are distinct uint64."""
    nodes: list[tuple[int, dict[int, int]]] = []
    waiting: list[tuple[np.ndarray, dict[int, int] | None, int]] = [(np.arange(len(values)), None, 0)]
    while waiting:
        members, parent, edge = waiting.pop()
        children: dict[int, int] = {}
        if parent is not None:
            parent[edge] = len(nodes)
        nodes.append((int(members[0]), children))
        rest = members[1:]
        if len(rest):
            away = np.bitwise_count(values[rest] ^ values[members[0]])
            waiting.extend((rest[away == d], children, int(d)) for d in np.unique(away))
    return nodes


def bk_search(values: np.ndarray, nodes: list, probes: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of a value, probes within the radius of it, their distances). All probes walk the tree together; a probe
    goes along the edge d only if its distance to the node lies in d - radius .. d + radius."""
    waiting = [(0, np.arange(len(probes)))]
    while waiting:
        node, here = waiting.pop()
        value, children = nodes[node]
        away = np.bitwise_count(probes[here] ^ values[value]).astype(np.int16)
        near = away <= radius
        if near.any():
            yield value, here[near], away[near]
        for edge, child in children.items():
            follow = here[np.abs(away - edge) <= radius]
            if len(follow):
                waiting.append((child, follow))


def _joined(tree: np.ndarray, probes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Every value that has a link, with the least value it is connected with through links inside this shard."""
    alone = probes is tree
    items = tree if alone else np.concatenate([tree, probes])
    shift = 0 if alone else len(tree)
    group = np.arange(len(items))
    for value, near, _ in bk_search(tree, bk_tree(tree), probes, radius):
        met = np.append(group[near + shift], group[value])
        least = met.min()
        if met.max() != least:
            group[np.isin(group, met)] = least
    signed = items.view(np.int64)
    least = np.full(len(items), np.iinfo(np.int64).max)
    np.minimum.at(least, group, signed)
    linked = least[group] != signed
    return signed[linked], least[group][linked]


# --- shards ---------------------------------------------------------------------------------------------------------

def masks(radius: int, agree: int) -> list[int]:
    """The bits of every choice of `agree` out of `radius + agree` nearly equal blocks, as signed longs."""
    parts = radius + agree
    edges = [64 * k // parts for k in range(parts + 1)]
    block = [((1 << edges[k + 1]) - (1 << edges[k])) for k in range(parts)]
    return [int(np.uint64(sum(chosen)).astype(np.int64)) for chosen in combinations(block, agree)]


def blocks_to_agree(n: int, radius: int, size: int = PIECE) -> int:
    """How many blocks a key takes so that shards of evenly spread fingerprints hold at most `size`. Any choice is exact."""
    agree = 1
    while agree < 4 and n / 2 ** (64 * agree / (radius + agree)) > size:
        agree += 1
    return agree


def sharded(prints: DataFrame, radius: int, piece: int = PIECE, spread: str = "fp") -> DataFrame:
    """Rows (shard, key, i, j, probe, fp...): a group (shard, key, i, j) holds the tree's fingerprints (probe 0) and those
    that only search it (probe 1), at most about `piece` of each. Values of `spread` deal a large shard into pieces."""
    agree = blocks_to_agree(prints.count(), radius, piece)
    keys = F.explode(F.array(*(F.struct(F.lit(t).alias("shard"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                               for t, m in enumerate(masks(radius, agree)))))
    keyed = prints.withColumn("k", keys).select("k.shard", "k.key", *prints.columns)
    large = stored(keyed.groupBy("shard", "key").count().filter(F.col("count") > piece)
                   .select("shard", "key", F.ceil(F.col("count") / piece).cast("int").alias("pieces")), "large-shards")
    own = F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("pieces"))).cast("int")
    meets = F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("pieces") - 1))
    dealt = keyed.join(large, ["shard", "key"], "left").withColumn("own", own).withColumn("other", F.explode(meets))
    group = ["shard", "key", "i", "j"]
    return (dealt.select("shard", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") > F.col("other")).cast("int").alias("probe"), *prints.columns)
            .repartition(*group).sortWithinPartitions(*group, "probe", "fp"))


def shard_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each group of at least two rows, from rows sorted by group."""
    held: dict[str, np.ndarray] | None = None

    def cut(cols: dict[str, np.ndarray], last: bool) -> tuple[list, dict | None]:
        n = len(cols["fp"])
        new = np.zeros(n, bool)
        for c in ("shard", "key", "i", "j"):
            new[1:] |= cols[c][1:] != cols[c][:-1]
        starts = np.flatnonzero(new)
        edges = np.concatenate(([0], starts, [n]))
        done = len(edges) - 1 if last else len(edges) - 2
        out = [(int(edges[k]), int(edges[k + 1])) for k in np.flatnonzero(np.diff(edges[: done + 1]) > 1)]
        return out, None if last else {c: v[edges[-2]:] for c, v in cols.items()}

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if held is not None:
            cols = {c: np.concatenate([held[c], v]) for c, v in cols.items()}
        groups, held = cut(cols, False)
        for a, b in groups:
            yield {c: v[a:b] for c, v in cols.items()}
    if held is not None:
        groups, _ = cut(held, True)
        for a, b in groups:
            yield {c: v[a:b] for c, v in held.items()}


def sides(group: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tree's rows and the probing rows of a group, as indices; the same object where a piece searches its own tree."""
    tree = np.flatnonzero(group["probe"] == 0)
    return (tree, tree) if group["i"][0] == group["j"][0] else (tree, np.flatnonzero(group["probe"] == 1))


def links(prints: DataFrame, radius: int = 3, piece: int = PIECE) -> DataFrame:
    """(fp, least): links that connect exactly what pairs of distinct fingerprints within the radius connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in shard_groups(batches):
            tree, probes = sides(group)
            if len(tree) and len(probes):
                values = group["fp"].view(np.uint64)
                known = np.ascontiguousarray(values[tree])
                a, b = _joined(known, known if probes is tree else np.ascontiguousarray(values[probes]), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["fp", "least"])

    return sharded(prints.select("fp").distinct(), radius, piece).mapInArrow(run, "fp long, least long")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text",
                    piece: int = PIECE) -> DataFrame:
    """One row for each document: its id, its fingerprint (16 hex digits) and component_id, the smallest id reachable
    through links between fingerprints that differ in at most `radius` bits.

    Null texts and texts without words have fingerprint zero and are linked like any other. Rows without an id keep their
    row and lend their links, but never name a component (null if no member has an id). Repeated rows stay repeated.
    """
    prints = stored(fingerprints(docs, size, id_col, text_col), "fingerprints")
    first = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    joined = components(links(first, radius, piece))
    member = first.join(joined, first["fp"] == joined["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                           "component_id")
