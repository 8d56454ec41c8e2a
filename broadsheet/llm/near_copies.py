"""Groups of near copies by SimHash and verified similarity, with an exact way for the pairs that fingerprints miss.

Two texts are near copies if their sets of five-word shingles are alike in 0.8 or more (Jaccard). First come the pairs of
SimHash: fingerprints of the sets within RADIUS bits, found with the BK-trees of `simhash`. Texts alike in just 0.8 often lie
further apart (about 10 bits), so a prefix filter follows, which no pair alike enough can escape: all shingles have one order, and two sets of that similarity share one of the first n - ceil(0.8 n) + 1
shingles of each (n is the set's size). Shingles that are frequent in a sample of the texts come last in the order, which
keeps lists of holders short; any order is exact. A candidate pair is dropped only where a bound proves it unlike: sets
too different in size, or more differing bits between the sets' parity maps than shingles may differ. A parity map fills up
with the set's size, so pairs of large sets are also bounded by how many shingles fall into each of many bins, before a text
travels. All others are verified on the whole texts, and verified pairs are joined to groups.

The members of a large group are not all paired with each other. Exact copies are folded first. Of one fingerprint, and of
fingerprints linked in a tree, each meets the least. Then every text meets the nearest of the least holders of its shingles, then each group that still shares a shingle with others meets the nearest few
of them, and last all pairs that are left between different groups. Holders of a shingle meet inside a task, as matrices of
their maps; shingles with many holders are dealt into tiles. No pair is verified twice, and a text that many others are
verified against travels once for each piece of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm import simhash
from broadsheet.llm.components import components
from broadsheet.llm.words import SEED, WordHashes, free_names, mixed, run_hashes, slices, words
from broadsheet.session import new_folder, scratch, stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 7  # bits in which the fingerprints of a first pair may differ
NEAREST = 8
MAP = 16  # longs of a parity map
LARGE = 1_500  # shingles from which a set fills its map too much to be told from others by it
PER_BIN = 16  # shingles of a large set in a bin, at most, on average
SAMPLE = 20_000  # texts in which frequent shingles are sought
COMMON = 200_000  # frequent shingles that are remembered
_MAPS = [f"m{k}" for k in range(MAP)]


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; of two empty ones 1."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _set(h: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    return np.unique(run_hashes(h, shingle))


def _parity(s: np.ndarray) -> np.ndarray:
    """Of each bit, whether an odd number of hashes falls on it. Maps of two sets differ in no more bits than the sets do in
    members."""
    odd = np.bincount((s & np.uint64(64 * MAP - 1)).astype(np.int64), minlength=64 * MAP).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _bins(s: np.ndarray) -> bytes | None:
    """Of a large set, how many hashes fall into each of a power of two bins, modulo 256. Two sets differ in at least as many
    members as their counts do."""
    if len(s) < LARGE:
        return None
    size = 1 << math.ceil(math.log2(len(s) / PER_BIN))
    return np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """Members in which two sets of these bins differ at least."""
    x, y = (np.frombuffer(c, np.uint8) for c in (a, b))
    size = min(len(x), len(y))
    # a bin of half as many holds what falls into two of them
    away = x.reshape(-1, size).sum(axis=0, dtype=np.uint8) - y.reshape(-1, size).sum(axis=0, dtype=np.uint8)
    return int(np.minimum(away, -away).sum(dtype=np.int64))


def _bounded(least: float):
    """Marks the pairs whose similarity is possible by the bins of both; a pair without them is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = zip(*(part.column(c).to_pylist() for c in ("low_n", "high_n", "low_bins", "high_bins")))
            possible = [a is None or b is None or _apart(a, b) <= (n + m) * ((1 - least) / (1 + least)) + 1e-9 for n, m, a, b in rows]
            yield pa.RecordBatch.from_arrays([part.column("low"), part.column("high"), pa.array(possible, pa.bool_())],
                                             ["low", "high", "possible"])

    return run


def _common(given: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample hold, sorted, and how many hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in slices(batches):
            for t in part.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_set(known.of(words(t)), shingle).view(np.int64))], ["h"])

    share = max(1, given.count() // SAMPLE)
    sample = given.filter(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select("text")
    counts = sample.mapInArrow(run, "h long").groupBy("h").count().filter("count > 2").orderBy(F.desc("count"), "h").limit(COMMON)
    rows = counts.toPandas()
    h, n = rows["h"].to_numpy(np.int64).view(np.uint64), rows["count"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _prefix(s: np.ndarray, least: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set, rare ones first, one of which any set alike in `least` shares among its own first."""
    h, n = common
    held = np.zeros(len(s), np.int64)
    if len(h):
        at = np.minimum(np.searchsorted(h, s), len(h) - 1)
        held = np.where(h[at] == s, n[at], 0)
    return s[np.lexsort((s, held))][:len(s) - math.ceil(least * len(s) - 1e-9) + 1]


def _prints(shingle: int, least: float, common: tuple[np.ndarray, np.ndarray]):
    """Of each text the number of distinct shingles, a digest of its words, its first shingles, its fingerprint, its bins and
    its parity map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in slices(batches):
            tokens = [words(t) for t in part.column(2).to_pylist()]
            sets = [_set(known.of(t), shingle) for t in tokens]
            maps = np.array([_parity(s) for s in sets], np.int64).reshape(-1, MAP)
            columns = [pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([xxhash.xxh3_128_digest(b" ".join(t), SEED) for t in tokens], pa.binary()),
                       pa.array([_prefix(s, least, common).view(np.int64) for s in sets], pa.list_(pa.int64())),
                       pa.array([simhash.folded(s) for s in sets], pa.int64()), pa.array([_bins(s) for s in sets], pa.binary()),
                       *(pa.array(np.ascontiguousarray(m)) for m in maps.T)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["node", "id", "n", "digest", "first", "fp", "bins", *_MAPS])

    return run


def _possible(least: float) -> tuple[Column, Column]:
    """Of rows a and b: the differing bits of their maps, and whether sizes and maps leave the similarity possible."""
    away = sum((F.bit_count(F.col(f"a.{m}").bitwiseXOR(F.col(f"b.{m}"))) for m in _MAPS), F.lit(0))
    sizes = F.least("a.n", "b.n") >= least * F.greatest("a.n", "b.n") - 1e-9
    return away, sizes & (away <= (F.col("a.n") + F.col("b.n")) * ((1 - least) / (1 + least)) + 1e-9)


def _met(least: float, nearest: int | None):
    """Pairs of texts of different groups within each tile (rows lie together by token, i and j) whose similarity is
    possible; with `nearest`, for each group only the nearest pair in each of so many classes of other groups."""

    def tile(rows: list[np.ndarray]) -> list[np.ndarray]:
        node, comp, n, own, i, j, maps = rows
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = []
        for at in range(0, len(a), 128):
            some = a[at:at + 128]
            x, y = np.nonzero((comp[some][:, None] != comp[b][None, :]) & ((node[some][:, None] < node[b][None, :]) | (i[0] != j[0])))
            for cut in range(0, len(x), 65_536):
                p, q = some[x[cut:cut + 65_536]], b[y[cut:cut + 65_536]]
                sized = np.minimum(n[p], n[q]) >= least * np.maximum(n[p], n[q]) - 1e-9
                p, q = p[sized], q[sized]
                away = np.bitwise_count(maps[p] ^ maps[q]).sum(axis=1, dtype=np.int64)
                near = away <= (n[p] + n[q]) * ((1 - least) / (1 + least)) + 1e-9
                found.append(np.stack([p[near], q[near], away[near]]))
        p, q, away = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        if nearest is not None and len(p) > 1:
            order = np.lexsort((node[q], node[p], away))
            stay = np.zeros(len(p), bool)
            for mine, other in ((p, q), (q, p)):
                slot = mixed(comp[other].view(np.uint64)) % np.uint64(nearest)
                key = np.stack([comp[mine], slot.astype(np.int64)], axis=1)[order]
                stay[order[np.unique(key, axis=0, return_index=True)[1]]] = True
            p, q, away = p[stay], q[stay], away[stay]
        swap = node[p] > node[q]
        p, q = np.where(swap, q, p), np.where(swap, p, q)
        return [node[p], node[q], away, comp[p], comp[q]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def tiles(rows: list[np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            found = [tile([c[a:b] for c in rows[1:]]) for a, b in zip(edges[:-1], edges[1:]) if b - a > 1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)],
                                                 ["low", "high", "away", "low_comp", "high_comp"])

        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("token", "node", "comp", "n", "own", "i", "j")]
            rows.append(np.stack([batch.column(m).to_numpy() for m in _MAPS], axis=1).view(np.uint64))
            if held is not None:
                rows = [np.concatenate(c) for c in zip(held, rows)]
            token, i, j = rows[0], rows[5], rows[6]
            new = (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            edges = np.concatenate(([0], np.flatnonzero(new) + 1))
            yield from tiles(rows, edges)
            held = [c[edges[-1]:] for c in rows]
        if held is not None:
            yield from tiles(held, np.array([0, len(held[0])]))

    return run


def _verified(shingle: int, least: float):
    """Groups of the pairs alike enough: rows of one text `low` lie together, its own text first, then those it is compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mine = WordHashes(), None
        for part in slices(batches):
            stay = []
            for head, text in zip(part.column("head").to_pylist(), part.column("text").to_pylist()):
                s = _set(known.of(words(text)), shingle)
                if head:
                    mine = s
                stay.append(not head and alike(mine, s) >= least)
            yield part.select(["low_comp", "high_comp"]).filter(pa.array(stay, pa.bool_()))

    return run


def groups(docs: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY, nearest: int = NEAREST,
           id_col: str = "doc_id", text_col: str = "text", piece: int = simhash.PIECE, radius: int = RADIUS) -> DataFrame:
    """(node, id, comp) of every row: node is a hash of the row's id and text, and rows of one group have one comp.

    Null texts and texts without words are copies of each other. Rows that agree in id and text are one node.
    """
    given = docs.select(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("node"), F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).alias("text"))
    maps = ", ".join(f"{m} long" for m in _MAPS)
    prints = stored(given.mapInArrow(_prints(shingle, least, _common(given, shingle)),
                                     f"node long, id long, n long, digest binary, first array<long>, fp long, bins binary, {maps}"), "copy-prints")
    # exact copies are one text from here on; the text's node is the least of theirs
    texts = stored(prints.groupBy("digest").agg(F.min("node").alias("node"), *(F.first(c).alias(c) for c in ("n", "fp", *_MAPS))), "copy-texts")
    labels = stored(texts.select("node", "n", *_MAPS, F.col("node").alias("comp")), "copy-labels")
    bins = prints.filter("bins is not null").select("node", "bins").join(texts.select("node"), "node", "left_semi")
    bins = stored(bins.dropDuplicates(["node"]), "copy-bins")
    held = prints.select("node", "first").join(texts.select("node"), "node", "left_semi").dropDuplicates(["node"])
    each = Window.partitionBy("token")
    held = (held.select("node", F.explode("first").alias("token"))
            .select("token", "node", F.min("node").over(each).alias("hub"), F.max("node").over(each).alias("last")))
    held = stored(held.filter("hub < last").select("token", "node", "hub"), "copy-holders")
    away, possible = _possible(least)

    def prints_near() -> DataFrame:
        leasts = stored(texts.groupBy("fp").agg(F.min("node").alias("node")), "copy-fingerprints")
        same = texts.select("fp", F.col("node").alias("high")).join(leasts.select("fp", F.col("node").alias("low")), "fp").select("low", "high")
        linked = (simhash.links(leasts.select("fp"), radius, piece).distinct()
                  .join(leasts.select("fp", F.col("node").alias("one")), "fp")
                  .join(leasts.select(F.col("fp").alias("least"), F.col("node").alias("other")), "least")
                  .select(F.least("one", "other").alias("low"), F.greatest("one", "other").alias("high")))
        pairs = same.unionByName(linked).filter("low <> high").distinct().alias("p")
        return (pairs.join(labels.alias("a"), F.col("p.low") == F.col("a.node")).join(labels.alias("b"), F.col("p.high") == F.col("b.node"))
                .filter(possible).select("p.low", "p.high"))

    def hubs() -> DataFrame:
        pairs = held.filter("node <> hub").select("hub", "node").distinct().alias("p")
        met = (pairs.join(labels.alias("a"), F.col("p.hub") == F.col("a.node")).join(labels.alias("b"), F.col("p.node") == F.col("b.node"))
               .filter(possible & (F.col("a.comp") != F.col("b.comp"))).select("p.hub", "p.node", away.alias("away")))
        best = met.groupBy("node").agg(F.min(F.struct("away", "hub")).alias("best"))
        return best.select(F.col("best.hub").alias("low"), F.col("node").alias("high"))  # the hub is the least of its holders

    def across(most: int | None) -> DataFrame:
        """Pairs of different groups that share a shingle, where the similarity is possible."""
        keyed = held.select("token", "node").join(labels.select("node", "comp"), "node")
        several = (keyed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows"))
                   .filter("lo < hi").select("token", F.ceil(F.col("rows") / piece).cast("int").alias("pieces")))
        rows = held.select("token", "node").join(several, "token").join(labels, "node")
        own = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
        dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        tiles = dealt.select("token", "node", "comp", "n", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *_MAPS)
        tiles = tiles.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
        return tiles.mapInArrow(_met(least, most), "low long, high long, away long, low_comp long, high_comp long")

    def some() -> DataFrame:
        met = stored(across(nearest), "copy-met")

        def side(mine: str, other: str) -> DataFrame:
            slot = F.pmod(F.xxhash64(other), F.lit(nearest)).alias("slot")
            return met.groupBy(F.col(mine).alias("mine"), slot).agg(F.min(F.struct("away", "low", "high")).alias("best"))

        best = side("low_comp", "high_comp").unionByName(side("high_comp", "low_comp"))
        return best.select("best.low", "best.high").distinct()

    def rest() -> DataFrame:
        return across(None).select("low", "high").distinct()

    tested: DataFrame | None = None
    for candidates in (prints_near, hubs, some, rest):
        pairs = candidates()
        if tested is not None:
            pairs = pairs.join(tested, ["low", "high"], "left_anti")
        for side in ("low", "high"):
            pairs = pairs.join(labels.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n")), side)
            pairs = pairs.join(bins.select(F.col("node").alias(side), F.col("bins").alias(f"{side}_bins")), side, "left")
        bounded = stored(pairs.mapInArrow(_bounded(least), "low long, high long, possible boolean"), "copy-pairs")
        pairs = bounded.select("low", "high")
        tested = pairs if tested is None else tested.unionByName(pairs)
        pairs = bounded.filter("possible").select("low", "high")
        wanted = pairs.select(F.explode(F.array("low", "high")).alias("wanted")).distinct()
        # not stored: both joins below read one shuffle of the texts
        bodies = given.join(wanted, F.col("node") == F.col("wanted"), "left_semi").groupBy("node").agg(F.first("text").alias("text"))
        comps = labels.select("node", "comp")
        sized = pairs.groupBy("low").agg(F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("pieces"))
        dealt = (pairs.join(sized, "low").join(comps.select(F.col("node").alias("low"), F.col("comp").alias("low_comp")), "low")
                 .join(comps.select(F.col("node").alias("high"), F.col("comp").alias("high_comp")), "high")
                 .select("low", F.pmod(F.xxhash64("high"), F.col("pieces")).cast("int").alias("part"), "high", "low_comp", "high_comp"))
        members = dealt.join(bodies, F.col("high") == F.col("node")).select("low", "part", F.lit(False).alias("head"), "text", "low_comp", "high_comp")
        no_comp = F.lit(None).cast("long")
        heads = (dealt.select("low", "part").distinct().join(bodies, F.col("low") == F.col("node"))
                 .select("low", "part", F.lit(True).alias("head"), "text", no_comp.alias("low_comp"), no_comp.alias("high_comp")))
        joined = heads.unionByName(members).repartition("low", "part").sortWithinPartitions("low", "part", F.desc("head"))
        links = components(joined.mapInArrow(_verified(shingle, least), "low_comp long, high_comp long"))
        moved = labels.join(links.select(F.col("node").alias("was"), "root"), F.col("comp") == F.col("was"), "left")
        labels = stored(moved.select("node", "n", *_MAPS, F.coalesce("root", "comp").alias("comp")), "copy-labels")
    return (prints.join(texts.select("digest", F.col("node").alias("text_node")), "digest")
            .join(labels.select(F.col("node").alias("text_node"), "comp"), "text_node").select("node", "id", "comp"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each group of copies, with all columns of `docs`: the one of the smallest id (rows without an id last;
    among rows of one id the one of the least hash of its text; of rows that agree in both, any)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "copies-kept")
    key, node, rows = free_names(docs, "key", "node", "rows")
    with scratch(spark):
        member = groups(docs, id_col=id_col, text_col=text_col, **settings)
        least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))
        first = member.groupBy("comp").agg(least.alias("first")).select(F.col("first.node").alias("first"))
        copies = member.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
        first.join(copies, F.col("first") == F.col("node")).select("node", "rows").write.parquet(folder)
    stays = spark.read.schema("node long, rows long").parquet(folder).toDF(node, rows)
    kept = (docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)))
            .join(stays, F.col(key) == F.col(node)))
    once, again = kept.filter(F.col(rows) == 1), kept.filter(F.col(rows) > 1).dropDuplicates([key])
    return once.unionByName(again).select(*(F.col(f"`{c}`") for c in docs.columns))
