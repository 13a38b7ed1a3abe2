"""Near-duplicate documents by MinHash with tensored banding.

A table key normally joins several minhashes, and each of many tables needs its own. Here
two small collections of ``SUBKEYS`` sub-keys, of ``JOINED`` minhashes each, are computed,
and every pair of one from either collection is the key of one table: 256 tables from 128
minhashes instead of 2,048. Two texts meet in a table when they share a sub-key of both
collections, which texts of similarity 0.85 fail to do once in 30,000 pairs, and texts of
0.8 once in 2,200.

1. One pass makes each text's word shingles, the number of different ones, a digest of the
   set and the sub-keys. Equal sets go on as one.
2. Sub-keys that only one text has can't be part of a shared table key and are left out; the
   others are paired.
3. In each table, texts are tied through the smallest id of their bucket, not to one
   another. What hangs together through such ties is a cluster of candidates.
4. In a cluster texts are compared on full sets of shingles, inside tasks; a piece of work
   yields at most one link for each of its texts: enough for the components. Small clusters
   are compared whole. In a large one each text is first compared with its heads and with a
   few texts of the largest group so far, which links most near copies in steps that grow
   with their number; then all texts of unlike groups are compared, in pairs of blocks. So
   no bucket is capped, no pairs of texts are written out, and the square of a cluster's size
   is only paid for texts that hang together by candidates alone.
5. Components of those links are the groups.

Words are what stands between the characters ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. A
text of fewer words than a shingle is one shingle; null, empty and blank texts have none and
are linked with nothing. Rows that share an id are one document: their sets are linked. Rows
with a null id take no part, and have a null component. Texts are compared whole. An empty
table gives an empty result. Only doc_id and text are read: other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.components import components
from refinery.session import materialize

SUBKEYS, JOINED = 16, 4
BLOCK = 384  # texts of a cluster that are compared with as many others at a time
ROUNDS, PIVOTS = 2, 64  # times that the largest group of a cluster is looked to, and with how many texts
PACK = 512  # texts of small clusters that share a piece of work, about
WEIGHT = 1 << 21  # shingles in a block or pack, about: long texts make for fewer of them
COLUMNS = 2048  # shingles that are compared at a time

_MIX = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


@cache
def constants() -> tuple[np.ndarray, np.ndarray]:
    """A pair of constants for each minhash; they must be the same in every task and run."""
    n = 2 * SUBKEYS * JOINED
    return mix(np.arange(1, n + 1, dtype=np.uint64)), mix(np.arange(n + 1, 2 * n + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted 64-bit hashes of the different shingles of a text."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    own = pd.util.hash_array(np.array(parts, dtype=object), categorize=False)
    size = min(words, len(own))
    hashes = np.full(len(own) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        hashes = mix(hashes + own[i : len(own) - size + 1 + i])
    return np.unique(hashes)


def subkeys(hashes: np.ndarray) -> np.ndarray:
    """The sub-keys of a set: even numbers in the first collection, odd ones in the second."""
    flip, factor = constants()
    least = np.full(len(flip), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[i : i + 4096, None] ^ flip) * factor).min(axis=0))
    joined = np.arange(1, 2 * SUBKEYS + 1, dtype=np.uint64)
    for column in mix(least).reshape(2 * SUBKEYS, JOINED).T:
        joined = mix(joined + column)
    return (joined & ~np.uint64(1)) | np.repeat(np.array([0, 1], dtype=np.uint64), SUBKEYS)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and sub-keys of every row, in one pass."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for known, doc_id, text in zip(batch["known"], batch["doc_id"], batch["text"]):
                own = shingles(text, words)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
                keys = subkeys(own).astype(np.int64) if len(own) else None
                rows.append((doc_id if known else None, len(own), digest, keys))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "keys"]).astype({"doc_id": "Int64"})

    doc_id = F.col("doc_id").cast("long")
    named = docs.select(doc_id.isNotNull().alias("known"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"), "text")
    return named.mapInPandas(sketch, "doc_id long, n_shingles long, digest binary, keys array<long>")


def candidate_ties(texts: DataFrame) -> DataFrame:
    """Ties (a, b) that hold together the texts (node, keys) of every bucket.

    A text belongs to the smallest node of each of its buckets, its heads. It is tied to
    the first of its heads alone, and that one to its other heads: texts alike have the
    same heads, so there are few different ties.
    """
    flat = materialize(texts.select("node", F.explode("keys").alias("key")), "subkeys")
    shared = flat.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    shared = materialize(shared, "shared-subkeys")
    held = flat.join(shared, "key").groupBy("node").agg(F.collect_list("key").alias("keys"))  # 32 at most
    odd = lambda key: key.bitwiseAND(F.lit(1)) == 1
    paired = held.select(
        "node",
        F.explode(F.filter("keys", lambda key: ~odd(key))).alias("first"),
        F.filter("keys", odd).alias("others"),
    )
    tables = paired.select("node", F.explode(F.transform("others", lambda other: F.xxhash64("first", other))).alias("table"))
    tables = materialize(tables, "tables")
    heads = tables.groupBy("table").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a < last")
    belongs = tables.join(heads.select("table", "a"), "table").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    first = F.min("a").over(Window.partitionBy("b"))  # of 256 rows at most
    belongs = materialize(belongs.withColumn("first", first), "heads")
    return belongs.select("first", "b").union(belongs.filter("first <> a").select("first", "a")).toDF("a", "b").distinct()


def linked(sets: list[np.ndarray], nodes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets whose 100 * intersection is at least ``percent`` * union, as a link
    from each linked node to the smallest of those it hangs together with.

    Shingles of one set only are left out; the others are compared as columns of a matrix, a
    number of columns at a time.
    """
    sizes = np.array([len(s) for s in sets])
    every, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.flatnonzero(seen > 1)
    place = np.full(len(every), -1)
    place[common] = np.arange(len(common))
    row, column = np.repeat(np.arange(len(sets)), sizes), place[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, len(common), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    near = 100 * both.astype(np.float64) >= percent * union
    near |= nodes[:, None] == nodes[None, :]
    low = nodes.copy()
    while True:  # smallest node within reach
        lower = np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (lower == low).all():
            return [(int(a), int(b)) for a, b in zip(low, nodes) if a != b]
        low = lower


def verified_links(docs: DataFrame, clusters: DataFrame, ties: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that hold the components of ``clusters`` (node, n_shingles, cluster) on
    full sets.

    A cluster of at most ``BLOCK`` texts and ``WEIGHT`` shingles is compared at once, with
    others of its like in one piece of work. In a larger one most texts are linked through
    few comparisons: with the heads they are tied to, and then with texts of the largest
    group so far. What these links hold together needs no more comparing, and only texts of
    unlike groups are compared with one another, block by block (``apart_links``).
    """
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("weight"))
    sizes = sizes.select("cluster", blocks_for("size", "weight").alias("blocks"))
    sized = materialize(clusters.join(sizes, "cluster"), "sized-clusters")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").filter("node IS NOT NULL")
    texts = texts.join(materialize(clusters.select("node"), "candidates"), "node", "left_semi")
    texts = materialize(texts, "candidate-texts")

    small = sized.filter("blocks = 1")
    total = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("weight")).first()
    key = F.pmod(F.xxhash64("cluster"), F.lit(max(1, -(-total["n"] // PACK), -(-total["weight"] // WEIGHT))))
    found = compared(small.select(F.struct(key.alias("pack")).alias("piece"), F.col("cluster").alias("part"), "node"), texts, words, percent)
    large = sized.filter("blocks > 1").select("node", "n_shingles", "cluster")
    if large.isEmpty():
        return found
    links = materialize(tie_links(large, ties, texts, words, percent), "links")
    for _ in range(ROUNDS):
        links = materialize(links.unionByName(pivot_links(grouped(large, links), texts, words, percent)), "links")
    return found.unionByName(links).unionByName(apart_links(grouped(large, links), texts, words, percent))


def blocks_for(size: str, weight: str) -> Column:
    return F.greatest(F.ceil(F.col(size) / BLOCK), F.ceil(F.col(weight) / WEIGHT), F.lit(1)).cast("int")


def block_of(blocks: Column | str, of: str = "node") -> Column:
    return F.pmod(F.xxhash64(of), F.col(blocks) if isinstance(blocks, str) else blocks).cast("int")


def compared(work: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among the texts of each part of each piece of ``work`` (piece, part, node)."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for _, own in rows.groupby("part", sort=False):
            sets = [shingles(t, words) for t in own["text"]]
            found += linked(sets, own["node"].to_numpy(), percent)
        return pd.DataFrame(found, columns=["a", "b"])

    named = materialize(work.select("piece", "part", "node"), "comparisons")
    return named.join(texts, "node").groupBy("piece").applyInPandas(lambda rows: compare(rows), "a long, b long")


def grouped(large: DataFrame, links: DataFrame) -> DataFrame:
    """``large`` with the group that ``links`` put each text in."""
    groups = components(links).select(F.col("node").alias("of"), "component")
    named = large.join(groups, F.col("node") == F.col("of"), "left")
    return materialize(named.select("node", "n_shingles", "cluster", F.coalesce("component", "node").alias("own")), "grouped")


def tie_links(large: DataFrame, ties: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links along the ties: each text against its heads, with a head that very many are tied
    to in one piece for each block of them."""
    own = ties.join(large.select(F.col("node").alias("b"), "n_shingles"), "b")
    sizes = own.groupBy("a").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("weight"))
    sizes = materialize(sizes.select("a", blocks_for("size", "weight").alias("blocks")), "heads-of-ties")
    tied = own.join(sizes, "a").select("a", "blocks", block_of("blocks", "b").alias("block"), F.col("b").alias("node"))
    heads = sizes.select("a", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("a").alias("node"))
    both = tied.unionByName(heads)
    packs = max(1, -(-own.count() // PACK))
    alone = F.struct(F.col("a").alias("head"), F.col("block"))
    packed = F.struct(F.pmod(F.xxhash64("a"), F.lit(packs)).alias("head"), F.lit(-1).alias("block"))
    piece = F.when(F.col("blocks") == 1, packed).otherwise(alone)
    return compared(both.select(piece.alias("piece"), F.col("a").alias("part"), "node"), texts, words, percent)


def leading(groups: DataFrame) -> DataFrame:
    """The largest group of each cluster that has several, and how many other texts it has."""
    sizes = groups.groupBy("cluster", "own").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("weight"))
    first = F.max(F.struct("size", -F.col("own"), "weight")).alias("first")
    found = sizes.groupBy("cluster").agg(first, F.sum("size").alias("all"), F.sum("weight").alias("total"))
    found = found.select("cluster", (-F.col("first.col2")).alias("lead"), F.col("first.size").alias("size"), (F.col("all") - F.col("first.size")).alias("others"), (F.col("total") - F.col("first.weight")).alias("weight"))
    return materialize(found.filter("others > 0"), "leading")


def pivot_links(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between the texts outside the largest group of their cluster, in blocks, and
    about ``PIVOTS`` texts of that group, chosen by a hash."""
    lead = leading(groups).withColumn("blocks", blocks_for("others", "weight"))
    named = groups.join(lead, "cluster")
    outside = named.filter("own <> lead").select("cluster", block_of("blocks").alias("block"), "node")
    step = F.ceil(F.col("size") / PIVOTS).cast("int")
    pivots = named.filter("own = lead").filter(F.pmod(F.xxhash64("node", F.lit("pivot")), step) == 0)
    pivots = pivots.select("cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node")
    work = outside.unionByName(pivots)
    return compared(work.select(F.struct("cluster", "block").alias("piece"), F.col("cluster").alias("part"), "node"), texts, words, percent)


def apart_links(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between texts of unlike groups of one cluster, all of them compared.

    A large group is cut into blocks of its own, small ones share blocks; each pair of blocks
    that aren't of the same large group is a piece of work. The pairs are rows without texts.
    """
    lead = leading(groups).select("cluster")
    left = groups.join(lead, "cluster", "left_semi")
    sizes = left.groupBy("cluster", "own").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("weight"))
    sizes = sizes.withColumn("blocks", blocks_for("size", "weight"))
    shared = sizes.filter("blocks = 1").groupBy("cluster").agg(F.sum("size").alias("n"), F.sum("weight").alias("w"))
    shared = shared.select("cluster", blocks_for("n", "w").alias("shared"))
    sizes = sizes.join(shared, "cluster", "left").select(
        "cluster", "own", F.when(F.col("blocks") > 1, F.col("own")).alias("alone"), "blocks", "shared"
    )
    block = F.when(F.col("alone").isNotNull(), block_of("blocks")).otherwise(block_of("shared", "own"))
    members = left.join(sizes, ["cluster", "own"]).select("cluster", F.struct(F.coalesce("alone", F.lit(-1)).alias("group"), F.col("alone").isNotNull().alias("large"), block.alias("block")).alias("place"), "node")
    members = materialize(members, "blocks")
    places = materialize(members.select("cluster", "place").distinct(), "places")
    other = places.select(F.col("cluster").alias("same"), F.col("place").alias("other"))
    apart = (F.col("place") <= F.col("other")) & ~(F.col("place.large") & F.col("other.large") & (F.col("place.group") == F.col("other.group")))
    pairs = places.join(other, (F.col("cluster") == F.col("same")) & apart).select("cluster", "place", "other")
    pairs = materialize(pairs, "block-pairs")
    one = pairs.join(members, ["cluster", "place"]).select("cluster", "place", "other", "node")
    two = pairs.filter("place <> other").join(members.withColumnRenamed("place", "other"), ["cluster", "other"]).select("cluster", "place", "other", "node")
    work = one.unionByName(two)
    return compared(work.select(F.struct("cluster", "place", "other").alias("piece"), F.col("cluster").alias("part"), "node"), texts, words, percent)


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their shingle
    sets; component_id is the smallest id within reach, and kept marks that document. What
    has a null id is kept.
    """
    drawn = materialize(sketches(docs, words), "sketches")
    sets = drawn.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
    sets = sets.agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"), F.first("n_shingles").alias("n_shingles"))
    sets = materialize(sets, "sets")
    ties = materialize(candidate_ties(sets.select("node", "keys")), "ties")
    clusters = components(ties).select("node", F.col("component").alias("cluster"))
    clusters = materialize(clusters.join(sets.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node"), "clusters")
    links = verified_links(docs, clusters, ties, words, percent)
    # Rows of one id and several sets are one document.
    alike = drawn.filter("digest IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "digest").join(sets.select("digest", "node"), "digest")
    alike = alike.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("a", "b")
    groups = components(links.unionByName(alike))
    groups = sets.select("digest", "node").join(groups, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("group_id")
    )
    groups = materialize(groups, "groups")
    named = drawn.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group_id", "doc_id"))
    return named.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document stays, with their columns."""
    gone = materialize(near_groups(docs, words, percent).filter("NOT kept").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    # The row is put aside as one column, so that none of its names can clash.
    aside = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return aside.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")
