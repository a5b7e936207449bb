"""SimHash near-duplicates: fingerprints, and links found by BK-trees over shards.

Fingerprints that can be near each other share at least one shard. The tree of a shard is
built where the shard's rows are and searched by the same rows: a tree for all fingerprints
grows with the corpus and is never broadcast. A shard above `PIECE` rows is cut into
pieces, and every pair of pieces is searched by itself: the tree of one, queried by the other.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import fresh, numbered, slices, stored
from areastats.llm.components import components

#: Rows of a shard whose tree is built and searched by one task; larger shards are cut.
PIECE = 2048
#: Shingles hashed and counted at a time.
BLOCK = 1 << 14


# ---- fingerprints -----------------------------------------------------------------------


def shingle_hashes(text: str, width: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of a text, in blocks, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_digest
    for at in range(0, n, BLOCK):
        spans = zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)
        yield np.frombuffer(b"".join([digest(joined[a:b], 42) for a, b in spans]), dtype=">u8")


def fingerprint(text: str, width: int) -> bytes:
    """64 bits: a bit is set where over half of the shingle hashes have it."""
    total, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width):
        total += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return np.packbits(2 * total > n).tobytes()


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, code): the 64-bit fingerprint of every whole text (null: empty; no word: zero)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                codes = pa.array([fingerprint(t, width) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), codes], ["doc_id", "code"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, code binary")


# ---- BK-tree ----------------------------------------------------------------------------


def hamming(codes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Differing bits along the last axis of arrays of 64-bit words."""
    return np.bitwise_count(codes ^ other).sum(axis=-1, dtype=np.int64)


class BKTree:
    """Codes in a tree whose children are keyed by their Hamming distance to the parent.

    Subtrees of up to `leaf` codes are kept as buckets. `within` sends a whole batch of queries
    down at once; a query follows an edge only if the edge is within the radius of its
    own distance to the parent (triangle inequality).
    """

    def __init__(self, codes: np.ndarray, leaf: int = 16):
        self.codes, self.leaf = codes, leaf
        self.nodes: list[tuple[int, list[tuple[int, int]], np.ndarray | None]] = []
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(codes)), -1, 0)]
        while todo:
            rows, parent, edge = todo.pop()
            own = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][1].append((edge, own))
            if len(rows) <= leaf:
                self.nodes.append((-1, [], rows))
                continue
            self.nodes.append((int(rows[0]), [], None))
            rest = rows[1:]
            apart = hamming(codes[rest], codes[rows[0]])
            order = np.argsort(apart, kind="stable")
            cuts = np.flatnonzero(np.diff(apart[order])) + 1
            todo += [(rest[g], own, int(apart[g[0]])) for g in np.split(order, cuts)]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, code rows) at a distance of at most `radius`."""
        todo = [(0, np.arange(len(queries)))] if self.nodes else []
        while todo:
            node, asked = todo.pop()
            pivot, edges, bucket = self.nodes[node]
            if bucket is not None:
                for at in range(0, len(asked), 4096):
                    some = asked[at : at + 4096]
                    q, c = np.nonzero(hamming(queries[some, None], self.codes[bucket][None]) <= radius)
                    yield some[q], bucket[c]
                continue
            apart = hamming(queries[asked], self.codes[pivot])
            hit = asked[apart <= radius]
            yield hit, np.full(len(hit), pivot)
            for edge, child in edges:
                follow = asked[np.abs(apart - edge) <= radius]
                if len(follow):
                    todo.append((child, follow))


def forest(reps: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the pairs (a, b): each linked rep with the smallest of its group."""
    if not len(a):
        return reps[:0], reps[:0]
    order = np.argsort(reps, kind="stable")
    label = np.empty(len(reps), np.int64)
    label[order] = np.arange(len(reps))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[order[new]])
        if np.array_equal(new, label):
            break
        label = new
    root = reps[order[label]]
    apart = root != reps
    return reps[apart], root[apart]


# ---- shards -----------------------------------------------------------------------------


def block_scheme(distinct: int, radius: int) -> tuple[int, int]:
    """(blocks, blocks that agree): of b blocks, b - radius agree in any pair within the radius.

    More blocks give more shards per code but longer keys; take the fewest whose shards hold
    some thousand codes on average.
    """
    for agree in range(1, 5):
        blocks = radius + agree
        if distinct >> (64 * agree // blocks) < PIECE:
            break
    return blocks, agree


def block_shards(codes: DataFrame, blocks: int, agree: int) -> DataFrame:
    """(shard, rep, code): one row per code and set of blocks that may agree."""
    value = F.conv(F.hex("code"), 16, 2)
    bits = F.lpad(value, 64, "0")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    piece = [F.substring(bits, a + 1, b - a) for a, b in itertools.pairwise(cuts)]
    sets = itertools.combinations(range(blocks), agree)
    shards = [F.concat(F.lit(f"{k}:"), *[piece[i] for i in chosen]) for k, chosen in enumerate(sets)]
    return codes.select(F.explode(F.array(*[F.xxhash64(s) for s in shards])).alias("shard"), "rep", "code")


def _tiles(rows: DataFrame, pieces, *more: str) -> DataFrame:
    """(shard, tile, tree, asks, rep, ...): rows of shards of several rows, once per pair of pieces.

    Each shard is cut into `pieces` (an aggregate); `code` and `more` are kept where there are such columns.
    """
    columns = ["rep", *[c for c in ("code", *more) if c in rows.columns]]
    sizes = rows.groupBy("shard").agg(F.count("*").alias("count"), pieces.cast("int").alias("pieces")).where("count > 1").select("shard", "pieces")
    cut = rows.join(sizes, "shard").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda p: F.struct(F.least(p, "own").alias("x"), F.greatest(p, "own").alias("y")))
    tiles = cut.select("shard", "own", *columns, F.explode(others).alias("t")).select("shard", "t.x", "t.y", "own", *columns)
    key = F.xxhash64("shard", "x", "y").alias("tile")
    return tiles.select("shard", key, (F.col("own") == F.col("x")).alias("tree"), (F.col("own") == F.col("y")).alias("asks"), *columns)


def shard_links(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b): spanning links of the codes of each shard that lie within the radius.

    `rows` (shard, rep, code) is a stored table. Shards of one row go; larger ones are
    searched by BK-tree, cut into pairs of pieces above PIECE rows.
    """
    ready = _tiles(rows, F.ceil(F.count("*") / PIECE))

    def search(tile: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(b"".join(tile["code"]), dtype=">u8").astype(np.uint64).reshape(len(tile), -1)
        reps = tile["rep"].to_numpy(np.int64)
        tree, asks = np.flatnonzero(tile["tree"].to_numpy(bool)), np.flatnonzero(tile["asks"].to_numpy(bool))
        label = [(reps[:0], reps[:0])]
        for q, c in BKTree(codes[tree]).within(codes[asks], radius):
            if len(q):
                label.append(forest(reps, asks[q], tree[c]))
        a, b = np.concatenate([x[0] for x in label]), np.concatenate([x[1] for x in label])
        at = np.argsort(reps, kind="stable")
        return forest(reps, at[np.searchsorted(reps[at], a)], at[np.searchsorted(reps[at], b)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tile in runs(frames, "tile"):
            a, b = search(tile)
            yield pd.DataFrame({"a": a, "b": b})

    sorted_rows = ready.repartition("tile").sortWithinPartitions("tile")
    return sorted_rows.mapInPandas(run, "a long, b long")


def runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Rows of equal key, from frames sorted by key; a run may go on in the next frame."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        keys = frame[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        parts = np.split(np.arange(len(frame)), cuts) if len(frame) else []
        for i, rows in enumerate(parts):
            part = frame.iloc[rows[0] : rows[-1] + 1]
            if rest and (i > 0 or rest[0][key].iloc[0] != part[key].iloc[0]):
                yield pd.concat(rest) if len(rest) > 1 else rest[0]
                rest = []
            rest.append(part)
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]


# ---- operators --------------------------------------------------------------------------


def _with_components(prints: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc_id, code, component_id) from the links between the groups of equal codes."""
    roots = components(links)
    of_code = stored(groups.join(roots, groups["rep"] == roots["node"], "left").select("code", F.coalesce("root", "rep").alias("component_id")), "components")
    return prints.join(of_code, "code").select("doc_id", "code", "component_id")


def _links(groups: DataFrame, radius: int) -> DataFrame:
    """Spanning links between the groups (code, rep) that lie within the radius."""
    named = groups.where("rep IS NOT NULL")
    blocks, agree = block_scheme(named.count(), radius)
    return shard_links(stored(block_shards(named, blocks, agree), "shards"), radius)


def simhash_components(
    docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint and component of every document; links at `radius` or fewer differing bits.

    One row (doc_id, fingerprint, component_id) per input row. Null and empty texts have the
    fingerprint zero and are linked like any other; rows without an id get the
    component of their fingerprint (null if no row with an id reaches it). Repeated rows give
    repeated results; other columns are ignored. Exact: every pair within the radius agrees in
    enough blocks to meet in a shard.
    """
    prints = stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    groups = stored(prints.groupBy("code").agg(F.min("doc_id").alias("rep")), "codes")
    found = _with_components(prints, _links(groups, radius), groups)
    return found.select("doc_id", F.lower(F.hex("code")).alias("fingerprint"), "component_id")


def deduplicate(
    docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keep one row of each group that `simhash_components` links, with all columns.

    The row with the smallest doc_id stays; of rows with equal ids that with the smallest fingerprint, then
    the first as stored. Rows without an id belong to groups like others and stay only where no row
    of the group has one. Null and empty texts are one group. Rows are told apart by a number of
    their own, so repeated ids and texts are no special case; texts are shuffled once, by it.
    """
    rows, number = numbered(docs, "documents")
    prints = stored(fingerprints(rows, width, number, text_col), "fingerprints")
    groups = stored(prints.groupBy("code").agg(F.min("doc_id").alias("rep")), "codes")
    found = _with_components(prints, _links(groups, radius), groups)
    ids = rows.select(F.col(number).alias("row"), F.col(id_col).cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "code", "row"))
    kept_row = fresh(rows, "kept_row")
    kept = found.join(ids, found["doc_id"] == ids["row"]).groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias(kept_row))
    return rows.join(stored(kept, "kept").hint("merge"), F.col(number) == F.col(kept_row), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
