"""Embedding near-duplicates: tiles compared in the order of the principal components.

Vectors are turned into a basis that is fitted on a bounded sample and has the components with most
variance first; this changes no cosine. Rows are dealt to tiles by cuts along the leading
components, tiles whose boxes are too far apart are never compared, and within a pair of tiles
the leading products and the norms of what is left settle most pairs.
"""

import hashlib
import io
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import bounded_sample, filesystem, shared_folder, stored
from areastats.llm.components import components
from areastats.llm.simhash import forest

#: Vectors that fit the basis and the cuts; rows of a tile; tiles at most (where a tile gets more rows,
#: it is cut into pieces of about so many).
SAMPLE, TILE_ROWS, MAX_TILES = 16_384, 2048, 2048
#: Components in a tile's box; components of each step of a comparison; rows of a block.
BOX, STEPS, BLOCK = 8, (12, 32), 1024
#: Cosines this near to the threshold are computed anew from the vectors as given.
DOUBT = 1e-9


def _keyed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, key, size, vector): the key is the digest of a usable vector, else null.

    Vectors are scaled by a power of two to a largest component between 0.5 and 1: no cosine changes,
    and no product of tiny or huge components leaves the range of doubles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, kept = [], [], []
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                values = v.as_py()
                a = np.array(values if values is not None and None not in values else [np.nan], np.float64) + 0.0
                usable = vec_id is not None and len(a) > 0 and bool(np.isfinite(a).all()) and bool(a.any())
                if usable:
                    a = np.ldexp(a, -np.frexp(np.abs(a).max())[1])
                keys.append(hashlib.blake2b(a.tobytes(), digest_size=16).digest() if usable else None)
                sizes.append(len(a) if usable else None)
                kept.append(a.tobytes() if usable else None)
            columns = [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "key", "size", "vector"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "vec_id long, key binary, size int, vector binary")


def basis(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns, the directions with the largest second moments first."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1].copy()


def cuts(points: np.ndarray, tiles: int) -> list[tuple[int, float, int, int]]:
    """A tree of halvings along the widest leading component: (component, bound, low, high).

    Children >= 0 are nodes, others are tiles (-1 - tile).
    """
    nodes: list[tuple[int, float, int, int]] = []
    todo, made = [(np.arange(len(points)), tiles, -1, False)], 0
    while todo:
        rows, share, parent, high = todo.pop()
        part = points[rows, :BOX]
        own = None
        if share > 1 and len(rows) > 1:
            f = int(np.argmax(part.var(axis=0)))
            bound = float(np.quantile(part[:, f], (share // 2) / share))
            low = part[:, f] < bound
            if 0 < low.sum() < len(rows):
                own = len(nodes)
                nodes.append((f, bound, 0, 0))
                todo += [(rows[low], share // 2, own, False), (rows[~low], share - share // 2, own, True)]
        if own is None:
            own, made = -1 - made, made + 1
        if parent >= 0:
            f, bound, a, b = nodes[parent]
            nodes[parent] = (f, bound, a, own) if high else (f, bound, own, b)
    return nodes


def tile_of(nodes: list[tuple[int, float, int, int]], points: np.ndarray) -> np.ndarray:
    tile = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        node, rows = todo.pop()
        f, bound, low, high = nodes[node]
        under = points[rows, f] < bound
        for child, part in ((low, rows[under]), (high, rows[~under])):
            if child < 0:
                tile[part] = -1 - child
            elif len(part):
                todo.append((child, part))
    return tile


class Tile:
    """Vectors of a tile with their unit forms in the basis and the norms of their suffixes."""

    def __init__(self, reps: np.ndarray, copies: np.ndarray, raw: np.ndarray, turn: np.ndarray):
        self.reps, self.copies, self.raw = reps, copies, raw
        self.norms = np.sqrt((raw * raw).sum(axis=1))
        self.turned = (raw / self.norms[:, None]) @ turn
        squares = self.turned**2
        self.rest = [np.sqrt(squares[:, k:].sum(axis=1)) for k in STEPS]


def near_pairs(a: Tile, b: Tile, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (of a, of b) with a cosine of at least the threshold; each pair once within one tile."""
    first, second = STEPS
    least = threshold - DOUBT
    for at in range(0, len(a.reps), BLOCK):
        for bt in range(at if same else 0, len(b.reps), BLOCK):
            i, j = slice(at, at + BLOCK), slice(bt, bt + BLOCK)
            dots = a.turned[i, :first] @ b.turned[j, :first].T
            open_ = dots + a.rest[0][i, None] * b.rest[0][None, j] >= least
            if same and at == bt:
                open_ = np.triu(open_, 1)
            p, q = np.nonzero(open_)
            if len(p) > 0.2 * dots.size:  # too many for pairwise work
                full = (a.turned[i] @ b.turned[j].T)[p, q]
            else:
                full = dots[p, q]
                for start, end, rest in ((first, second, 1), (second, None, None)):
                    full = full + np.concatenate(
                        [np.einsum("ij,ij->i", a.turned[i, start:end][p[c : c + 65536]], b.turned[j, start:end][q[c : c + 65536]]) for c in range(0, len(p), 65536)] or [full[:0]]
                    )
                    if rest is not None:
                        alive = full + a.rest[rest][i][p] * b.rest[rest][j][q] >= least
                        p, q, full = p[alive], q[alive], full[alive]
            hit = full >= least
            p, q, full = p[hit] + at, q[hit] + bt, full[hit]
            doubt = np.flatnonzero(full <= threshold + DOUBT)
            if len(doubt):
                x, y = p[doubt], q[doubt]
                exact = np.array([float(np.dot(a.raw[m], b.raw[n])) / (a.norms[m] * b.norms[n]) for m, n in zip(x, y, strict=True)])
                keep = np.ones(len(p), bool)
                keep[doubt[exact < threshold]] = False
                p, q = p[keep], q[keep]
            if len(p):
                yield p, q


def linked(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector; links are cosines of at least `threshold`.

    Vectors that are null, empty, zero or hold a null or non-finite component, and vectors without an id
    link with nothing; others are compared with all of their length, whatever their magnitude. Vectors that are equal
    up to a power of two are compared once and counted as often as they come; links are counted and chained
    where they are found, so no table of pairs arises. Tiles are files in the shared folder; a task
    holds two of them. An empty table gives no rows, further columns are ignored.
    """
    rows = stored(_keyed(vectors, id_col, vector_col), "vectors")
    groups = stored(
        rows.where("key IS NOT NULL").groupBy("size", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "distinct",
    )
    sizes = {r[0]: r[1] for r in groups.groupBy("size").count().collect()}  # one row for each length
    found = [_linked_of(groups.where(F.col("size") == size), size, sizes[size], threshold, tile_rows) for size in sorted(sizes)]
    if found:
        links = stored(reduce(DataFrame.unionAll, found), "all_links")
    else:
        links = vectors.sparkSession.createDataFrame([], "rep long, links long, root long")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(links.where("root IS NOT NULL").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_key = stored(
        groups.select("size", "key", "rep", "copies").join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
        .select("size", "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")),
        "components",
    )
    result = rows.select("vec_id", "size", "key").join(of_key, ["size", "key"], "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _linked_of(groups: DataFrame, size: int, total: int, threshold: float, tile_rows: int) -> DataFrame:
    """(rep, links, root): linked copies and spanning links of the distinct vectors of one length."""
    chosen = bounded_sample(groups, "key", SAMPLE).select("vector").collect()
    sample = np.array([np.frombuffer(r[0]) for r in sorted(chosen)]).reshape(len(chosen), size)
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    turn = basis(sample) if len(sample) else np.eye(size)
    nodes = cuts(sample @ turn, min(MAX_TILES, -(-total // tile_rows)))
    spark = groups.sparkSession
    folder = shared_folder(spark, "tiles")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("vector").to_pylist())).reshape(-1, size)
            points = (raw / np.linalg.norm(raw, axis=1, keepdims=True)) @ turn[:, :BOX]
            columns = [pa.array(tile_of(nodes, points)), batch.column("rep"), batch.column("copies"), batch.column("vector")]
            yield pa.RecordBatch.from_arrays(columns, ["tile", "rep", "copies", "vector"])

    def write(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("rep")
        raw = np.frombuffer(b"".join(tile["vector"])).reshape(len(tile), -1)
        points = (raw / np.linalg.norm(raw, axis=1, keepdims=True)) @ turn[:, :BOX]
        name = f"tile-{tile['tile'].iloc[0]}-{uuid.uuid4().hex}.npz"  # a repeated attempt writes its own file
        fs, path = filesystem(folder)
        fs.create_dir(path)
        data = io.BytesIO()
        np.savez(data, reps=tile["rep"].to_numpy(), copies=tile["copies"].to_numpy(), raw=raw)
        with fs.open_output_stream(f"{path}/{name}") as out:
            out.write(data.getvalue())
        return pd.DataFrame({"name": [name], "low": [points.min(axis=0).tolist()], "high": [points.max(axis=0).tolist()]})

    dealt = stored(groups.select("rep", "copies", "vector").mapInArrow(deal, "tile long, rep long, copies long, vector binary"), "dealt")
    pieces = dealt.groupBy("tile").agg(F.ceil(F.count("*") / tile_rows).alias("pieces"))  # at most MAX_TILES rows
    cut = dealt.join(pieces, "tile").withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces"))).drop("pieces")
    tiles = stored(cut.groupBy("tile", "piece").applyInPandas(write, "name string, low array<double>, high array<double>"), "tiles")
    listed = sorted(map(tuple, tiles.collect()))  # one box for each tile_rows vectors
    names = [t[0] for t in listed]
    work = _tile_pairs(np.array([t[1] for t in listed]), np.array([t[2] for t in listed]), threshold)

    def load(name: str) -> Tile:
        fs, path = filesystem(folder)
        with fs.open_input_file(f"{path}/{name}") as f, np.load(io.BytesIO(f.read())) as d:
            return Tile(d["reps"], d["copies"], d["raw"], turn)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, others in zip(frame["first"], frame["others"], strict=True):
                a = load(names[first])
                for other in others:
                    b = a if other == first else load(names[other])
                    yield _links(a, b, threshold, other == first)

    jobs = spark.createDataFrame(work, "first int, others array<int>").repartition(max(1, min(len(work), 4 * spark.sparkContext.defaultParallelism)))
    return stored(jobs.mapInPandas(compare, "rep long, links long, root long"), "links")


def _tile_pairs(low: np.ndarray, high: np.ndarray, threshold: float) -> list[tuple[int, list[int]]]:
    """Pairs of tiles whose boxes are near enough: unit vectors with this cosine are at most
    sqrt(2 - 2 cosine) apart. At most some 20,000 rows (tile, other tiles)."""
    near = []
    for k in range(len(low)):
        gap = np.maximum(0, np.maximum(low[k] - high[k:], low[k:] - high[k]))
        near.append((np.flatnonzero((gap**2).sum(axis=1) <= 2 - 2 * threshold + DOUBT) + k).tolist())
    chunk = max(4, sum(map(len, near)) // 20_000 + 1)
    return [(k, others[c : c + chunk]) for k, others in enumerate(near) for c in range(0, len(others), chunk)]


def _links(a: Tile, b: Tile, threshold: float, same: bool) -> pd.DataFrame:
    """Linked copies and spanning links of the rows of two tiles."""
    of_a, of_b = np.zeros(len(a.reps), np.int64), np.zeros(len(b.reps), np.int64)
    reps = a.reps if same else np.concatenate([a.reps, b.reps])
    shift = 0 if same else len(a.reps)
    child, root = [], []
    for p, q in near_pairs(a, b, threshold, same):
        of_a += np.bincount(p, b.copies[q], len(of_a)).astype(np.int64)
        of_b += np.bincount(q, a.copies[p], len(of_b)).astype(np.int64)
        x, y = forest(reps, p, q + shift)
        child.append(x)
        root.append(y)
    links = of_a + of_b if same else np.concatenate([of_a, of_b])
    order = np.argsort(reps, kind="stable")
    at = lambda ids: order[np.searchsorted(reps[order], ids)]
    if child:
        x, y = forest(reps, at(np.concatenate(child)), at(np.concatenate(root)))
    else:
        x, y = reps[:0], reps[:0]
    some = links > 0
    counted = pd.DataFrame({"rep": reps[some], "links": links[some], "root": pd.array([None] * int(some.sum()), dtype="Int64")})
    chained = pd.DataFrame({"rep": x, "links": np.zeros(len(x), np.int64), "root": pd.array(y, dtype="Int64")})
    return pd.concat([counted, chained])
