"""Vectorised geometry on Arrow batches: the part of the predicates Spark has no built-in for.

The same formulas as array lambdas run interpreted, one boxed value at a time, and were
about a hundred times slower. A batch is processed in chunks of at most CHUNK
(point, edge) or (segment, edge) combinations, so memory does not follow shape sizes.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

CHUNK = 2_000_000
ON_BOUNDARY = 1e-6  # metres
SETTLED = 0.01  # metres: shorter pieces of an outline are not halved

EDGE_FIELDS = ("x1", "y1", "x2", "y2")
EDGES = ArrayType(StructType([StructField(f, DoubleType()) for f in EDGE_FIELDS]))


class _Lists:
    """Flat columns of a list<struct<double..>> array, with each row's start and length."""

    def __init__(self, array, fields=EDGE_FIELDS):
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        self.length = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        flat = array.flatten()
        names = [flat.type.field(i).name for i in range(flat.type.num_fields)]
        columns = dict(zip(names, flat.flatten()))
        self.columns = [columns[f].to_numpy(zero_copy_only=False) for f in fields]
        self.row = np.repeat(np.arange(len(self.length)), self.length)


def _doubles(array):
    return array.to_numpy(zero_copy_only=False).astype(float)


def _blocks(sizes):
    """Consecutive index ranges whose sizes add up to at most CHUNK (single items may exceed it)."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        yield first, last
        first = last


def _expand(items, rows, lists):
    """For items (with a row each): index of the item and of every entry of its row's list."""
    counts = lists.length[rows]
    item = np.repeat(items, counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return item, np.repeat(lists.start[rows], counts) + within


def _edge_distance2(px, py, x1, y1, x2, y2):
    dx, dy, ax, ay = x2 - x1, y2 - y1, px - x1, py - y1
    along, across, length2 = ax * dx + ay * dy, ax * dy - ay * dx, dx * dx + dy * dy
    bx, by = px - x2, py - y2
    middle = across * across / np.where(length2 == 0, 1.0, length2)
    return np.where(along <= 0, ax * ax + ay * ay, np.where(along >= length2, bx * bx + by * by, middle))


def _crosses_right(px, py, x1, y1, x2, y2):
    """The edge crosses the ray from the point to the right."""
    spans = (y1 > py) != (y2 > py)
    rise = np.where(spans, y2 - y1, 1.0)
    return spans & (px < x1 + (py - y1) * (x2 - x1) / rise)


def _signed(px, py, rows, edges):
    """Signed distance of points (each with a row) to their row's outline; NaN without edges."""
    out = np.full(len(px), np.nan)
    for a, b in _blocks(edges.length[rows]):
        ids = np.arange(a, b)[edges.length[rows[a:b]] > 0]
        if not len(ids):
            continue
        point, edge = _expand(ids, rows[ids], edges)
        shape = [c[edge] for c in edges.columns]
        x, y = px[point], py[point]
        first = np.cumsum(edges.length[rows[ids]]) - edges.length[rows[ids]]
        distance = np.sqrt(np.minimum.reduceat(_edge_distance2(x, y, *shape), first))
        odd = np.add.reduceat(_crosses_right(x, y, *shape).astype(np.int64), first) % 2 == 1
        out[ids] = np.where(odd, -distance, distance)
    return out


def _per_row(values, rows, n, reducer, empty):
    """Reduce values that are grouped by ascending row."""
    out = np.full(n, empty)
    if len(values):
        ids, first = np.unique(rows, return_index=True)
        out[ids] = reducer.reduceat(values, first)
    return out


def _pieces(segments, edges):
    """Segments of each row cut at that row's edges: x1, y1, x2, y2, row."""
    parts = []
    for a, b in _blocks(edges.length[segments.row]):
        ids = np.arange(a, b)
        seg, edge = _expand(ids, segments.row[a:b], edges)
        sx1, sy1, sx2, sy2 = (c[seg] for c in segments.columns)
        ex1, ey1, ex2, ey2 = (c[edge] for c in edges.columns)
        near = (
            (np.maximum(ex1, ex2) >= np.minimum(sx1, sx2) - ON_BOUNDARY)
            & (np.minimum(ex1, ex2) <= np.maximum(sx1, sx2) + ON_BOUNDARY)
            & (np.maximum(ey1, ey2) >= np.minimum(sy1, sy2) - ON_BOUNDARY)
            & (np.minimum(ey1, ey2) <= np.maximum(sy1, sy2) + ON_BOUNDARY)
        )
        seg = seg[near]
        sx1, sy1, sx, sy = sx1[near], sy1[near], (sx2 - sx1)[near], (sy2 - sy1)[near]
        ox, oy = ex1[near] - sx1, ey1[near] - sy1
        ex, ey = (ex2 - ex1)[near], (ey2 - ey1)[near]
        turn = sx * ey - sy * ex
        parallel = turn == 0
        safe = np.where(parallel, 1.0, turn)
        u, t = (ox * sy - oy * sx) / safe, (ox * ey - oy * ex) / safe
        hit = ~parallel & (u >= -1e-9) & (u <= 1 + 1e-9)
        # Along parallel edges both end points are cuts; superfluous cuts do no harm.
        length2 = np.where(sx * sx + sy * sy == 0, 1.0, sx * sx + sy * sy)
        head = (ox * sx + oy * sy) / length2
        tail = ((ox + ex) * sx + (oy + ey) * sy) / length2
        at = np.concatenate([t[hit], head[parallel], tail[parallel]])
        of = np.concatenate([seg[hit], seg[parallel], seg[parallel]])
        inner = (at > 0) & (at < 1)
        at = np.concatenate([at[inner], np.zeros(len(ids)), np.ones(len(ids))])
        of = np.concatenate([of[inner], ids, ids])
        order = np.lexsort((at, of))
        at, of = at[order], of[order]
        joined = (of[1:] == of[:-1]) & (at[1:] > at[:-1])
        s, low, high = of[:-1][joined], at[:-1][joined], at[1:][joined]
        x1, y1, x2, y2 = (c[s] for c in segments.columns)
        dx, dy = x2 - x1, y2 - y1
        parts.append((x1 + dx * low, y1 + dy * low, x1 + dx * high, y1 + dy * high, segments.row[s]))
    if not parts:
        return tuple(np.empty(0) for _ in range(4)) + (np.empty(0, dtype=np.int64),)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _relation(pieces, edges):
    """Per piece: its midpoint is inside, lies on an edge, lies on an edge that runs the same way."""
    x1, y1, x2, y2, rows = pieces
    n = len(rows)
    inside, touching, same = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    mx, my = (x1 + x2) / 2, (y1 + y2) / 2
    for a, b in _blocks(edges.length[rows]):
        ids = np.arange(a, b)[edges.length[rows[a:b]] > 0]
        if not len(ids):
            continue
        piece, edge = _expand(ids, rows[ids], edges)
        shape = [c[edge] for c in edges.columns]
        first = np.cumsum(edges.length[rows[ids]]) - edges.length[rows[ids]]
        px, py = mx[piece], my[piece]
        on = _edge_distance2(px, py, *shape) <= ON_BOUNDARY**2
        along = (x2 - x1)[piece] * (shape[2] - shape[0]) + (y2 - y1)[piece] * (shape[3] - shape[1])
        inside[ids] = np.add.reduceat(_crosses_right(px, py, *shape).astype(np.int64), first) % 2 == 1
        touching[ids] = np.logical_or.reduceat(on, first)
        same[ids] = np.logical_or.reduceat(on & (along > 0), first)
    return inside, touching, same


def _signed_distance(x: pa.Array, y: pa.Array, edges: pa.Array) -> pa.Array:
    lists = _Lists(edges)
    px, py = _doubles(x), _doubles(y)
    return pa.array(_signed(px, py, np.arange(len(px)), lists), from_pandas=True)


def _farthest(points: pa.Array, edges: pa.Array) -> pa.Array:
    spots, lists = _Lists(points, ("x", "y")), _Lists(edges)
    far = _signed(*spots.columns, spots.row, lists)
    return pa.array(_per_row(far, spots.row, len(spots.length), np.maximum, np.nan), from_pandas=True)


def _farthest_along(shape: pa.Array, edges: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Farthest point of a shape's outline, as exactly as is needed to know between which bounds it is.

    Along a metre the distance changes by a metre at most, so half of (the distances at both ends
    + the length) is an upper bound for a piece. Only pieces that may pass the next bound are halved,
    down to SETTLED metres.
    """
    parcel, area = _Lists(shape), _Lists(edges)
    rows, limits = parcel.row, np.append(np.sort(bounds), np.inf)
    ends = [*parcel.columns]
    near = [_signed(ends[0], ends[1], rows, area), _signed(ends[2], ends[3], rows, area)]
    far = _per_row(np.maximum(*near), rows, len(parcel.length), np.maximum, np.nan)
    while len(rows):
        length = np.hypot(ends[2] - ends[0], ends[3] - ends[1])
        limit = limits[np.searchsorted(limits[:-1], far[rows], side="left")]
        unsettled = ((near[0] + near[1] + length) / 2 > limit) & (length > SETTLED)
        rows, ends, near = rows[unsettled], [e[unsettled] for e in ends], [d[unsettled] for d in near]
        mx, my = (ends[0] + ends[2]) / 2, (ends[1] + ends[3]) / 2
        middle = _signed(mx, my, rows, area)
        np.maximum.at(far, rows, middle)
        halves = ((ends[0], mx), (ends[1], my), (mx, ends[2]), (my, ends[3]))
        ends = [np.concatenate(h) for h in halves]
        near = [np.concatenate([near[0], middle]), np.concatenate([middle, near[1]])]
        rows = np.concatenate([rows, rows])
    return pa.array(far, from_pandas=True)


def farthest_along(shape: Column, edges: Column, bounds: Sequence[float]) -> Column:
    limits = np.array(bounds, float)

    def along(shape: pa.Array, edges: pa.Array) -> pa.Array:
        return _farthest_along(shape, edges, limits)

    return arrow_udf(along, DoubleType())(shape, edges)


def _clipped_length(path: pa.Array, edges: pa.Array) -> pa.Array:
    segments, lists = _Lists(path), _Lists(edges)
    pieces = _pieces(segments, lists)
    inside, touching, _ = _relation(pieces, lists)
    x1, y1, x2, y2, rows = pieces
    length = np.where(inside | touching, np.hypot(x2 - x1, y2 - y1), 0.0)
    return pa.array(np.bincount(rows, weights=length, minlength=len(segments.length)))


def _overlap_area(a: pa.Array, b: pa.Array) -> pa.Array:
    """Half the cross-product sum over a's pieces inside b and b's pieces inside a; a shared
    edge counts once, from a, and only where both outlines run the same way."""
    one, two = _Lists(a), _Lists(b)
    n = len(one.length)
    total = np.zeros(n)
    some = (one.length > 0) & (two.length > 0)
    ox, oy = np.zeros(n), np.zeros(n)
    ox[some], oy[some] = two.columns[0][two.start[some]], two.columns[1][two.start[some]]
    for segments, other, first in ((one, two, True), (two, one, False)):
        pieces = _pieces(segments, other)
        inside, touching, same = _relation(pieces, other)
        keep = np.where(touching, same, inside) if first else inside & ~touching
        x1, y1, x2, y2, rows = (p[keep] for p in pieces)
        cross = (x1 - ox[rows]) * (y2 - oy[rows]) - (x2 - ox[rows]) * (y1 - oy[rows])
        total += np.bincount(rows, weights=cross, minlength=n)
    return pa.array(np.maximum(total / 2, 0.0))


def _leaves(shape: pa.Array, edges: pa.Array) -> pa.Array:
    """An edge of the area crosses the shape's outline, or a corner of the area is strictly
    inside the shape: the shape is not within the area although its corners are."""
    parcel, area = _Lists(shape), _Lists(edges)
    out = np.zeros(len(parcel.length), bool)
    asked = parcel.length[area.row] > 0
    rows = area.row[asked]
    depth = _signed(area.columns[0][asked], area.columns[1][asked], rows, parcel)
    out[rows[depth < -ON_BOUNDARY]] = True
    pieces = _pieces(parcel, area)
    inside, touching, _ = _relation(pieces, area)
    out[pieces[4][~(inside | touching)]] = True
    return pa.array(out)


def _path_parity(px, py, rx, ry, x1, y1, x2, y2):
    """Whether an edge is crossed on the way from (rx, ry) along y, then along x to (px, py).

    The same as if both points lay a hair to the right and a far smaller hair up, which is also
    what `_crosses_right` does; so an edge through a point is on the same side for all paths.
    """
    tall = (x1 > rx) != (x2 > rx)
    run = np.where(tall, x2 - x1, 1.0)
    rise = (y2 - y1) / run
    yc = y1 + (rx - x1) * rise
    above = lambda y: (yc > y) | ((yc == y) & (rise > 0))
    up = tall & (above(ry) != above(py))
    wide = (y1 > py) != (y2 > py)
    xc = x1 + (py - y1) * (x2 - x1) / np.where(wide, y2 - y1, 1.0)
    return up ^ (wide & ((rx < xc) != (px < xc)))


def _measured_from(px, py, rows, edges, rx, ry, inside):
    """(distance to the edges of each point's row, inside); rx, ry, inside belong to the points. inf without edges."""
    distance, within = np.full(len(px), np.inf), inside.copy()
    for a, b in _blocks(edges.length[rows]):
        ids = np.arange(a, b)[edges.length[rows[a:b]] > 0]
        if not len(ids):
            continue
        point, edge = _expand(ids, rows[ids], edges)
        shape = [c[edge] for c in edges.columns]
        x, y = px[point], py[point]
        first = np.cumsum(edges.length[rows[ids]]) - edges.length[rows[ids]]
        distance[ids] = np.sqrt(np.minimum.reduceat(_edge_distance2(x, y, *shape), first))
        odd = np.add.reduceat(_path_parity(x, y, rx[point], ry[point], *shape).astype(np.int64), first) % 2 == 1
        within[ids] ^= odd
    return distance, within


def _flags(array):
    return array.to_numpy(zero_copy_only=False).astype(bool)


def _edge_lists(counts, columns):
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(c) for c in columns], names=list(EDGE_FIELDS)))


MEASURED = StructType([StructField("s", DoubleType()), StructField("inside", BooleanType()), StructField("near", EDGES)])


def _edges_of_tiles(px, py, half, s, rows, ids, edges):
    """Lists of the edges that points of the tiles `ids` need, empty for other tiles."""
    counts, columns = np.zeros(len(px), np.int64), []
    for a, b in _blocks(edges.length[rows[ids]]):
        point, edge = _expand(ids[a:b], rows[ids[a:b]], edges)
        shape = [c[edge] for c in edges.columns]
        keep = _edge_distance2(px[point], py[point], *shape) <= (np.abs(s[point]) + 2 * half[point] + ON_BOUNDARY) ** 2
        counts += np.bincount(point[keep], minlength=len(px))
        columns.append([c[keep] for c in shape])
    return _edge_lists(counts, [np.concatenate(c) for c in zip(*columns)] if columns else [np.empty(0)] * 4)


def _like(lists, values):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lists.length)]).astype(np.int32)), values)


def _tile_edges(tiles: pa.Array, near: pa.Array) -> pa.Array:
    spots, edges = _Lists(tiles, ("cx", "cy", "half", "s")), _Lists(near)
    return _like(spots, _edges_of_tiles(*spots.columns, spots.row, np.flatnonzero(np.isfinite(spots.columns[3])), edges))


def measured_tiles(
    tiles: Column, near: Column, rx: Column, ry: Column, inside: Column, box: Sequence[Column], distances: Sequence[float], reach: float
) -> Column:
    """For each tile (cx, cy, half) of a block: signed distance of its centre, whether that is inside, and, where the
    tile's points may differ in the smallest of `distances` that holds them, the edges they need.

    `box` is the area's; tiles farther than `reach` from it are not measured (infinite).
    """
    limits = np.array(distances, float)

    def measured(
        tiles: pa.Array, near: pa.Array, rx: pa.Array, ry: pa.Array, inside: pa.Array, minx: pa.Array, miny: pa.Array, maxx: pa.Array, maxy: pa.Array
    ) -> pa.Array:
        spots, edges = _Lists(tiles, ("cx", "cy", "half")), _Lists(near)
        px, py, half = spots.columns
        rows = spots.row
        gx = np.maximum(np.maximum(_doubles(minx)[rows] - px, px - _doubles(maxx)[rows]), 0)
        gy = np.maximum(np.maximum(_doubles(miny)[rows] - py, py - _doubles(maxy)[rows]), 0)
        asked = np.flatnonzero(np.hypot(gx, gy) <= reach + half)
        s, within = np.full(len(px), np.inf), np.zeros(len(px), bool)
        of = rows[asked]
        d, w = _measured_from(px[asked], py[asked], of, edges, _doubles(rx)[of], _doubles(ry)[of], _flags(inside)[of])
        s[asked], within[asked] = np.where(w, -d, d), w
        low = np.searchsorted(limits, s - half, side="right")
        open_ = np.flatnonzero((low < len(limits)) & (low != np.searchsorted(limits, s + half, side="right")))
        nearby = _edges_of_tiles(px, py, half, s, rows, open_, edges)
        return _like(spots, pa.StructArray.from_arrays([pa.array(s), pa.array(within), nearby], names=["s", "inside", "near"]))

    return arrow_udf(measured, ArrayType(MEASURED))(tiles, near, rx, ry, inside, *box)


def _signed_from(x: pa.Array, y: pa.Array, edges: pa.Array, rx: pa.Array, ry: pa.Array, inside: pa.Array) -> pa.Array:
    lists, px = _Lists(edges), _doubles(x)
    d, within = _measured_from(px, _doubles(y), np.arange(len(px)), lists, _doubles(rx), _doubles(ry), _flags(inside))
    return pa.array(np.where(np.isinf(d), np.nan, np.where(within, -d, d)), from_pandas=True)


def _ordered_bits(values: pa.Array) -> pa.Array:
    """The 64 bits of a double as a long in the order of the values; both zeros give 0."""
    x = _doubles(values)
    bits = x.view(np.int64) & np.int64(2**63 - 1)
    return pa.array(np.where(x < 0, -bits, bits))


# Pickle these functions by value, so that workers need no copy of this package.
def _by_value():
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_by_value()

signed_distance = arrow_udf(_signed_distance, DoubleType())
farthest = arrow_udf(_farthest, DoubleType())
signed_from = arrow_udf(_signed_from, DoubleType())
tile_edges = arrow_udf(_tile_edges, ArrayType(EDGES))
clipped_length = arrow_udf(_clipped_length, DoubleType())
overlap_area = arrow_udf(_overlap_area, DoubleType())
leaves = arrow_udf(_leaves, BooleanType())
ordered_bits = arrow_udf(_ordered_bits, LongType())
