"""Numpy tile kernels run inside Arrow tasks (``mapInArrow`` / ``applyInArrow``).

Spark partitions and shuffles the tiles; each function here only handles the tiles of
one Arrow batch or one planned group, so its memory is bounded by the tile size and
the group budget, never by the matrix.

Tiles are column-major: the buffer of an ``h x w`` tile reshaped in C order to
``(w, h)`` is the transpose, a free view.  Since (AB)ᵀ = BᵀAᵀ, a product can be formed
on those views and written back with a C-order ravel, with no copies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Ship these kernels to Python workers by value, so executors need no copy of the
# package on their path.
try:  # pragma: no cover - depends on the bundled cloudpickle
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass


def list_parts(arr) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, offsets) of an Arrow list<double> column; NULL rows get length 0."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    offs = arr.offsets.to_numpy()
    flat = arr.values.to_numpy(zero_copy_only=False)
    return flat, offs


def to_list_array(chunks: list[np.ndarray]) -> pa.Array:
    lengths = np.fromiter((c.size for c in chunks), dtype=np.int64, count=len(chunks))
    offsets = np.zeros(len(chunks) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    flat = np.concatenate(chunks) if chunks else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()),
                                    pa.array(flat, type=pa.float64()))


def tile_batch(keys: dict[str, list], hs: list[int], ws: list[int],
               data: list[np.ndarray]) -> pa.RecordBatch:
    cols = {k: pa.array(v, type=pa.int64()) for k, v in keys.items()}
    cols["h"] = pa.array(hs, type=pa.int32())
    cols["w"] = pa.array(ws, type=pa.int32())
    cols["data"] = to_list_array(data)
    return pa.RecordBatch.from_pydict(cols)


class TileReader:
    """The tiles of an Arrow batch with columns h, w, data and, if there, ``flip`` (data is
    of the transposed tile) and ``pos`` (places of the values of a sparse tile, null for a
    full one)."""

    def __init__(self, b: pa.RecordBatch):
        names = b.schema.names
        self.rows = b.num_rows
        self.h, self.w = (b.column(n).to_numpy(zero_copy_only=False) for n in ("h", "w"))
        self.flip = b.column("flip").to_numpy(zero_copy_only=False) if "flip" in names else np.zeros(self.rows, bool)
        self.flat, self.offs = list_parts(b.column("data"))
        self.full = np.ones(self.rows, bool)
        if "pos" in names:
            self.full = b.column("pos").is_null().to_numpy(zero_copy_only=False)
            self.pflat, self.poffs = list_parts(b.column("pos"))

    def sparse(self, r: int):
        """(rows, columns, values) of a sparse tile, None for a full one."""
        if self.full[r]:
            return None
        pos = self.pflat[self.poffs[r]:self.poffs[r + 1]]
        vals = self.flat[self.offs[r]:self.offs[r + 1]]
        if self.flip[r]:
            return pos // int(self.w[r]), pos % int(self.w[r]), vals
        return pos % int(self.h[r]), pos // int(self.h[r]), vals

    def values(self, rows: np.ndarray):
        """Of many sparse tiles: the place in ``rows`` of each value, and (rows, columns, values)."""
        n = (self.offs[1:] - self.offs[:-1])[rows].astype(np.int64)
        which = np.repeat(np.arange(rows.size), n)
        if not rows.size:
            return which, (which, which, np.zeros(0))
        nth = np.arange(which.size) - np.repeat(np.cumsum(n) - n, n)
        pos = self.pflat[self.poffs[:-1][rows][which] + nth]
        by = np.where(self.flip[rows], self.w[rows], self.h[rows])[which]
        flip = self.flip[rows][which]
        low, high = pos % by, pos // by
        return which, (np.where(flip, high, low), np.where(flip, low, high),
                       self.flat[self.offs[:-1][rows][which] + nth])

    def block(self, rows: np.ndarray, h: int, w: int) -> np.ndarray:
        """Many tiles of one size, as they are stored: an array (tile, column, row)."""
        if rows.size and self.full[rows].all() and not self.flip[rows].any():
            at = self.offs[rows[0]]
            if (np.diff(rows) == 1).all():
                return self.flat[at:at + rows.size * h * w].reshape(rows.size, w, h)
        return np.stack([self.view(r).T for r in rows.tolist()])

    def view(self, r: int) -> np.ndarray:
        """The tile as an ``h x w`` array (of a full tile, a view of the batch)."""
        h, w, got = int(self.h[r]), int(self.w[r]), self.sparse(r)
        if got is None:
            return _tile_view(self.flat, self.offs, r, h, w, bool(self.flip[r]))
        out = np.zeros((h, w), order="F")
        out[got[0], got[1]] = got[2]
        return out


# --------------------------------------------------------------------------- scatter
#: Values of the dense tiles that are written at once.
CHUNK = 1 << 21


def then(first, second):
    """Two kernels as one: what the first yields does not leave the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return second(first(batches))
    return run


def list_array(flat: np.ndarray, lengths: np.ndarray, none: np.ndarray | None = None) -> pa.Array:
    """A list column of consecutive pieces of ``flat``; rows of ``none`` (of length 0) are null."""
    offs = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    mask = None if none is None or not none.any() else pa.array(none)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat), mask=mask)


def spans(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to at most ``most`` (a row at least)."""
    ends, at = np.cumsum(sizes), 0
    while at < ends.size:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


def cell_runs(batches: Iterator[pa.RecordBatch]):
    """Cells ``(bi, bj, h, w, p, v)`` sorted by tile -> whole tiles, as many at a time as a batch
    ends: (their bi, bj, h, w and number of cells, and the places and values of all cells).

    What is left of a batch waits for the rest of its tile; equal places are summed when
    that is more than a tile can hold."""
    key, held, n = None, [], 0
    for b in batches:
        if not b.num_rows:
            continue
        bi, bj, h, w, p, v = (b.column(c).to_numpy(zero_copy_only=False) for c in ("bi", "bj", "h", "w", "p", "v"))
        starts = np.flatnonzero(np.concatenate([[True], (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])]))
        if starts.size == 1 and key is not None and (int(bi[0]), int(bj[0])) == key[:2]:
            held.append((p, v))  # one tile goes on
            n += p.size
        else:
            tiles = [x[starts] for x in (bi, bj, h, w)]
            sizes = np.diff(np.append(starts, p.size))
            if key is not None:
                p, v = (np.concatenate(x) for x in zip(*held, (p, v)))
                if (int(bi[0]), int(bj[0])) == key[:2]:
                    sizes[0] += n
                else:
                    tiles = [np.insert(x, 0, y) for x, y in zip(tiles, key)]
                    sizes = np.insert(sizes, 0, n)
            last = p.size - int(sizes[-1])
            if sizes.size > 1:
                yield *(x[:-1] for x in tiles), sizes[:-1], p[:last], v[:last]
            key, n = tuple(int(x[-1]) for x in tiles), int(sizes[-1])
            held = [(p[last:], v[last:])]
        if n > 2 * max(key[2] * key[3], CHUNK):
            p, v = (np.concatenate(x) for x in zip(*held))
            at, to = np.unique(p, return_inverse=True)
            held, n = [(at, np.bincount(to, v, at.size))], at.size
    if key is not None:
        yield *(np.array([x]) for x in key), np.array([n]), *(np.concatenate(x) for x in zip(*held))


def scatter_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells ``(bi, bj, h, w, p, v)`` sorted by tile -> dense column-major tiles, many at once.

    Memory: a batch of cells, the cells of one tile and ``CHUNK`` values of tiles.  Duplicate
    positions are summed."""
    for bi, bj, h, w, sizes, p, v in cell_runs(batches):
        area = h.astype(np.int64) * w
        if (area <= 0).any() or ((p < 0) | (p >= np.repeat(area, sizes))).any():
            raise IndexError("a cell lies outside its tile")
        ends = np.cumsum(sizes)
        for at, to in spans(area, CHUNK):
            first = ends[at - 1] if at else 0
            offs = np.cumsum(area[at:to]) - area[at:to]
            total = int(area[at:to].sum())
            where = np.repeat(offs, sizes[at:to]) + p[first:ends[to - 1]]
            flat = np.bincount(where, v[first:ends[to - 1]], total)
            yield pa.RecordBatch.from_pydict({
                "bi": pa.array(bi[at:to], pa.int64()), "bj": pa.array(bj[at:to], pa.int64()),
                "h": pa.array(h[at:to].astype(np.int32)), "w": pa.array(w[at:to].astype(np.int32)),
                "data": list_array(flat, area[at:to])})


# ----------------------------------------------------------------------------- GEMM
def task_id() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def sum_tiles_part(step: int):
    """Partial tiles of one output tile from the tasks of one range of ``step`` -> their sum,
    which stands for the first of these tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None

        def seen():
            nonlocal first
            for b in batches:
                if b.num_rows and first is None:
                    first = b.column("part")[0].as_py() // step * step
                yield b
        for out in sum_tiles_group(seen()):
            yield out.append_column("part", pa.array([first], pa.int32()))
    return run


def sum_tiles_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All partial tiles of one output tile -> their sum (streamed, one buffer)."""
    total = None
    key = None
    for b in batches:
        if b.num_rows == 0:
            continue
        flat, offs = list_parts(b.column("data"))
        if total is None:
            key = (b.column("bi")[0].as_py(), b.column("bj")[0].as_py(),
                   b.column("h")[0].as_py(), b.column("w")[0].as_py())
            total = np.zeros(key[2] * key[3])
        for r in range(b.num_rows):
            total += flat[offs[r]:offs[r + 1]]
    if total is not None:
        bi, bj, h, w = key
        yield tile_batch({"bi": [bi], "bj": [bj]}, [h], [w], [total])


#: Rows that the product kernel reads: one tile of A (side 0) or B (side 1) for a group.
#: ``r`` is its row (A) or column (B) in the tile grid of the product, ``k`` the inner index,
#: ``flip`` tells that ``data`` holds the transposed tile, ``pos`` the places of its values if
#: the tile is sparse.
PRODUCT_ROWS = ["_gid", "k", "side", "r", "h", "w", "flip", "data", "pos"]


def _tile_view(flat, offs, row: int, h: int, w: int, flip: bool) -> np.ndarray:
    """An ``h x w`` view of a column-major tile, or of one stored transposed."""
    x = flat[offs[row]:offs[row + 1]]
    return x.reshape(h, w) if flip else x.reshape(w, h).T


def partial_product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stream_product`` of a part of the inner index: its tiles name the task they are from."""
    for out in stream_product(batches):
        yield out.append_column("part", pa.array([task_id()] * out.num_rows, pa.int32()))


#: Bytes of products of thin tiles that wait to be added up.
PENDING_BYTES = 32 << 20


def stream_product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tile product over rows sorted by (group, k): C tiles of one group stay in memory and
    the inner index streams by.  At each k the present A tiles are stacked, the present B
    tiles are set side by side, and one GEMM adds to every C tile whose pair is present: an
    absent tile is never multiplied, whatever the plan.  Thin A tiles (at most an eighth of the
    places stored) are not written out: the rows of B that their values meet are scaled, and
    added up for many tiles and inner indices at once; where a value is not finite, the zeros of
    the tile count and it is multiplied as a dense one.  Memory: the C tiles of a group, the
    tiles of one inner index and ``PENDING_BYTES``.
    """
    state = {"gid": None, "k": None, "pending": 0}
    c: dict[tuple[int, int], np.ndarray] = {}
    a: dict[int, np.ndarray] = {}
    b: dict[int, np.ndarray] = {}
    thin: list[tuple] = []
    pending: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def scale():
        """Products of the thin tiles of one inner index."""
        values = np.concatenate([t[4] for t in thin])
        if not (np.isfinite(values).all() and all(np.isfinite(x).all() for x in b.values())):
            for r, h, i, j, v, w in thin:
                a[r] = np.zeros((h, w))
                a[r][i, j] = v
            return
        at = np.concatenate([t[2] for t in thin]) + np.repeat(
            np.array([t[0] for t in thin], np.int64) << 32, [t[4].size for t in thin])
        inner = np.concatenate([t[3] for t in thin])
        for q, x in b.items():
            for t in thin:
                if (t[0], q) not in c:
                    c[t[0], q] = np.zeros((t[1], x.shape[1]))
            step = max(1, PENDING_BYTES // (8 * x.shape[1]))
            for lo in range(0, at.size, step):
                part = values[lo:lo + step, None] * x[inner[lo:lo + step]]
                pending.setdefault(q, []).append((at[lo:lo + step], part))
                state["pending"] += part.nbytes
                if state["pending"] > PENDING_BYTES:
                    settle()

    def settle():
        for q, parts in pending.items():
            at, x = (np.concatenate(y) for y in zip(*parts))
            order = np.argsort(at, kind="stable")
            at, x = at[order], x[order]
            starts = np.flatnonzero(np.concatenate([[True], np.diff(at) != 0])) if at.size else np.zeros(0, int)
            if not starts.size:
                continue
            rows, sums = at[starts], np.add.reduceat(x, starts, axis=0)
            first = np.flatnonzero(np.concatenate([[True], np.diff(rows >> 32) != 0]))
            for lo, hi in zip(first.tolist(), np.append(first[1:], rows.size).tolist()):
                c[int(rows[lo] >> 32), q][rows[lo:hi] & 0xFFFFFFFF] += sums[lo:hi]
        pending.clear()
        state["pending"] = 0

    def multiply():
        if thin and b:
            scale()
        if a and b:
            rows, cols = sorted(a), sorted(b)
            top = np.concatenate([[0], np.cumsum([a[r].shape[0] for r in rows])])
            left = np.concatenate([[0], np.cumsum([b[q].shape[1] for q in cols])])
            prod = np.vstack([a[r] for r in rows]) @ np.hstack([b[q] for q in cols])
            for m, r in enumerate(rows):
                for n, q in enumerate(cols):
                    part = prod[top[m]:top[m + 1], left[n]:left[n + 1]]
                    if (r, q) in c:
                        c[r, q] += part
                    else:
                        c[r, q] = part.copy()
        a.clear()
        b.clear()
        thin.clear()

    def finished():
        multiply()
        settle()
        for (r, q), x in sorted(c.items()):
            yield tile_batch({"bi": [r], "bj": [q]}, [x.shape[0]], [x.shape[1]], [x.ravel(order="F")])
        c.clear()

    for batch in batches:
        gid, k, side, r = (batch.column(n).to_numpy(zero_copy_only=False).tolist() for n in PRODUCT_ROWS[:4])
        tiles = TileReader(batch)
        stored = np.diff(tiles.offs)
        few = ~tiles.full & (np.array(side) == 0) & (8 * stored <= tiles.h.astype(np.int64) * tiles.w)
        _, (ti, tj, tv) = tiles.values(np.flatnonzero(few))
        ends = np.cumsum(np.where(few, stored, 0)).tolist()
        hs, ws, few, full, stored = tiles.h.tolist(), tiles.w.tolist(), few.tolist(), tiles.full.tolist(), stored.tolist()
        for row in range(batch.num_rows):
            if gid[row] != state["gid"]:
                yield from finished()
                state["gid"], state["k"] = gid[row], k[row]
            elif k[row] != state["k"]:
                multiply()
                state["k"] = k[row]
            if few[row]:
                mine = slice(ends[row] - stored[row], ends[row])
                thin.append((r[row], hs[row], ti[mine], tj[mine], tv[mine], ws[row]))
                continue
            t = tiles.view(row)
            # a copy: views of an Arrow batch must not outlive it
            (b if side[row] else a)[r[row]] = t.copy() if full[row] else t
    yield from finished()


def transpose_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles -> transposed tiles (ids and sizes swapped)."""
    for b in batches:
        hs = b.column("h").to_numpy(zero_copy_only=False)
        ws = b.column("w").to_numpy(zero_copy_only=False)
        flat, offs = list_parts(b.column("data"))
        # the C-order buffer of the (w, h) view read column by column
        out = [np.ascontiguousarray(flat[offs[r]:offs[r + 1]].reshape(ws[r], hs[r]).T).ravel()
               for r in range(b.num_rows)]
        if out:
            yield tile_batch({"bi": b.column("bj").to_pylist(), "bj": b.column("bi").to_pylist()},
                             ws.tolist(), hs.tolist(), out)


# ------------------------------------------------------------ map-side products with vectors
#: Bytes of result segments that a task adds up before it sends them on.
SEGMENT_BYTES = 64 << 20


def _segments(out: dict[int, np.ndarray]) -> pa.RecordBatch:
    keys = sorted(out)
    part = tile_batch({"bi": keys, "bj": [0] * len(keys)}, [out[k].size for k in keys], [1] * len(keys),
                      [out[k] for k in keys])
    return part.append_column("part", pa.array([task_id()] * len(keys), pa.int32()))


def vector_batches(left: bool):
    """Rows ``(bi, bj, h, w, flip, data, pos, x)``, a tile of M and the tile of a vector that it
    meets, -> partial result tiles ``(bi, 0)``, summed per task.  ``left``: xᵀM instead of Mx.
    Of a sparse tile only the stored values are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        held = 0
        for b in batches:
            bi, bj = (b.column(n).to_numpy(zero_copy_only=False) for n in ("bi", "bj"))
            tiles = TileReader(b)
            xflat, xoffs = list_parts(b.column("x"))
            for r in range(b.num_rows):
                x = xflat[xoffs[r]:xoffs[r + 1]]
                got = tiles.sparse(r)
                key = int(bj[r] if left else bi[r])
                if got is None:
                    y = x @ tiles.view(r) if left else tiles.view(r) @ x
                else:
                    (to, at), n = ((got[1], got[0]), tiles.w[r]) if left else ((got[0], got[1]), tiles.h[r])
                    y = np.bincount(to, got[2] * x[at], int(n))
                if key in out:
                    out[key] += y
                else:
                    out[key] = y
                    held += y.nbytes
            if held > SEGMENT_BYTES:
                yield _segments(out)
                out, held = {}, 0
        if out:
            yield _segments(out)
    return run


def quad_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a tile of M and the vector tiles on both its sides -> one partial xᵀMy."""
    total, any_row = 0.0, False
    for b in batches:
        tiles = TileReader(b)
        (xf, xo), (yf, yo) = list_parts(b.column("x")), list_parts(b.column("y"))
        for r in range(b.num_rows):
            x, y, got = xf[xo[r]:xo[r + 1]], yf[yo[r]:yo[r + 1]], tiles.sparse(r)
            if got is None:
                total += float(x @ tiles.view(r) @ y)
            else:
                total += float((x[got[0]] * got[2]) @ y[got[1]])
            any_row = True
    if any_row:
        yield pa.RecordBatch.from_pydict({"s": pa.array([total], pa.float64())})


def gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of a matrix with one tile column -> one partial TᵀT per task."""
    total = None
    for b in batches:
        tiles = TileReader(b)
        for r in range(b.num_rows):
            t = tiles.view(r)
            total = t.T @ t if total is None else total + t.T @ t
    if total is not None:
        out = tile_batch({"bi": [0], "bj": [0]}, [total.shape[0]], [total.shape[1]], [total.ravel(order="F")])
        yield out.append_column("part", pa.array([task_id()], pa.int32()))


# ------------------------------------------------------------------------------ sparse tiles
def sparse_tile_batch(keys: dict[str, list], hs: list[int], ws: list[int], pos: list[np.ndarray],
                      data: list[np.ndarray]) -> pa.RecordBatch:
    """Sparse tiles; one that stores all its places keeps no positions."""
    out = tile_batch(keys, hs, ws, data)
    full = [p.size == h * w for p, h, w in zip(pos, hs, ws)]
    kept = pa.array([None if f else p.astype(np.int32) for p, f in zip(pos, full)], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([*out.columns[:-1], kept, out.columns[-1]], [*out.schema.names[:-1], "pos", "data"])


def thin_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles -> sparse tiles with the places that are not 0; tiles of zeros go."""
    for b in batches:
        tiles = TileReader(b)
        flat = [tiles.view(r).ravel(order="F") for r in range(b.num_rows)]
        pos = [np.flatnonzero(x) for x in flat]
        keep = [r for r in range(b.num_rows) if pos[r].size]
        if keep:
            keys = {n: [b.column(n)[r].as_py() for r in keep] for n in ("bi", "bj")}
            yield sparse_tile_batch(keys, [int(tiles.h[r]) for r in keep], [int(tiles.w[r]) for r in keep],
                                    [pos[r] for r in keep], [flat[r][pos[r]] for r in keep])


def fill_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse tiles -> dense ones."""
    for b in batches:
        if b.num_rows:
            tiles = TileReader(b)
            yield tile_batch({n: b.column(n).to_pylist() for n in ("bi", "bj")}, tiles.h.tolist(), tiles.w.tolist(),
                             [tiles.view(r).ravel(order="F") for r in range(b.num_rows)])


def transpose_sparse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse tiles -> transposed sparse tiles (positions sorted again)."""
    for b in batches:
        if not b.num_rows:
            continue
        tiles = TileReader(b)
        pos, data = [], []
        for r in range(b.num_rows):
            h, w, got = int(tiles.h[r]), int(tiles.w[r]), tiles.sparse(r)
            if got is None:
                pos.append(np.arange(h * w))
                data.append(tiles.view(r).ravel())
            else:
                to = got[0] * w + got[1]
                order = np.argsort(to)
                pos.append(to[order])
                data.append(got[2][order])
        yield sparse_tile_batch({"bi": b.column("bj").to_pylist(), "bj": b.column("bi").to_pylist()},
                                tiles.w.tolist(), tiles.h.tolist(), pos, data)


def zip_sparse_batches(op: str):
    """Full-outer-joined sparse tiles ``(bi, bj, h, w, ap, ad, bp, bd)`` -> the sparse tile of a
    numpy ufunc over the union of their stored places, all tiles of a batch (up to ``CHUNK``
    places) at once."""
    ufunc = getattr(np, op)

    def side(b, pos: str, data: str, starts, area):
        """Places of a side, counted through all tiles of the batch, and their values."""
        (pf, po), (df, do) = list_parts(b.column(pos)), list_parts(b.column(data))
        n = np.where(b.column(data).is_null().to_numpy(zero_copy_only=False), 0, np.diff(do))
        full = b.column(pos).is_null().to_numpy(zero_copy_only=False)
        tile = np.repeat(np.arange(n.size), n)
        nth = np.arange(tile.size) - np.repeat(np.cumsum(n) - n, n)
        place = nth.copy()  # a full tile stores its places in order
        some = ~full[tile]
        place[some] = pf[(po[:-1][tile] + nth)[some]]
        return starts[tile] + place, df[do[:-1][tile] + nth]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            stored = sum(np.diff(list_parts(whole.column(c))[1]) for c in ("ad", "bd")) if whole.num_rows else np.zeros(0)
            for first, to in spans(stored, CHUNK):
                b = whole.slice(first, to - first)
                h, w = (b.column(n).to_numpy(zero_copy_only=False) for n in ("h", "w"))
                area = h.astype(np.int64) * w
                starts = np.cumsum(area) - area
                (pa_, va), (pb, vb) = side(b, "ap", "ad", starts, area), side(b, "bp", "bd", starts, area)
                if pa_.size == pb.size and (pa_ == pb).all() and (np.diff(pa_) > 0).all():
                    at, x, y = pa_, va, vb
                else:
                    at = np.union1d(pa_, pb)
                    x, y = np.zeros(at.size), np.zeros(at.size)
                    x[np.searchsorted(at, pa_)] = va
                    y[np.searchsorted(at, pb)] = vb
                with np.errstate(divide="ignore", invalid="ignore"):
                    out = ufunc(x, y)
                sizes = np.diff(np.searchsorted(at, np.append(starts, area.sum())))
                full = sizes == area
                kept = ~np.repeat(full, sizes)
                place = (at - np.repeat(starts, sizes))[kept].astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    **{n: b.column(n) for n in ("bi", "bj", "h", "w")},
                    "pos": list_array(place, np.where(full, 0, sizes), full), "data": list_array(out, sizes)})
    return run


# ------------------------------------------------------------------------- retile, reduce
PIECE_SCHEMA = "bi bigint, bj bigint, h int, w int, r0 int, c0 int, ph int, pw int, data array<double>"


def cut_batches(shape, old: tuple[int, int], new: tuple[int, int]):
    """Tiles -> the rectangles they share with the tiles of another grid."""
    (nrows, ncols), (oh, ow), (nh, nw) = shape, old, new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bi, bj, h, w = (b.column(n).to_numpy(zero_copy_only=False) for n in ("bi", "bj", "h", "w"))
            flat, offs = list_parts(b.column("data"))
            rows: dict[str, list] = {n: [] for n in ("bi", "bj", "h", "w", "r0", "c0", "ph", "pw")}
            data = []
            for r in range(b.num_rows):
                t = _tile_view(flat, offs, r, int(h[r]), int(w[r]), False)
                i0, j0 = int(bi[r]) * oh, int(bj[r]) * ow
                i1, j1 = i0 + t.shape[0], j0 + t.shape[1]
                for ti in range(i0 // nh, (i1 - 1) // nh + 1):
                    for tj in range(j0 // nw, (j1 - 1) // nw + 1):
                        a0, a1 = max(i0, ti * nh), min(i1, ti * nh + nh)
                        b0, b1 = max(j0, tj * nw), min(j1, tj * nw + nw)
                        for n, v in zip(rows, (ti, tj, min(nh, nrows - ti * nh), min(nw, ncols - tj * nw),
                                               a0 - ti * nh, b0 - tj * nw, a1 - a0, b1 - b0)):
                            rows[n].append(v)
                        data.append(t[a0 - i0:a1 - i0, b0 - j0:b1 - j0].ravel(order="F"))
            if data:
                cols = {n: pa.array(v, pa.int64() if n in ("bi", "bj") else pa.int32())
                        for n, v in rows.items()}
                yield pa.RecordBatch.from_pydict({**cols, "data": to_list_array(data)})
    return run


def paste_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rectangles of one new tile -> the tile (places no rectangle covers are zeros)."""
    out, key = None, None
    for b in batches:
        cols = {n: b.column(n).to_numpy(zero_copy_only=False) for n in
                ("bi", "bj", "h", "w", "r0", "c0", "ph", "pw")}
        flat, offs = list_parts(b.column("data"))
        for r in range(b.num_rows):
            if out is None:
                key = (int(cols["bi"][r]), int(cols["bj"][r]))
                out = np.zeros((int(cols["h"][r]), int(cols["w"][r])))
            r0, c0, ph, pw = (int(cols[n][r]) for n in ("r0", "c0", "ph", "pw"))
            out[r0:r0 + ph, c0:c0 + pw] = _tile_view(flat, offs, r, ph, pw, False)
    if out is not None:
        yield tile_batch({"bi": [key[0]], "bj": [key[1]]}, [out.shape[0]], [out.shape[1]],
                         [out.ravel(order="F")])


SEGMENT_SCHEMA = "b bigint, n int, cnt bigint, data array<double>"


def reduce_batches(ufunc_name: str, by_rows: bool):
    """Tiles -> one segment per tile row (or tile column) and task, reduced by a numpy ufunc,
    with the number of places that went into each of its values.  Places that a sparse tile
    does not store are zeros and take part; for a sum they are not touched."""
    ufunc = getattr(np, ufunc_name)

    def send(seg):
        keys = sorted(seg)
        return pa.RecordBatch.from_pydict({
            "b": pa.array(keys, pa.int64()), "n": pa.array([seg[k][0].size for k in keys], pa.int32()),
            "cnt": pa.array([seg[k][1] for k in keys], pa.int64()),
            "data": to_list_array([seg[k][0] for k in keys])})

    def reduced(b, tiles):
        """Per tile row that is in the batch: its key, segment and number of places."""
        key, n, c = ((b.column("bi").to_numpy(zero_copy_only=False), tiles.h, tiles.w) if by_rows
                     else (b.column("bj").to_numpy(zero_copy_only=False), tiles.w, tiles.h))
        thin = ~tiles.full & (ufunc_name == "add")
        if thin.any():
            rows = np.flatnonzero(thin)
            found, nth = np.unique(key[rows], return_inverse=True)
            length, places = np.zeros(found.size, np.int64), np.zeros(found.size, np.int64)
            length[nth] = n[rows]
            np.add.at(places, nth, c[rows])
            offs = np.cumsum(length) - length
            which, (i, j, v) = tiles.values(rows)
            sums = np.bincount(offs[nth][which] + (i if by_rows else j), v, int(length.sum()))
            for k, at, m, p in zip(found.tolist(), offs.tolist(), length.tolist(), places.tolist()):
                yield k, sums[at:at + m], p
        sizes = tiles.h.astype(np.int64) << 32 | tiles.w
        for size in np.unique(sizes[~thin]).tolist():
            h, w = size >> 32, size & 0xFFFFFFFF
            rows = np.flatnonzero((sizes == size) & ~thin)
            rows = rows[np.argsort(key[rows], kind="stable")]
            axis = 1 if by_rows else 2
            y = ufunc.reduce(tiles.block(rows, h, w), axis=axis)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(key[rows]) != 0]))
            count = np.diff(np.append(starts, rows.size)) * (w if by_rows else h)
            for k, x, p in zip(key[rows][starts].tolist(), ufunc.reduceat(y, starts, axis=0), count.tolist()):
                yield k, x, p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg: dict[int, tuple[np.ndarray, int]] = {}
        held = 0
        for whole in batches:
            area = (whole.column("h").to_numpy(zero_copy_only=False).astype(np.int64)
                    * whole.column("w").to_numpy(zero_copy_only=False))
            for at, to in spans(area, CHUNK):
                b = whole.slice(at, to - at)
                for key, y, c in reduced(b, TileReader(b)):
                    if key in seg:
                        seg[key] = (ufunc(seg[key][0], y), seg[key][1] + c)
                    else:
                        seg[key] = (y, c)
                        held += y.nbytes
            if held > SEGMENT_BYTES:
                yield send(seg)
                seg, held = {}, 0
        if seg:
            yield send(seg)
    return run


def combine_segments(ufunc_name: str, full: int):
    """All segments of one tile row -> a vector tile.  If fewer than ``full`` values went
    into a place, the absent ones take part as zeros."""
    ufunc = getattr(np, ufunc_name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cnt, key = None, 0, 0
        for b in batches:
            flat, offs = list_parts(b.column("data"))
            c = b.column("cnt").to_numpy(zero_copy_only=False)
            for r in range(b.num_rows):
                x = flat[offs[r]:offs[r + 1]]
                key = b.column("b")[r].as_py()
                total, cnt = (x.copy() if total is None else ufunc(total, x)), cnt + int(c[r])
        if total is not None:
            if cnt < full:
                total = ufunc(total, np.zeros_like(total))
            yield tile_batch({"bi": [key], "bj": [0]}, [total.size], [1], [total])
    return run


def rows_to_tile(dup_sum: bool, th: int, nrows: int):
    """Row segments ``(bi, bj, i, w, seg)`` of one tile -> the tile; rows that are missing
    are zeros, a repeated row is an error or summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen, key = None, None, None
        for b in batches:
            i, w = (b.column(n).to_numpy(zero_copy_only=False) for n in ("i", "w"))
            flat, offs = list_parts(b.column("seg"))
            for r in range(b.num_rows):
                if out is None:
                    key = (b.column("bi")[r].as_py(), b.column("bj")[r].as_py())
                    h = min(th, nrows - key[0] * th)
                    out, seen = np.zeros((h, int(w[r]))), np.zeros(h, bool)
                at = int(i[r]) - key[0] * th
                if seen[at] and not dup_sum:
                    raise ValueError(f"row {int(i[r])} is there more than once")
                seen[at] = True
                x = flat[offs[r]:offs[r + 1]]
                out[at, :x.size] += x
        if out is not None:
            yield tile_batch({"bi": [key[0]], "bj": [key[1]]}, [out.shape[0]], [out.shape[1]],
                             [out.ravel(order="F")])
    return run


def tile_local_product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full-outer-joined square tiles ``(bi, bj, h, w, ad, bd)`` -> A_t · B_t per tile.

    A NULL side is the zero tile (the product is then zero)."""
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        hs = b.column("h").to_numpy(zero_copy_only=False)
        ws = b.column("w").to_numpy(zero_copy_only=False)
        anull = b.column("ad").is_null().to_numpy(zero_copy_only=False)
        bnull = b.column("bd").is_null().to_numpy(zero_copy_only=False)
        af, ao = list_parts(b.column("ad"))
        bf, bo = list_parts(b.column("bd"))
        out = []
        for r in range(n):
            h, w = int(hs[r]), int(ws[r])
            if anull[r] or bnull[r]:
                out.append(np.zeros(h * w))
                continue
            at = af[ao[r]:ao[r + 1]].reshape(w, h)
            btt = bf[bo[r]:bo[r + 1]].reshape(w, h)
            out.append((btt @ at).ravel())
        yield tile_batch({"bi": b.column("bi").to_pylist(), "bj": b.column("bj").to_pylist()},
                         hs.tolist(), ws.tolist(), out)


# --------------------------------------------------------------------------- exact sums
#: Bits of a bin of an exact sum, and values that are taken apart at once (their parts are
#: below 2^47, so that so many add up below 2^63).
BIN, EXACT_ROWS = 24, 1 << 15
#: Bins of NaN and of the infinities (their sums are counts).
NAN, MORE, LESS = 1 << 20, (1 << 20) + 1, (1 << 20) + 2


def add_exact(bins: dict[int, int], x: np.ndarray) -> None:
    """Add doubles to ``bins``: bin b holds a whole number of 2^(BIN b)."""
    finite = np.isfinite(x)
    if not finite.all():
        for key, odd in ((NAN, np.isnan(x)), (MORE, x == np.inf), (LESS, x == -np.inf)):
            if odd.any():
                bins[key] = bins.get(key, 0) + int(odd.sum())
        x = x[finite]
    for at in range(0, x.size, EXACT_ROWS):
        frac, exp = np.frexp(x[at:at + EXACT_ROWS])
        whole = (frac * 2.0 ** 53).astype(np.int64)
        exp = exp.astype(np.int64) - 53
        bin_, sign, size = exp // BIN, np.sign(whole), np.abs(whole)
        shift = exp - bin_ * BIN
        found, where = np.unique(bin_, return_inverse=True)
        for k in range(3):
            sums = np.zeros(found.size, np.int64)
            np.add.at(sums, where, sign * (((size >> (BIN * k)) & ((1 << BIN) - 1)) << shift))
            for b, v in zip(found.tolist(), sums.tolist()):
                if v:
                    bins[b + k] = bins.get(b + k, 0) + v


def exact_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A column of doubles or of arrays of them -> (bin, hi, lo) of the task's exact sum."""
    bins: dict[int, int] = {}
    for b in batches:
        x = b.column(0)
        x = x.flatten() if pa.types.is_list(x.type) or pa.types.is_large_list(x.type) else x
        add_exact(bins, x.drop_null().to_numpy(zero_copy_only=False))
    keys = sorted(bins)
    yield pa.RecordBatch.from_pydict({"bin": pa.array(keys, pa.int32()),
                                      "hi": pa.array([bins[k] >> 32 for k in keys], pa.int64()),
                                      "lo": pa.array([bins[k] & 0xFFFFFFFF for k in keys], pa.int64())})


def exact_total(name: str):
    """The row of all bins -> their sum, rounded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[int, int] = {}
        for b in batches:
            for x in b.column("all").to_pylist():
                bins.update({y["bin"]: (y["hi"] << 32) + y["lo"] for y in x})
        nan, more, less = (bins.pop(k, 0) for k in (NAN, MORE, LESS))
        if nan or (more and less):
            out = float("nan")
        elif more or less:
            out = float("inf") if more else -float("inf")
        else:
            low = min([*bins, 0])
            total = sum(v << (BIN * (k - low)) for k, v in bins.items())
            try:
                out = total / (1 << (-BIN * low))  # division of whole numbers rounds once
            except OverflowError:
                out = float("inf") if total > 0 else -float("inf")
        yield pa.RecordBatch.from_pydict({name: pa.array([out], pa.float64())})
    return run


# ------------------------------------------------------------------- user functions
def map_tiles_batches(fn):
    """Wrap a numpy ``fn(tile) -> tile`` (2-D, same shape) as a ``mapInArrow`` function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            hs = b.column("h").to_numpy(zero_copy_only=False)
            ws = b.column("w").to_numpy(zero_copy_only=False)
            flat, offs = list_parts(b.column("data"))
            out = []
            for r in range(b.num_rows):
                h, w = int(hs[r]), int(ws[r])
                tile = flat[offs[r]:offs[r + 1]].reshape(w, h).T
                res = np.asarray(fn(tile), dtype=np.float64)
                if res.shape != (h, w):
                    raise ValueError(f"tile function returned {res.shape}, expected {(h, w)}")
                out.append(res.ravel(order="F"))
            yield tile_batch({"bi": b.column("bi").to_pylist(), "bj": b.column("bj").to_pylist()},
                             hs.tolist(), ws.tolist(), out)

    return run


def zip_tiles_batches(fn):
    """Wrap ``fn(a, b) -> c`` over full-outer-joined tiles; a missing side is zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            hs = b.column("h").to_numpy(zero_copy_only=False)
            ws = b.column("w").to_numpy(zero_copy_only=False)
            anull = b.column("ad").is_null().to_numpy(zero_copy_only=False)
            bnull = b.column("bd").is_null().to_numpy(zero_copy_only=False)
            af, ao = list_parts(b.column("ad"))
            bf, bo = list_parts(b.column("bd"))
            out = []
            for r in range(b.num_rows):
                h, w = int(hs[r]), int(ws[r])
                ta = np.zeros((h, w)) if anull[r] else af[ao[r]:ao[r + 1]].reshape(w, h).T
                tb = np.zeros((h, w)) if bnull[r] else bf[bo[r]:bo[r + 1]].reshape(w, h).T
                res = np.asarray(fn(ta, tb), dtype=np.float64)
                if res.shape != (h, w):
                    raise ValueError(f"tile function returned {res.shape}, expected {(h, w)}")
                out.append(res.ravel(order="F"))
            yield tile_batch({"bi": b.column("bi").to_pylist(), "bj": b.column("bj").to_pylist()},
                             hs.tolist(), ws.tolist(), out)

    return run


def tile_scalar_batches(fn):
    """Wrap ``fn(tile) -> float`` as a ``mapInArrow`` function emitting ``(bi, bj, s)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            hs = b.column("h").to_numpy(zero_copy_only=False)
            ws = b.column("w").to_numpy(zero_copy_only=False)
            flat, offs = list_parts(b.column("data"))
            vals = [float(fn(flat[offs[r]:offs[r + 1]].reshape(int(ws[r]), int(hs[r])).T))
                    for r in range(b.num_rows)]
            yield pa.RecordBatch.from_pydict({
                "bi": pa.array(b.column("bi").to_pylist(), type=pa.int64()),
                "bj": pa.array(b.column("bj").to_pylist(), type=pa.int64()),
                "s": pa.array(vals, type=pa.float64())})

    return run


def generate_tiles_batches(fn, th: int, tw: int):
    """``(bi, bj, h, w)`` rows -> tiles filled by a numpy ``fn(h, w)`` (or ``fn(bi, bj, h, w)``)."""
    import inspect

    nargs = len(inspect.signature(fn).parameters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            bis = b.column("bi").to_pylist()
            bjs = b.column("bj").to_pylist()
            hs = b.column("h").to_pylist()
            ws = b.column("w").to_pylist()
            out = []
            for bi, bj, h, w in zip(bis, bjs, hs, ws):
                res = fn(h, w) if nargs == 2 else fn(bi, bj, h, w)
                res = np.asarray(res, dtype=np.float64)
                if res.shape != (h, w):
                    raise ValueError(f"generator returned {res.shape}, expected {(h, w)}")
                out.append(res.ravel(order="F"))
            yield tile_batch({"bi": bis, "bj": bjs}, hs, ws, out)

    return run
