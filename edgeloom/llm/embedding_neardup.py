"""Embedding near-duplicates by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.components import connected
from edgeloom.llm.storage import staged

BLOCK = 512
SLACK = 1e-9
#: Vectors that the axes are taken from, and tasks that sum their products.
AXES_ROWS, SUMS = 20_000, 16
#: Leading axes that boxes are kept of, that the grid has at most, and its cells at most.
BOX_AXES, GRID_AXES, CELLS = 16, 3, 4096
#: Leading axes of the curve that orders the vectors of a cell; tiles of a block.
CURVE_AXES, SIDE = 8, 8


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def principal_axes(classes: DataFrame, dims: int) -> np.ndarray:
    """Orthogonal axes of the vectors of length ``dims``, by falling variance about zero. Any turn keeps cosines, so the axes only
    decide how early a pair is ruled out: they come from some ``AXES_ROWS`` vectors chosen by hash,
    whose products 16 tasks sum, and 16 matrices reach the driver."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if len(batch):
                x = _unit(np.stack(batch["v"].to_numpy()))
                total += x.T @ x
        yield pd.DataFrame({"sums": [total.tobytes()]})

    own = classes.where(F.size("v") == dims).select("node", "v")
    share = min(1.0, AXES_ROWS / max(1, own.count()))
    some = own.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else own
    parts = some.select("v").repartition(SUMS).mapInPandas(moments, "sums binary")
    total = sum((np.frombuffer(r.sums) for r in parts.collect()), np.zeros(dims * dims)).reshape(dims, dims)
    return np.linalg.eigh(total)[1][:, ::-1]


def _hook(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of linked rows; ``parent`` stays flat and points at the smallest row."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            return
        parent[np.maximum(a, b)] = np.minimum(a, b)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def compare_tiles(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool, cuts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs ``(i, j)`` of rows of two tiles of unit vectors with cosine of at least
    ``threshold``; within one tile each pair once. The first cut's coordinates and the norm of what follows them
    stand side by side, so that one product gives the bound of every pair. Those it leaves
    gain the coordinates up to the next cut, with the bound of the rest, and drop out as
    soon as they cannot reach the threshold; survivors are decided by the whole product."""
    rx, ry = x @ axes, y @ axes
    tail = [(np.sqrt(np.maximum((rx[:, c:] ** 2).sum(1), 0)), np.sqrt(np.maximum((ry[:, c:] ** 2).sum(1), 0))) for c in cuts]
    first = cuts[0]
    led_x, led_y = np.column_stack([rx[:, :first], tail[0][0]]), np.column_stack([ry[:, :first], tail[0][1]])
    for lo in range(0, len(x), BLOCK):
        hi = min(lo + BLOCK, len(x))
        from_row = lo if same else 0
        bound = led_x[lo:hi] @ led_y[from_row:].T
        open_ = bound >= threshold - SLACK
        n_open = int(open_.sum())
        if n_open > open_.size // 16:  # a block of near copies: one product of whole vectors
            whole = x[lo:hi] @ y[from_row:].T
            i, j = np.nonzero(whole >= threshold - SLACK)
            sure = whole[i, j] >= threshold + SLACK
            i, j = i + lo, j + from_row
            # what lies at the threshold is decided by the one formula, however full its block is
            sure[~sure] = np.einsum("ij,ij->i", x[i[~sure]], y[j[~sure]]) >= threshold
            if same:
                sure &= i < j
            yield i[sure], j[sure]
            continue
        if not n_open:
            continue
        i, j = np.nonzero(open_)
        i, j = i + lo, j + from_row
        if same:
            i, j = i[i < j], j[i < j]
        partial = np.einsum("ij,ij->i", rx[i, :first], ry[j, :first])
        for k in range(1, len(cuts)):
            part = slice(cuts[k - 1], cuts[k])
            partial = partial + np.einsum("ij,ij->i", rx[i, part], ry[j, part])
            left = partial + tail[k][0][i] * tail[k][1][j] >= threshold - SLACK
            i, j, partial = i[left], j[left], partial[left]
        hit = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
        if hit.any():
            yield i[hit], j[hit]


TILE = "block long, tile long, dims int, cell long, lo array<double>, hi array<double>, nodes binary, sizes binary, x binary"


def tiles_of(classes: DataFrame, axes: np.ndarray, dims: int, reach: float, tile_rows: int) -> DataFrame:
    """Unit vectors in tiles of up to ``tile_rows``, with the bounds of each tile along the leading axes.

    A grid of cells as wide as two linked vectors can lie apart cuts the first axes; inside a cell vectors go
    in the order of a curve through the leading axes, so that tiles are small boxes. Rows are
    dealt by range: a cell with a third of all rows is cut like any other, and a range is a block of ``SIDE`` tiles."""
    strips = int(np.ceil(2 / reach)) + 4  # with the neighbours' room at both ends
    used = max(1, min(GRID_AXES, int(np.log(CELLS) / np.log(strips))))

    spread = 1 / np.sqrt(max(dims, 4))  # of a coordinate, about; only the order of vectors hangs on it

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, group in batch.groupby(batch["v"].map(len)):
                x = _unit(np.stack(group["v"].to_numpy()))
                head = np.zeros((len(x), BOX_AXES))
                m = min(BOX_AXES, d)
                head[:, :m] = x @ axes[:, :m] if d == dims else x[:, :m]
                cell = np.zeros(len(x), np.int64)
                for axis in range(used):
                    cell = cell * strips + np.floor((head[:, axis] + 1) / reach).astype(np.int64) + 1
                steps = np.clip((head[:, :CURVE_AXES] / (8 * spread) + 0.5) * 64, 0, 63).astype(np.int64)
                order = np.zeros(len(x), np.int64)
                for bit in range(5, -1, -1):  # the axes' leading digits first
                    for axis in range(CURVE_AXES):
                        order = order << 1 | (steps[:, axis] >> bit & 1)
                yield pd.DataFrame({"dims": d, "cell": cell, "order": order, "node": group["node"].to_numpy(), "size": group["size"].to_numpy(), "x": [r.tobytes() for r in x], "head": list(head)})

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, number, rows, key = TaskContext.get().partitionId(), 0, [], None

        def tile() -> pd.DataFrame:
            nonlocal number
            number += 1
            heads = np.stack([r.head for r in rows])
            return pd.DataFrame(
                {
                    "block": [block], "tile": [(block << 24) + number], "dims": [key[0]], "cell": [key[1]], "lo": [heads.min(0)], "hi": [heads.max(0)],
                    "nodes": [np.array([r.node for r in rows], np.int64).tobytes()], "sizes": [np.array([r.size for r in rows], np.int64).tobytes()], "x": [b"".join(r.x for r in rows)],
                }
            )

        for batch in batches:
            for row in batch.itertuples(index=False):
                if rows and ((row.dims, row.cell) != key or len(rows) >= tile_rows):
                    yield tile()
                    rows = []
                key = (row.dims, row.cell)
                rows.append(row)
        if rows:
            yield tile()

    rows = classes.select("node", "size", "v").mapInPandas(placed, "dims int, cell long, order long, node long, size long, x binary, head array<double>")
    rows = staged(rows, "cells")
    blocks = max(1, -(-rows.count() // (tile_rows * SIDE)))
    place = ["dims", "cell", "order", "node"]
    return staged(rows.repartitionByRange(blocks, *place).sortWithinPartitions(*place).mapInPandas(packed, TILE), "tiles")


def meeting_blocks(tiles: DataFrame, reach: float) -> DataFrame:
    """(dims, a, b) of blocks that may hold a link, a no later than b: a tile of each lies in cells next to each other, and
    the boxes of these tiles are no further apart than ``reach``. Nothing but boxes is joined."""
    strips = int(np.ceil(2 / reach)) + 4
    used = max(1, min(GRID_AXES, int(np.log(CELLS) / np.log(strips))))
    steps = [sum(s * strips**i for i, s in enumerate(x)) for x in product((-1, 0, 1), repeat=used)]
    ours = tiles.select("dims", F.col("block").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), F.explode(F.array(*(F.col("cell") + s for s in steps))).alias("cell"))
    theirs = tiles.select("dims", "cell", F.col("block").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    apart = F.zip_with(
        F.zip_with("lo_a", "hi_b", lambda p, q: F.greatest(p - q, F.lit(0.0))), F.zip_with("lo_b", "hi_a", lambda p, q: F.greatest(p - q, F.lit(0.0))),
        lambda p, q: F.greatest(p, q),
    )
    near = F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x) <= reach * reach
    return ours.join(theirs, ["dims", "cell"]).where((F.col("a") <= F.col("b")) & near).select("dims", "a", "b").distinct()


def _reach(threshold: float) -> float:
    """The most that two unit vectors with a cosine of ``threshold`` lie apart, and some slack."""
    return max(float(np.sqrt(max(2 - 2 * threshold, 0))), 1e-3) * (1 + 1e-9) + 1e-9


def _links(classes: DataFrame, axes: np.ndarray, dims: int, threshold: float, tile_rows: int, lead: int) -> DataFrame:
    """For each class that links with another: ``linked`` (vectors of other classes, a count
    from one pair of blocks) and ``root`` (its least link in that pair of blocks)."""
    reach = _reach(threshold)
    tiles = tiles_of(classes, axes, dims, reach, tile_rows)
    meeting = staged(meeting_blocks(tiles, reach), "meetings")
    members = meeting.select("dims", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    meet = tiles.join(members, ["dims", "block"])

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        d, a, b = (int(group[c].iloc[0]) for c in ("dims", "a", "b"))
        group = group.sort_values("tile")
        held = [(np.frombuffer(r.nodes, "int64"), np.frombuffer(r.sizes, "int64"), np.frombuffer(r.x).reshape(-1, d)) for r in group.itertuples()]
        starts = np.cumsum([0, *(len(n) for n, _, _ in held)])
        nodes = np.concatenate([n for n, _, _ in held])
        linked, parent = np.zeros(len(nodes), "int64"), np.arange(len(nodes))
        turn = axes if d == dims else np.eye(d)
        cuts = sorted({min(lead, d), min(2 * lead, d), min(4 * lead, d), d})
        lo, hi, block = np.stack(group["lo"]), np.stack(group["hi"]), group["block"].to_numpy()
        for p in np.flatnonzero(block == a):
            for q in np.flatnonzero(block == b):
                gap = np.maximum(np.maximum(lo[p] - hi[q], lo[q] - hi[p]), 0)
                if (a == b and q < p) or gap @ gap > reach * reach:
                    continue
                (_, size_p, x), (_, size_q, y) = held[p], held[q]
                for i, j in compare_tiles(x, y, turn, threshold, p == q, cuts):
                    linked[starts[p] : starts[p + 1]] += np.bincount(i, weights=size_q[j], minlength=len(x)).astype("int64")
                    linked[starts[q] : starts[q + 1]] += np.bincount(j, weights=size_p[i], minlength=len(y)).astype("int64")
                    _hook(parent, i + starts[p], j + starts[q])
        some = linked > 0
        return pd.DataFrame({"node": nodes[some], "linked": linked[some], "root": nodes[parent[some]]})

    return meet.groupBy("dims", "a", "b").applyInPandas(compared, "node long, linked long, root long")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, tile_rows: int = 4096, lead: int = 8
) -> DataFrame:
    """One row per row of ``vectors``: the id, ``n_links`` (other rows with cosine of at
    least ``threshold``, in double precision), ``component_id`` (least id reachable) and
    ``kept`` (whether the two ids agree).

    Equal vectors are one class with a count. The unit vectors are turned to their principal
    axes (a turn keeps cosines) and laid in tiles of some ``tile_rows`` that are small boxes along the leading
    axes (``tiles_of``). Which blocks of tiles can hold a link is found from the boxes alone
    (``meeting_blocks``); only to these a block is copied. A pair of tiles is compared
    coordinate block by coordinate block (``compare_tiles``), and a pair of blocks returns a count and one link per class,
    never its pairs, so a large group of near copies costs no more rows than any other.

    A vector that is null, empty, zero or holds a null or non-finite component, and a row
    with a null id, links with nothing: n_links 0, component_id its own id. Vectors of
    different length do not link. Repeated rows are rows like others (cosine 1). An
    empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    able = F.coalesce(F.col("id").isNotNull() & finite & F.exists("v", lambda c: c != 0), F.lit(False))
    classes = rows.where(able).groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    alone = rows.where(~able).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    usual = classes.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        found = alone
    else:
        links = staged(_links(classes, principal_axes(classes, usual.d), usual.d, threshold, tile_rows, lead), "tile-links")
        counts = links.groupBy("node").agg(F.sum("linked").alias("linked"))
        joined = connected(links.select("node", "root"))
        least = classes.select("node", "least")
        grouped = joined.join(least, "node")
        component = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
        result = classes.join(counts, "node", "left").join(component, "node", "left").select(
            "v",
            (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
        found = rows.where(able).join(result, "v").select("id", "n_links", "component_id").union(alone)
    return found.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
