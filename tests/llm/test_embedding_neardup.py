import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import components
from edgeloom.llm import embedding_neardup as N
from edgeloom.llm.embedding_neardup import compare_tiles, near_duplicates


def brute(vectors, threshold):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = []
    for a, i in enumerate(ok):
        for j in ok[a + 1 :]:
            x, y = np.array(vectors[i], float), np.array(vectors[j], float)
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                pairs.append((i, j))
    links = np.bincount(np.array(pairs).ravel(), minlength=len(vectors)) if pairs else np.zeros(len(vectors), int)
    return links.tolist(), components(len(vectors), pairs)


def planted(seed, n=300, dims=16):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dims) for _ in range(n)]
    for i in range(0, n, 3):  # near copies of one vector, and chains
        out[i] = out[0] + 0.12 * rng.normal(size=dims)
    for i in range(1, 60):
        out[n - i] = out[n - i - 1] + 0.2 * rng.normal(size=dims)
    return [np.float32(v).astype(float).tolist() for v in out]


@pytest.mark.parametrize("tile_rows,seed", [(4096, 1), (20, 2), (7, 3)])
def test_same_as_all_pairs(spark, tile_rows, seed):
    vectors = planted(seed)
    vectors += [vectors[5], vectors[5], [0.0] * 16, None, [], [1.0, None] * 8, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15]
    vectors += [[1.0, 2.0], [2.0, 4.0], [1e-300] * 16, [1e300] * 16]
    links, component = brute(vectors[:-2], 0.95)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in near_duplicates(df, tile_rows=tile_rows, lead=4).collect()}
    assert len(got) == len(vectors)
    n = len(vectors) - 2
    assert [got[i].n_links for i in range(n)] == links
    assert [got[i].component_id for i in range(n)] == component
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert got[n].n_links == 1 and got[n + 1].component_id == n  # scaled far apart, same direction


def test_repeats_null_ids_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 7), (1, [1.0, 0.0], 7), (None, [1.0, 0.0], 7), (2, [0.0, 1.0], 7)], "vec_id long, embedding array<float>, node long")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in near_duplicates(df.withColumn("size", F.lit(1)).withColumn("v", F.lit(2))).collect())
    assert got == [(-1, 0, None, False), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_blocks_of_near_copies_and_bounds_agree():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 12))
    x[:200] = x[0] + 0.05 * rng.normal(size=(200, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    axes = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    got = {(i, j) for a, b in compare_tiles(x, x, axes, 0.9, True, [3, 6, 12]) for i, j in zip(a.tolist(), b.tolist())}
    s = x @ x.T
    assert got == {(i, j) for i, j in zip(*np.nonzero(s >= 0.9)) if i < j}


def copies_per_vector(spark, n, dims=32, members=500, tile_rows=25):
    """To how many pairs of blocks a vector goes, on clustered data."""
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(n // members, dims)) * np.linspace(3, 0.3, dims)  # leading directions matter more, as in trained embeddings
    rows = [(i, (centres[i % len(centres)] + 0.03 * rng.normal(size=dims)).tolist(), 1) for i in range(n)]
    classes = spark.createDataFrame(rows, "node long, v array<double>, size long")
    axes, reach = N.principal_axes(classes, dims), N._reach(0.95)
    tiles = N.tiles_of(classes, axes, dims, reach, tile_rows)
    meeting = N.meeting_blocks(tiles, reach)
    members = meeting.select("dims", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    sent = tiles.join(members, ["dims", "block"]).agg(F.sum(F.length("nodes") / 8)).first()[0]
    blocks = tiles.select("block").distinct().count()
    return sent / n, blocks


def test_copies_on_clustered_data(spark):
    few, blocks = copies_per_vector(spark, 4_000)
    many, more_blocks = copies_per_vector(spark, 24_000)
    print(few, blocks, many, more_blocks)
    assert more_blocks >= 5 * blocks and many < 0.2 * more_blocks and many < 3 * few


def test_axes_from_a_sample(spark, monkeypatch):
    monkeypatch.setattr(N, "AXES_ROWS", 40)
    vectors = planted(6)
    links, component = brute(vectors, 0.95)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_duplicates(df, tile_rows=30).collect()}
    assert [got[i].n_links for i in range(len(vectors))] == links and [got[i].component_id for i in range(len(vectors))] == component
