"""Near-duplicate vectors by collision-counting projections.

Each unit vector is projected on ``PROJECTIONS`` random lines.  Two vectors
collide on a line when one lies in the window of half-width ``w`` around the
other; vectors at the threshold cosine collide with probability p on each line,
as their difference projects to a normal variable of known deviation.  The count
of collisions that a candidate pair must reach is the largest one that pairs at
the threshold reach with probability ``RECALL`` (a binomial tail); candidates
are verified by cosine in double precision.

A pair that reaches the count misses at most ``PROJECTIONS`` - count lines, so
of one more pairs of lines than that (anchors), one has both lines collide.
Vectors are therefore dealt by label and the cell of an anchor's two lines
(cells as wide as the window, each vector also in the three cells after its
own), sorted there on the first line, and windows around each vector are
counted.  Crowded cells are split into blocks, and every pair of blocks is a
group of its own.  A pair is counted in one place only: the first anchor that
collides, the later cell on each line.  What leaves a group are link counts by
vector and a forest of links, so the output is linear in the group.

Equal vectors of a label are one class with a count from the start.

Cases: a null label, a null, empty or zero vector, or one with null or
non-finite components links with nothing; vectors of different length are never
compared; repeated rows are vectors of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import staged, table
from gridmart.llm.components import components, forest

PROJECTIONS = 16
RECALL = 0.9999
#: Half-width of the window in deviations of the projected difference at the threshold.
WIDTH = 3.5
#: Vectors of a block; a pair of blocks is one group.
BLOCK = 256
_SEED = 7919


def calibrated(width: float, recall: float, lines: int) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``."""
    hit, total = erf(width / sqrt(2)), 0.0
    for count in range(lines, 0, -1):
        total += comb(lines, count) * hit ** count * (1 - hit) ** (lines - count)
        if total >= recall:
            return count
    return 1


COUNT = calibrated(WIDTH, RECALL, PROJECTIONS)
ANCHORS = PROJECTIONS - COUNT + 1


@lru_cache(maxsize=8)
def lines(dimension: int) -> np.ndarray:
    """The projection lines for vectors of this length, the same in every task."""
    return np.random.default_rng([_SEED, dimension]).standard_normal((dimension, PROJECTIONS))


def projected(vectors: np.ndarray) -> np.ndarray:
    """Projections of the unit vectors."""
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / scale
    return (unit / np.linalg.norm(unit, axis=1, keepdims=True)) @ lines(vectors.shape[1])


def half_width(cosine: float) -> float:
    """The window for vectors at this cosine."""
    return WIDTH * sqrt(2.0 - 2.0 * cosine)


def _cells(cosine: float):
    """Each class with its vector as bytes and the anchor cells it is dealt to."""
    wide = half_width(cosine)

    def run(batches):
        for batch in batches:
            vectors = batch["embedding"].to_pylist()
            cells = []
            for vector in vectors:
                own = np.floor(projected(np.array([vector], dtype=np.float64))[0] / wide).astype(int)
                cells.append([{"anchor": a, "x": own[2 * a] + dx, "y": own[2 * a + 1] + dy}
                              for a in range(ANCHORS) for dx in (0, 1) for dy in (0, 1)])
            kind = pa.list_(pa.struct([("anchor", pa.int32()), ("x", pa.int32()), ("y", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["label"], batch["copies"],
                 pa.array([np.array(v, dtype=np.float64).tobytes() for v in vectors], pa.binary()), pa.array(cells, kind)],
                names=["node", "label", "copies", "vector", "cells"])
    return run


def links_in_cell(vectors: np.ndarray, cosine: float, anchor: int, x: int, y: int,
                  block: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link and belong to this cell (and, with ``across``, to two blocks)."""
    wide = half_width(cosine)
    places = projected(vectors)
    order = np.argsort(places[:, 2 * anchor], kind="stable")
    places, block = places[order], block[order]
    home = np.floor(places[:, [2 * anchor, 2 * anchor + 1]] / wide).astype(int)
    unit = vectors[order] / np.abs(vectors[order]).max(axis=1, keepdims=True)
    norm = np.linalg.norm(unit, axis=1)
    ends = np.searchsorted(places[:, 2 * anchor], places[:, 2 * anchor] + wide, side="right")
    left, right = [], []
    for a in range(0, len(order), 128):
        b, stop = min(a + 128, len(order)), int(ends[a:a + 128].max())
        mine, other = np.arange(a, b)[:, None], np.arange(a, stop)[None, :]
        good = (other > mine) & (other < ends[a:b, None])
        good &= np.maximum(home[a:b, None, 0], home[None, a:stop, 0]) == x
        good &= np.maximum(home[a:b, None, 1], home[None, a:stop, 1]) == y
        if across:
            good &= block[a:b, None] != block[None, a:stop]
        if not good.any():
            continue
        count = np.zeros(good.shape, dtype=np.int8)
        near = []
        for k in range(PROJECTIONS):
            hit = np.abs(places[a:b, None, k] - places[None, a:stop, k]) <= wide
            count += hit
            if k < 2 * anchor + 2:
                near.append(hit)
        good &= near[2 * anchor] & near[2 * anchor + 1]
        for earlier in range(anchor):
            good &= ~(near[2 * earlier] & near[2 * earlier + 1])
        i, j = np.nonzero(good & (count >= COUNT))
        i, j = i + a, j + a
        exact = np.einsum("ij,ij->i", unit[i], unit[j]) / (norm[i] * norm[j])
        left.append(order[i[exact >= cosine]])
        right.append(order[j[exact >= cosine]])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        vectors = np.frombuffer(b"".join(rows["vector"]), dtype=np.float64).reshape(len(rows), -1)
        left, right = links_in_cell(vectors, cosine, int(first["anchor"]), int(first["x"]), int(first["y"]),
                                    rows["mine"].to_numpy(), bool(first["a"] != first["b"]))
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        links = np.zeros(len(rows), dtype=np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        some = np.flatnonzero(links)
        edges = np.array(forest(len(rows), left, right), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({
            "u": np.concatenate([node[some], node[edges[:, 0]]]),
            "v": pd.array([None] * len(some) + node[edges[:, 1]].tolist(), dtype="Int64"),
            "links": np.concatenate([links[some], np.zeros(len(edges), dtype=np.int64)])})
    return run


def vector_classes(vectors: DataFrame) -> DataFrame:
    """Equal usable vectors of a label as one row: node, label, embedding, least id and copies."""
    usable = vectors.where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0))
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    return staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")


def near_vectors(vectors: DataFrame, cosine: float) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    classes = vector_classes(rows)
    dealt = staged(classes.select("node", "label", "copies", "embedding").mapInArrow(
        _cells(cosine), "node long, label string, copies long, vector binary, "
        "cells array<struct<anchor:int,x:int,y:int>>"), "cells")
    key = ["label", F.length("vector").alias("wide"), "cell.anchor", "cell.x", "cell.y"]
    names = ["label", "wide", "anchor", "x", "y"]
    placed = dealt.withColumn("cell", F.explode("cells"))
    sizes = placed.select(*key).groupBy(*names).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = (placed.select("node", "copies", "vector", *key).join(sizes, names)
              .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("a", F.least("mine", "other")).withColumn("b", F.greatest("mine", "other")))
    found = staged(blocks.groupBy(*names, "a", "b").applyInPandas(_links(cosine), "u long, v long, links long"), "links")
    counts = found.where("v IS NULL").groupBy("u").agg(F.sum("links").alias("links"))
    groups = components(found.where("v IS NOT NULL").select("u", "v"))
    named = (classes.join(counts, F.col("node") == F.col("u"), "left").drop("u")
             .join(groups.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
             .select("label", "embedding", "rep", F.coalesce("component", "node").alias("component"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = named.join(least, "component").select("label", "embedding", "n_links", "component_id")
    out = rows.join(by_class, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_collision_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, linked within a label at cosine 0.98."""
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


QUERIES = {"op3_collision_dedup": op3_collision_dedup}
