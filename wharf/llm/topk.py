"""Exact top-k inner products by a Voronoi partition of the data.

Queries and data are grouped by their nearest pivot. A summary per cell (rows and radius) bounds
every query's score in that cell from above and below; the lower bounds give a score that the k
best must reach, and a query travels only to the cells whose upper bound reaches it. What the
queries of a group ask for together is the group's data: a row is replicated to a group only if one
of its queries may need the row's cell. Queries of one cell, and of cells near it, ask for much the
same cells, so groups by pivots keep the copies few. Cells are cut into blocks and large groups into parts, so a frequent
vector never makes one large task; each block is solved locally and the block winners are merged.
The bounds only save work: every row that could win is scored.

Components are floor(scale * x), scores are integers and exact. Pivots are a bounded sample
(``PIVOTS`` rows with the smallest hash of their id); all else covers every row.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do
rows without an id; shorter vectors count as filled up with zeros; an empty vector scores zero
everywhere; rows of the query's own id are not its candidates; repeated rows are candidates
each; of several query rows with one id the one with the smallest vector is asked; scores beyond
64 bits are held at the end of that range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wharf.llm.common import stored
from wharf.plans.joins import lookup

SCALE = 1024
PIVOTS = 64
BLOCK = 2048


def as_integers(vector: np.ndarray | None, scale: int = SCALE) -> np.ndarray | None:
    """floor(scale * x) per component as whole float64 values; None takes no part."""
    if vector is None:
        return None
    values = np.array([np.nan if x is None else x for x in vector], np.float64)
    if not np.isfinite(values).all():
        return None
    made = np.floor(scale * values)
    return made if np.isfinite(made).all() else None


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(blobs), width))
    for row, blob in zip(out, blobs):
        values = np.frombuffer(blob, np.float64)
        row[: len(values)] = values
    return out


def _width(*sides: list[bytes]) -> int:
    return max((len(blob) // 8 for side in sides for blob in side), default=0)


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer inner products, all queries against all data."""
    reach = (np.abs(queries).max(initial=0)) * (np.abs(data).max(initial=0)) * max(data.shape[1], 1)
    if reach < 2.0**53:
        return (queries @ data.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in data]
    low, high = 1 - (1 << 63), (1 << 63) - 1
    return np.array(
        [[min(max(sum(a * b for a, b in zip(q, d)), low), high) for d in whole[1]] for q in whole[0]],
        np.int64,
    ).reshape(len(queries), len(data))


def best(scored: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, the query's own id left out."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        edge = np.partition(scored[at], len(at) - k)[len(at) - k]
        at = at[scored[at] >= edge]
    return at[np.lexsort((ids[at], -scored[at]))][:k]


def query_groups(centres: list[bytes], sizes: dict[int, int], block: int) -> tuple[dict[int, int], dict[int, int]]:
    """For each cell that has queries its group, and the number of parts that its queries are cut into.

    Cells are walked from one pivot to the nearest that is left; neighbours share a group until it
    holds a block of queries. A cell with more is a group of its own. At most ``PIVOTS`` cells.
    """
    left = sorted(sizes)
    if not left:
        return {}, {}
    middle = _matrix(centres, _width(centres))
    walk = [left.pop(0)]
    while left:
        walk.append(left.pop(int(((middle[left] - middle[walk[-1]]) ** 2).sum(1).argmin())))
    groups, parts, group, held = {}, {}, 0, 0
    for cell in walk:
        parts[cell] = -(-sizes[cell] // block)
        if held and (parts[cell] > 1 or held + sizes[cell] > block):
            group, held = group + 1, 0
        groups[cell] = group
        held += sizes[cell]
        if parts[cell] > 1:
            group, held = group + 1, 0
    return groups, parts


def search(
    df: DataFrame,
    is_query: Column,
    k: int,
    row_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    pivots: int = PIVOTS,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every query row of ``df``."""
    spark = df.sparkSession
    rows = df.where(F.col(f"`{row_id}`").isNotNull() & F.col(f"`{vector}`").isNotNull()).select(
        F.col(f"`{row_id}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vector}`").alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )

    def convert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [as_integers(x, scale) for x in frame["x"]]
            out = pd.DataFrame(
                {
                    "vec_id": frame["vec_id"],
                    "asks": frame["asks"],
                    "v": [None if m is None else m.tobytes() for m in made],
                }
            )
            yield out[out["v"].notna()]

    whole = stored(rows.mapInPandas(convert, "vec_id bigint, asks boolean, v binary"), "vectors")
    sample = whole.orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id", "v").limit(pivots).collect()
    centres = [bytes(r["v"]) for r in sample] or [b""]

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            blobs = list(frame["v"])
            width = _width(blobs, centres)
            data, middle = _matrix(blobs, width), _matrix(centres, width)
            far = np.sqrt(np.maximum((data**2).sum(1)[:, None] - 2 * data @ middle.T + (middle**2).sum(1), 0))
            cell = far.argmin(1)
            near = np.linalg.norm(data - middle[cell], axis=1)
            yield frame.assign(cell=cell.astype(np.int32), far=near)

    placed = stored(
        whole.mapInPandas(assign, "vec_id bigint, asks boolean, v binary, cell int, far double"), "cells"
    )
    summary = {
        r["cell"]: (r["n"], r["far"])
        for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    }
    cells = sorted(summary)
    blocks = {c: -(-summary[c][0] // block) for c in cells}

    # A group: queries of neighbouring cells, about a block of them; a larger cell in parts.
    asked = placed.where("asks").groupBy("vec_id").agg(
        F.min(F.struct("v", "cell")).alias("first"), F.count("*").alias("own")
    ).select("vec_id", "first.v", "own", F.col("first.cell").alias("home"))
    asked = stored(asked, "queries")
    sizes = {r["home"]: r["n"] for r in asked.groupBy("home").agg(F.count("*").alias("n")).collect()}
    groups, parts = query_groups(centres, sizes, block)

    def travel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per query and block that may hold one of its k best."""
        count = np.array([summary[c][0] for c in cells])
        radius = np.array([summary[c][1] for c in cells]) * (1 + 1e-9)
        for frame in frames:
            if not len(frame):
                continue
            blobs = list(frame["v"])
            width = _width(blobs, centres)
            query, middle = _matrix(blobs, width), _matrix([centres[c] for c in cells], width)
            centre = query @ middle.T
            slack = np.linalg.norm(query, axis=1)[:, None] * radius * (1 + 1e-9) + 1e-6 * (1 + np.abs(centre))
            low, high = centre - slack, centre + slack
            order = np.argsort(-low, axis=1)
            needed = k + frame["own"].to_numpy()  # rows of the query's own id don't count
            enough = (np.cumsum(count[order], axis=1) >= needed[:, None]).argmax(1)
            sure = np.take_along_axis(low, order, 1)[np.arange(len(query)), enough]
            sure = np.where(count.sum() < needed, -np.inf, sure)
            q, c = np.nonzero(high >= sure[:, None])
            times = np.array([blocks[x] for x in cells])[c]
            q, c = np.repeat(q, times), np.repeat(c, times)
            piece = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
            yield pd.DataFrame(
                {
                    "query_id": frame["vec_id"].to_numpy()[q],
                    "q": [blobs[i] for i in q],
                    "home": frame["home"].to_numpy()[q],
                    "cell": np.array(cells, np.int32)[c],
                    "piece": piece.astype(np.int32),
                }
            )

    if not cells:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not sizes:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    def of_cell(counts: dict[int, int], cell: str) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair]), F.col(cell))

    part = F.pmod(F.xxhash64(F.lit(2), "query_id"), of_cell(parts, "home")).cast("int")
    routed = asked.mapInPandas(travel, "query_id bigint, q binary, home int, cell int, piece int")
    grouped = routed.withColumn("part", part).withColumn("team", of_cell(groups, "home")).drop("home")
    routed = stored(grouped, "routed")
    needed = stored(routed.select("cell", "piece", "team", "part").distinct(), "needed")
    cut = F.pmod(F.xxhash64(F.lit(3), F.monotonically_increasing_id()), of_cell(blocks, "cell")).cast("int")
    data = lookup(placed.select("vec_id", "v", "cell", cut.alias("piece")), needed, ["cell", "piece"])

    def solve(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(want):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        width = _width(list(have["v"]), list(want["q"]))
        ids = have["vec_id"].to_numpy()
        all_scores = scores(_matrix(list(want["q"]), width), _matrix(list(have["v"]), width))
        out = []
        for query, row in zip(want["query_id"].to_numpy(), all_scores):
            at = best(row, ids, query, k)
            out.append(np.stack([np.full(len(at), query), ids[at], row[at]], 1))
        return pd.DataFrame(np.concatenate(out), columns=["query_id", "vec_id", "score"])

    key = ["cell", "piece", "team", "part"]
    found = (
        data.groupBy(*key)
        .cogroup(routed.groupBy(*key))
        .applyInPandas(solve, "query_id bigint, vec_id bigint, score bigint")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
