"""Approximate nearest neighbours by robust-pruned directed graphs, one a shard.

Equal vectors become one point. Points are dealt to shards of bounded size by
the hash of their content. Each shard links its points: a greedy search from the shard's
medoid proposes neighbours for a point, and pruning keeps, nearest first, those
that no kept one is closer to by the factor ``alpha``. A query walks each shard's graph
with a beam. Both run for many points at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from annoflow.session import written

#: Points of a shard and queries of a block: what one task holds at a time.
SHARD_POINTS = 4096
BLOCK_QUERIES = 1024


def distances(points: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its row of point numbers; -1 is infinitely far."""
    apart = points[ids] - queries[:, None, :]
    found = np.einsum("qkd,qkd->qk", apart, apart)
    found[ids < 0] = np.inf
    return found


def beam_search(
    points: np.ndarray, links: np.ndarray, entry: int, queries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest points met by a greedy walk from ``entry``, for all
    queries at once: numbers and squared distances, nearest first, -1 where fewer."""
    many = len(queries)
    beam = np.full((many, width), -1)
    far = np.full((many, width), np.inf, points.dtype)
    done = np.ones((many, width), bool)
    beam[:, 0], done[:, 0] = entry, False
    far[:, 0] = distances(points, queries, beam[:, :1])[:, 0]
    active = np.arange(many)
    while len(active):
        first = (~done[active]).argmax(1)
        done[active, first] = True
        nodes = beam[active, first]
        new = links[nodes]
        held = beam[active]
        new = np.where((new[:, :, None] == held[:, None, :]).any(2), -1, new)
        both = np.concatenate([held, new], 1)
        reach = np.concatenate([far[active], distances(points, queries[active], new)], 1)
        seen = np.concatenate([done[active], new < 0], 1)
        order = np.argsort(reach, 1, kind="stable")[:, :width]
        beam[active] = np.take_along_axis(both, order, 1)
        far[active] = np.take_along_axis(reach, order, 1)
        done[active] = np.take_along_axis(seen, order, 1) | (np.take_along_axis(both, order, 1) < 0)
        active = active[~done[active].all(1)]
    return beam, far


def prune(
    points: np.ndarray, nodes: np.ndarray, ids: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """Robust pruning of the candidates ``ids`` (rows, -1 for none) of ``nodes``."""
    own = points[nodes]
    order = np.sort(ids, 1)
    repeated = np.concatenate([np.zeros((len(ids), 1), bool), order[:, 1:] == order[:, :-1]], 1)
    ids = np.where(repeated | (order == nodes[:, None]), -1, order)
    reach = distances(points, own, ids)
    order = np.argsort(reach, 1, kind="stable")
    ids, reach = np.take_along_axis(ids, order, 1), np.take_along_axis(reach, order, 1)
    vectors = points[ids]
    lengths = np.einsum("qkd,qkd->qk", vectors, vectors)
    between = lengths[:, :, None] + lengths[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    alive = ids >= 0
    kept = np.full((len(ids), degree), -1)
    count = np.zeros(len(ids), int)
    rows = np.arange(len(ids))
    for _ in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        pick = alive.argmax(1)
        r, p = rows[some], pick[some]
        kept[r, count[some]] = ids[r, p]
        count[some] += 1
        alive[r, p] = False
        alive[r] &= alpha * alpha * np.maximum(between[r, p], 0) > reach[r]
    return kept


def build_graph(
    points: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2, block: int = 256
) -> tuple[np.ndarray, int]:
    """Out-links of every point (-1 for none) and the entry point (the medoid).

    The graph grows by blocks of points; a second pass, with ``alpha`` relaxed,
    goes over all points again. Back-links that overfill a point are pruned.
    """
    n = len(points)
    links = np.full((n, degree), -1)
    if not n:
        return links, -1
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    for relaxed in (1.0, alpha):
        at = 1 if relaxed == 1.0 else 0
        while at < n:
            size = min(block, max(1, at)) if relaxed == 1.0 else block
            nodes = order[at : at + size]
            at += size
            found, _ = beam_search(points, links, entry, points[nodes], width)
            links[nodes] = prune(points, nodes, np.concatenate([found, links[nodes]], 1), degree, relaxed)
            source = np.repeat(nodes, degree)
            target = links[nodes].ravel()
            source, target = source[target >= 0], target[target >= 0]
            known = (links[target] == source[:, None]).any(1)
            source, target = source[~known], target[~known]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            heads, starts, counts = np.unique(target, return_index=True, return_counts=True)
            more = np.full((len(heads), int(counts.max(initial=0))), -1)
            more[np.repeat(np.arange(len(heads)), counts), np.arange(len(target)) - np.repeat(starts, counts)] = source
            held = (links[heads] >= 0).sum(1)
            room = held + counts <= degree
            for h in np.flatnonzero(room):
                links[heads[h], held[h] : held[h] + counts[h]] = more[h, : counts[h]]
            full = np.flatnonzero(~room)
            for part in np.array_split(full, max(1, len(full) // block)):
                if len(part):
                    h = heads[part]
                    links[h] = prune(points, h, np.concatenate([links[h], more[part]], 1), degree, relaxed)
    return links, entry


def usable(vector) -> F.Column:
    """Whether a vector takes part: not null, empty or zero, all components finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_points: int = SHARD_POINTS, degree: int = 32, width: int = 64, alpha: float = 1.2, search_width: int = 112,
) -> DataFrame:
    """``k`` nearest rows to each row for which ``is_query`` (a condition on the ID
    column) holds, itself apart: query_id, rank from 1, vec_id, score (Euclidean
    distance in double precision), ties to the smaller ID.

    Vectors that are null, empty, zero or hold null or non-finite components take
    no part, nor do rows without an ID; all others must have one length. Rows with
    equal vectors are all found; rows that repeat an ID count once. No rows: no result.
    """
    spark = rows.sparkSession
    clean = (
        rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("vector"))
        .where(F.col("id").isNotNull() & usable(F.col("vector")))
        .withColumn("point", F.sha2(F.array_join(F.transform("vector", lambda x: x + F.lit(0.0)), ",").cast("binary"), 256))
        .dropDuplicates(["id"])
    )
    # of one point only the k + 1 smallest IDs can be among anyone's k nearest
    first = Window.partitionBy("point").orderBy("id")
    members = clean.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    members = written(members.select("id", "point", "vector", "n"), "graph-members")
    points = members.where("n = 1").select("point", "vector")
    total = points.count()
    shards = max(1, -(-total // shard_points))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("point"), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        vectors = _matrix(group["vector"])
        graph, entry = build_graph(vectors.astype(np.float32), degree, width, alpha)
        return pa.table({
            "shard": pa.array([group["shard"][0].as_py()], pa.int32()),
            "n": pa.array([len(vectors)], pa.int32()),
            "entry": pa.array([entry], pa.int32()),
            "points": pa.array(["".join(group["point"].to_pylist()).encode()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "links": pa.array([graph.astype(np.int32).tobytes()], pa.binary()),
        })

    graphs = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(
        build, "shard int, n int, entry int, points binary, vectors binary, links binary"
    )
    graphs = written(graphs, "graphs")

    asked = clean.where(is_query(F.col("id"))).select("id", "point", "vector")
    count = asked.count()
    blocks = max(1, -(-count // BLOCK_QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    pairs = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    by_block = asked.groupBy("block").agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    work = pairs.join(by_block, "block").repartition(max(1, min(shards * blocks, 4096)), "shard", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, ids = row["n"], [q["id"] for q in row["queries"]]
                vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, -1)
                graph = np.frombuffer(row["links"], np.int32).reshape(n, -1)
                names = [row["points"][i * 64 : i * 64 + 64].decode() for i in range(n)]
                wanted = np.array([q["vector"] for q in row["queries"]])
                beam = max(search_width, 2 * k + 2)
                found, _ = beam_search(vectors.astype(np.float32), graph, row["entry"], wanted.astype(np.float32), beam)
                # the walk goes by single precision; what it met is measured in double
                far = np.sqrt(distances(vectors, wanted, found))
                order = np.argsort(far, 1, kind="stable")[:, : k + 1]
                found, far = np.take_along_axis(found, order, 1), np.take_along_axis(far, order, 1)
                q, c = np.nonzero(found >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in q], pa.int64()), pa.array([names[i] for i in found[q, c]], pa.string()),
                     pa.array(far[q, c], pa.float64())], names=["query_id", "point", "score"],
                )

    met = work.mapInArrow(search, "query_id long, point string, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    expanded = met.join(members.select("point", F.col("id").alias("vec_id")), "point").where("query_id != vec_id")
    return (
        expanded.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
