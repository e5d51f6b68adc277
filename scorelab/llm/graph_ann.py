"""Approximate nearest neighbours by robust-pruned directed graphs.

Distinct vectors are dealt into shards of near vectors by the leaves of a tree of halvings, and
each shard gets a graph.  Nodes are added in batches: a greedy beam search from the centre
proposes neighbours, robust pruning keeps those that no kept neighbour is (by the factor alpha)
closer to, and back edges are pruned in the same way.  Queries run a beam search in the leaves
whose centres are nearest; the exact products of what they find are merged.  How many leaves and
how wide a beam is measured: some queries are answered by brute force over all vectors, and the
least of both that finds ``RECALL`` of the answers is taken, up to every leaf and ``SEARCH_BEAM``.
Largest inner product becomes smallest distance by one more coordinate that brings all vectors of
a shard to the same length.

Equal vectors form one node with its smallest ids.  A query can want no more of them, since
equal products are ranked by id, and a vector with a third of all rows stays one node.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorelab.session import materialise

NEIGHBOURS = 20
#: Vectors per shard: what one task holds and builds.  Vectors without any structure are the hard case: 20 nearest
#: of 2,048 Gaussian vectors of 64 dimensions are found with recall 0.98 at these numbers (1.00 for noisy copies),
#: with 0.46 in shards of 8,192 at degree 32 and beams of 64 and 128.
SHARD_ROWS = 2048
DEGREE, ALPHA = 64, 1.2
BUILD_BEAM, SEARCH_BEAM = 96, 384
#: Searches that run side by side and queries per block; each block of a shard's queries meets a copy of its index.
BATCH, BLOCK_ROWS = 256, 1024
#: The tree is fitted on about so many vectors, with so many of them to a leaf at least; a leaf with
#: more vectors than a shard holds is dealt into pieces by hash, and its queries search them all.
SAMPLE, LEAF_SAMPLE = 32_768, 32
#: Queries answered by brute force, what share of the answers the chosen effort finds, and the narrowest beam tried.
TRIALS, RECALL, LEAST_BEAM = 128, 0.96, 48
#: Nearest leaves searched first: what they give is the least that a find in the other leaves has to reach.
FIRST = 2


def usable(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vec): one row per id whose vector has finite components, not all of them zero.

    Null ids, null, empty and zero vectors and those with null or non-finite components take
    no part; of a repeated id the vector first in array order counts.
    """
    vec = F.col(vector).cast("array<float>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"), finite.alias("finite"), F.exists(vec, lambda x: x != 0).alias("some"))
    return rows.where("id IS NOT NULL AND vec IS NOT NULL AND finite AND some").groupBy("id").agg(F.min("vec").alias("vec"))


def classes(vectors: DataFrame, members: int) -> DataFrame:
    """(vec, ids): distinct vectors with their ``members`` smallest ids."""
    ranked = vectors.withColumn("rank", F.row_number().over(W.partitionBy("vec").orderBy("id"))).where(F.col("rank") <= members)
    return ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


class Graph:
    """Vectors of one length (float32, one row each), out-neighbours (-1: none) and the start node."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, start: int):
        self.vectors, self.edges, self.start = vectors, edges, start

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (-1: none) and products of the ``beam`` best found for each query, best first."""
        rows, nodes = len(queries), len(self.vectors)
        every = np.arange(rows)
        ids = np.full((rows, beam), -1, np.int32)
        near = np.full((rows, beam), -np.inf, np.float32)
        done = np.ones((rows, beam), bool)
        seen = np.zeros((rows, nodes + 1), bool)
        seen[:, nodes] = True
        ids[:, 0], near[:, 0], done[:, 0] = self.start, queries @ self.vectors[self.start], False
        seen[:, self.start] = True
        active = every
        while len(active):
            # Beams are sorted, so the first open entry is the nearest.
            place = (~done[active]).argmax(1)
            done[active, place] = True
            found = self.edges[ids[active, place]]
            fresh = ~seen[active[:, None], found]
            seen[active[:, None], found] = True
            products = np.einsum("rd,rnd->rn", queries[active], self.vectors[found])
            products[~fresh] = -np.inf
            all_near = np.concatenate([near[active], products], 1)
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[active] = np.take_along_axis(all_near, order, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], found], 1), order, 1)
            done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], 1), order, 1)
            active = active[~done[active].all(1)]
        ids[near == -np.inf] = -1
        return ids, near


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Per node up to ``degree`` diverse candidates (-1: none), nearest first."""
    valid = (candidates >= 0) & (candidates != nodes[:, None])
    own = vectors[candidates]
    length = float(vectors[0] @ vectors[0])
    away = 2 * (length - np.einsum("rd,rnd->rn", vectors[nodes], own))
    between = 2 * (length - own @ own.transpose(0, 2, 1))
    rows = np.arange(len(nodes))
    alive, kept = valid.copy(), np.full((len(nodes), degree), -1, np.int32)
    for k in range(degree):
        if not alive.any():
            break
        best = np.where(alive, away, np.inf).argmin(1)
        some = alive[rows, best]
        kept[some, k] = candidates[rows, best][some]
        alive &= alpha * alpha * between[rows, best] > away
        alive[rows, best] = False
        alive &= some[:, None]
    return kept


def build(vectors: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM) -> Graph:
    """Graph over vectors of equal length; added in growing batches, then gone over once more."""
    n = len(vectors)
    centre = vectors.mean(0)
    start = int((vectors @ centre).argmax())
    graph = Graph(vectors, np.full((n, degree), -1, np.int32), start)
    order = np.random.default_rng(5).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at, batches = 1, []
    while at < n:
        size = min(BATCH, max(1, at), n - at)
        batches.append(order[at : at + size])
        at += size
    for own_alpha, plan in ((1.0, batches), (alpha, [order[i : i + BATCH] for i in range(0, n, BATCH)])):
        for nodes in plan:
            _connect(graph, nodes.astype(np.int32), degree, own_alpha, beam)
    return graph


def _connect(graph: Graph, nodes: np.ndarray, degree: int, alpha: float, beam: int) -> None:
    found, _ = graph.search(graph.vectors[nodes], beam)
    # Nodes of one batch do not see each other yet; their mutual links come with the second round.
    kept = robust_prune(graph.vectors, nodes, np.concatenate([found, graph.edges[nodes]], 1), degree, alpha)
    kept = _without_repeats(kept)
    graph.edges[nodes] = kept
    sources, targets = np.repeat(nodes, degree)[kept.ravel() >= 0], kept.ravel()[kept.ravel() >= 0]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    hit, first, count = np.unique(targets, return_index=True, return_counts=True)
    for at in range(0, len(hit), BATCH):
        own, begin, many = hit[at : at + BATCH], first[at : at + BATCH], count[at : at + BATCH]
        widest = int(many.max())
        column = np.arange(widest)
        new = np.where(column < many[:, None], sources[np.minimum(begin[:, None] + column, len(sources) - 1)], -1)
        both = _without_repeats(np.concatenate([graph.edges[own], new], 1))
        full = (both >= 0).sum(1) > degree
        packed = -np.sort(-both, axis=1)[:, :degree]
        if full.any():
            for part in np.array_split(np.flatnonzero(full), max(1, full.sum() * both.shape[1] // (BATCH * 128))):
                packed[part] = robust_prune(graph.vectors, own[part], both[part], degree, alpha)
        graph.edges[own] = packed


def _without_repeats(ids: np.ndarray) -> np.ndarray:
    """Repeated ids of a row replaced by -1, first ones kept."""
    order = np.argsort(ids, axis=1, kind="stable")
    ranked = np.take_along_axis(ids, order, 1)
    repeat = np.zeros_like(ids, bool)
    np.put_along_axis(repeat, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
    return np.where(repeat, -1, ids)


def levelled(vectors: np.ndarray) -> np.ndarray:
    """One more coordinate, so that all vectors have the length of the longest."""
    squares = (vectors.astype(np.float64) ** 2).sum(1)
    return np.concatenate([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]], 1).astype(np.float32)


def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(pdf["vec"].to_numpy()).astype(np.float32)
    graph = build(levelled(vectors))
    sizes = pdf["ids"].map(len).to_numpy(np.int64)
    index = {"shard": pdf["shard"].iloc[0], "width": vectors.shape[1], "start": graph.start, "vectors": vectors.tobytes(), "edges": graph.edges.tobytes(),
             "sizes": sizes.tobytes(), "ids": np.concatenate(pdf["ids"].to_list()).astype(np.int64).tobytes()}
    return pd.DataFrame([index])


INDEX = "shard string, width int, start int, vectors binary, edges binary, sizes binary, ids binary"


class Tree:
    """Halvings of the vectors of one width along the line between two means, down to ``leaves`` leaves of equal share."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.square = float((sample.astype(np.float64) ** 2).sum(1).max()) or 1.0
        self.splits: list[tuple] = []
        self.centres: list[np.ndarray] = []
        self.root = self._grow(self._lifted(sample), leaves, np.random.default_rng(5))
        self.centres = np.stack(self.centres)
        self.pieces = np.ones(leaves, np.int64)

    def _lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors in units of the longest of the sample, with one more coordinate that brings them to its length."""
        own = vectors.astype(np.float64) / np.sqrt(self.square)
        return np.concatenate([own, np.sqrt(np.maximum(1 - (own**2).sum(1), 0))[:, None]], 1)

    def _grow(self, own: np.ndarray, leaves: int, rng) -> int:
        """Number of a split, or -1 - number of a leaf."""
        if leaves == 1:
            self.centres.append(own[:, :-1].mean(0))
            return -len(self.centres)
        means = own[rng.choice(len(own), 2, replace=False)]
        for _ in range(8):
            upper = own @ (means[1] - means[0]) > ((means[1] ** 2).sum() - (means[0] ** 2).sum()) / 2
            if upper.all() or not upper.any():
                break
            means = np.stack([own[~upper].mean(0), own[upper].mean(0)])
        line = own @ (means[1] - means[0])
        below = leaves // 2
        order = np.argsort(line, kind="stable")
        cut = len(own) * below // leaves
        number = len(self.splits)
        self.splits.append(())
        lower, upper = self._grow(own[order[:cut]], below, rng), self._grow(own[order[cut:]], leaves - below, rng)
        self.splits[number] = (means[1] - means[0], float(line[order[cut]]), lower, upper)
        return number

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        lifted, out = self._lifted(vectors), np.zeros(len(vectors), np.int64)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                line, cut, lower, upper = self.splits[node]
                above = lifted[rows] @ line >= cut
                todo += [(lower, rows[~above]), (upper, rows[above])]
        return out

    def ranked(self, queries: np.ndarray) -> np.ndarray:
        """Leaves by product with their centre, largest first."""
        return np.argsort(-(queries @ self.centres.T), axis=1, kind="stable")


def fit_trees(distinct: DataFrame, shard_rows: int) -> dict[int, Tree]:
    """A tree per width, on a sample of about ``SAMPLE`` vectors, drawn by their hash."""
    counts = {r["width"]: r["count"] for r in distinct.groupBy(F.size("vec").alias("width")).count().collect()}
    sample: dict[int, list] = {width: [] for width in counts}
    drawn, n = F.xxhash64("vec", F.lit("tree")), sum(counts.values())
    part = distinct.select("vec", drawn.alias("drawn"))
    if n > SAMPLE:
        part = part.where(F.pmod("drawn", F.lit(1 << 30)) < int(SAMPLE / n * (1 << 30)))
    rows = part.toArrow()
    vectors = rows.column("vec").to_numpy()
    for at in np.argsort(rows.column("drawn").to_numpy(), kind="stable"):
        sample[len(vectors[at])].append(vectors[at])
    trees = {}
    for width, n in counts.items():
        own = np.stack(sample[width]).astype(np.float32) if sample[width] else np.zeros((1, width), np.float32)
        leaves = max(1, min(-(-n // shard_rows), len(own) // LEAF_SAMPLE))
        trees[width] = Tree(own, leaves)
    return trees


def widths(pdf: pd.DataFrame):
    """(width, rows, vectors) for each width in the frame."""
    for width, rows in pdf.groupby(pdf["vec"].map(len)):
        yield width, rows, np.stack(rows["vec"].to_numpy()).astype(np.float32)


def deal(frames, trees: dict[int, Tree]):
    """Rows with the leaf of their vector."""
    for pdf in frames:
        for width, rows, vectors in widths(pdf):
            yield rows.assign(width=width, leaf=trees[width].leaf(vectors))


def visits(frames, trees: dict[int, Tree], probes: dict[int, int]):
    """A row per query and shard to search: all pieces of the nearest leaves, with the rank of the leaf."""
    for pdf in frames:
        for width, rows, vectors in widths(pdf):
            tree = trees.get(width)
            if tree is None:
                continue
            order = tree.ranked(vectors)[:, : probes[width]]
            for place, leaf in enumerate(order.T):
                many = tree.pieces[leaf]
                at = np.repeat(np.arange(len(rows)), many)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                yield rows.iloc[at].assign(shard=[f"{width}-{x}-{y}" for x, y in zip(leaf[at], piece)], width=width, place=place)


def build_index(vectors: DataFrame, members: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame, dict[int, Tree]]:
    """The index, one row per shard of about ``shard_rows`` vectors; every vector is indexed.

    Vectors of different width never meet, so the width is part of the shard.  The index is
    written to the shared folder and read back.  Also the distinct vectors with their leaves, and the trees.
    """
    distinct = materialise(classes(vectors, members), "vectors")
    trees = fit_trees(distinct, shard_rows)
    leaves = materialise(distinct.mapInPandas(partial(deal, trees=trees), "vec array<float>, ids array<long>, width int, leaf long"), "leaves")
    # The leaves' shares are those of the sample; a quarter more than planned is still one shard.
    pieces = leaves.groupBy("width", "leaf").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / shard_rows - 0.25)).alias("pieces"))
    for r in pieces.collect():
        trees[r.width].pieces[r.leaf] = r.pieces
    dealt = leaves.join(F.broadcast(pieces), ["width", "leaf"]).select("vec", "ids", F.concat_ws("-", "width", "leaf", F.pmod(F.xxhash64("vec"), "pieces")).alias("shard"))
    return materialise(dealt.groupBy("shard").applyInPandas(build_shard, INDEX), "index"), leaves, trees


def pack_queries(pdf: pd.DataFrame) -> pd.DataFrame:
    first = pdf.iloc[0]
    return pd.DataFrame([{"shard": first["shard"], "chunk": int(first["chunk"]), "queries": pdf["id"].to_numpy(np.int64).tobytes(), "floors": pdf["least"].to_numpy(np.float64).tobytes(),
                          "query_vectors": np.stack(pdf["vec"].to_numpy()).astype(np.float32).tobytes()}])


def best_members(query: int, vector: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, begins: np.ndarray, ids: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids among the members of the nodes, the query left out, with exact products and their nodes."""
    scores = (vectors[nodes].astype(np.float64) * vector.astype(np.float64)).sum(1)
    members = np.concatenate([ids[begins[n] : begins[n + 1]] for n in nodes])
    scores, nodes = np.repeat(scores, sizes[nodes]), np.repeat(nodes, sizes[nodes])
    other = np.flatnonzero(members != query)
    best = other[np.lexsort((members[other], -scores[other]))[:k]]
    return members[best], scores[best], nodes[best]


def search_blocks(frames, k: int, beam: int):
    """Per index row and block of queries the k best ids of each query, by exact products, down to its floor."""
    for pdf in frames:
        for row in pdf.itertuples():
            width = row.width
            vectors = np.frombuffer(row.vectors, np.float32).reshape(-1, width)
            edges = np.frombuffer(row.edges, np.int32).reshape(len(vectors), -1)
            sizes, ids = np.frombuffer(row.sizes, np.int64), np.frombuffer(row.ids, np.int64)
            begins = np.concatenate([[0], np.cumsum(sizes)])
            graph = Graph(levelled(vectors), edges, row.start)
            queries, floors = np.frombuffer(row.queries, np.int64), np.frombuffer(row.floors, np.float64)
            own = np.frombuffer(row.query_vectors, np.float32).reshape(-1, width)
            lifted = np.concatenate([own, np.zeros((len(own), 1), np.float32)], 1)
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            for at in range(0, len(queries), BATCH):
                found, _ = graph.search(lifted[at : at + BATCH], beam)
                for query, vector, floor, nodes in zip(queries[at : at + BATCH], own[at : at + BATCH], floors[at : at + BATCH], found):
                    members, scores, _ = best_members(query, vector, vectors, sizes, begins, ids, nodes[nodes >= 0], k)
                    high = scores >= floor
                    out["query_id"] += [query] * int(high.sum())
                    out["vec_id"] += members[high].tolist()
                    out["score"] += scores[high].tolist()
            yield pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


FOUND = "query_id long, vec_id long, score double"


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(wanted: DataFrame, index: DataFrame, k: int, beam: int) -> DataFrame:
    """What the rows of ``wanted`` (id, vec, shard, least) find in their shards, in blocks of queries per shard."""
    counts = wanted.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("chunks"))
    chunked = wanted.join(F.broadcast(counts), "shard").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    packed = chunked.select("shard", "chunk", "id", "vec", "least").groupBy("shard", "chunk").applyInPandas(
        pack_queries, "shard string, chunk int, queries binary, floors binary, query_vectors binary")
    copies = index.join(F.broadcast(counts), "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1))).drop("chunks")
    return packed.join(copies, ["shard", "chunk"]).mapInPandas(partial(search_blocks, k=k, beam=beam), FOUND)


def exact_blocks(frames, asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """The k best ids of each asked query in every batch, by all products, with their leaves."""
    for pdf in frames:
        for width, rows, vectors in widths(pdf):
            if width not in asked:
                continue
            sizes, ids = rows["ids"].map(len).to_numpy(np.int64), np.concatenate(rows["ids"].to_list()).astype(np.int64)
            begins, leaf = np.concatenate([[0], np.cumsum(sizes)]), rows["leaf"].to_numpy()
            queries, own = asked[width]
            products = own @ vectors.T
            # One node more than asked for: the query's own vector may hold the query alone.
            nodes = np.argpartition(-products, min(k, len(vectors) - 1), axis=1)[:, : k + 1]
            for query, vector, near in zip(queries, own, nodes):
                members, scores, held = best_members(query, vector, vectors, sizes, begins, ids, near, k)
                yield pd.DataFrame({"query_id": query, "vec_id": members, "score": scores, "width": width, "leaf": leaf[held]})


def effort(asked: DataFrame, index: DataFrame, leaves: DataFrame, trees: dict[int, Tree], k: int, beam: int) -> tuple[dict[int, int], int]:
    """Leaves to search per width and the width of the beam, so that trial queries find ``RECALL`` of their answers.

    A table of single shards is searched in full width.
    """
    probes = {width: len(tree.centres) for width, tree in trees.items()}
    if all(tree.pieces.sum() == 1 for tree in trees.values()):
        return probes, beam
    trials = asked.orderBy(F.xxhash64("id")).limit(TRIALS).toPandas()
    trials = trials[trials["vec"].map(len).isin(list(trees))]
    own = {width: (rows["id"].to_numpy(np.int64), vectors) for width, rows, vectors in widths(trials)}
    exact = ranked(leaves.mapInPandas(partial(exact_blocks, asked=own, k=k), f"{FOUND}, width int, leaf long"), k).toPandas()
    if exact.empty:
        return probes, beam
    # Half of what may be missed goes to the leaves left out, half to the beam.
    for width, rows in exact.groupby("width"):
        queries, vectors = own[width]
        places = np.argsort(trees[width].ranked(vectors), axis=1)
        at = {query: i for i, query in enumerate(queries)}
        reach = np.sort(places[[at[q] for q in rows["query_id"]], rows["leaf"].to_numpy()])
        probes[width] = int(reach[min(len(reach) - 1, int(len(reach) * (1 + RECALL) / 2))]) + 1
    answers = set(zip(exact["query_id"], exact["vec_id"]))
    schema = "id long, vec array<float>"
    routed = materialise(asked.sparkSession.createDataFrame(trials, schema).mapInPandas(partial(visits, trees=trees, probes=probes), VISIT).withColumn("least", F.lit(float("-inf"))), "trials")
    tried = min(LEAST_BEAM, beam)
    while tried < beam:
        found = ranked(search(routed, index, k, tried), k).select("query_id", "vec_id").toPandas()
        if len(answers & set(zip(found["query_id"], found["vec_id"]))) >= RECALL * len(answers):
            break
        tried = min(beam, 2 * tried)
    return probes, tried


VISIT = "id long, vec array<float>, shard string, width int, place int"


def nearest(table: DataFrame, queries: DataFrame | None = None, k: int = NEIGHBOURS, every: int = 20, beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query.

    Queries are the usable rows of ``queries``, by default those of ``table`` whose id is
    divisible by ``every``; they go to the leaves of near vectors in blocks, with beams of
    ``beam`` at most (see ``effort``).  Ties go to the smaller id.  A table without usable
    vectors, or a query without another vector, gives no rows.  Other columns are ignored.
    """
    vectors = materialise(usable(table), "usable")
    asked = materialise(usable(queries), "queries") if queries is not None else vectors.where(F.col("id") % every == 0)
    index, leaves, trees = build_index(vectors, k + 1, shard_rows)
    probes, beam = effort(asked, index, leaves, trees, k, beam)
    routed = asked.select("id", "vec").mapInPandas(partial(visits, trees=trees, probes=probes), VISIT)
    found = search(routed.where(F.col("place") < FIRST).withColumn("least", F.lit(float("-inf"))), index, k, beam)
    if max(probes.values(), default=0) > FIRST:
        found = materialise(ranked(found, k).drop("rank"), "first")
        # A query with fewer than k finds has no floor; equal products go on, their ids decide.
        floors = found.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least"))
        rest = routed.where(F.col("place") >= FIRST).join(floors, "id", "left").fillna(float("-inf"), "least")
        found = found.unionByName(search(rest, index, k, beam))
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")
