"""Projection graphs, label propagation, components, betweenness and modularity.

Undirected edges are distinct rows (src, dst) with src < dst.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataglean.session import cut_lineage
from strataglean.skew import add_part, broadcast_checked, co_occurrence, dense_number, hot_parts, running_sum

# Neighbours of one node handled by one task in a breadth-first step.
HUB_ROWS = 4096
# Rows (root, node) that breadth-first steps hold at a time.
STATE_ROWS = 50_000_000
# Nodes and edges of a component that one task holds; roots, and cells of a table of roots and nodes, that it handles at a time.
MATRIX_NODES, MATRIX_EDGES, MATRIX_ROOTS, MATRIX_CELLS = 16384, 8_000_000, 256, 1_500_000
# Nodes whose links are a matrix at a time, and edges whose credits are one row.
BLOCK_ROWS, SLICE_EDGES = 512, 250_000
# Multiplications that one task does for a component's roots, and tasks of a component at most, since each has all its edges.
PART_WORK, MOST_PARTS = 2e10, 24
# Edges of a component that one task cuts to the end.
SMALL_EDGES = 2000


def co_pair_edges(
    pairs: DataFrame, group: str, member: str, threshold: int, directed: bool = False
) -> DataFrame:
    """``src, dst, shared`` for members that share at least ``threshold`` groups."""
    found = co_occurrence(pairs, group, member, threshold).select(
        F.col("member_1").alias("src"), F.col("member_2").alias("dst"), "shared"
    )
    return found.unionByName(swapped(found)) if directed else found


def swapped(edges: DataFrame) -> DataFrame:
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)


def both_ways(edges: DataFrame) -> DataFrame:
    plain = edges.select("src", "dst")
    return plain.unionByName(swapped(plain))


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct ``id`` of nodes with an edge."""
    return both_ways(edges).select(F.col("src").alias("id")).distinct()


def label_propagation(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """``id, label`` after synchronous rounds; the most frequent neighbour label, ties to the smallest."""
    links = cut_lineage(both_ways(edges))
    labels = links.select(F.col("src").alias("id")).distinct().withColumn("label", F.col("id"))
    for _ in range(rounds):
        votes = (
            links.join(labels.withColumnRenamed("id", "src"), "src")
            .groupBy(F.col("dst").alias("id"), "label").agg(F.count(F.lit(1)).alias("votes"))
        )
        labels = cut_lineage(
            votes.groupBy("id").agg(F.min_by("label", F.struct(-F.col("votes"), "label")).alias("label"))
        )
    return labels


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component``: the smallest id that can be reached.

    Each round takes the least component among a node and its neighbours and
    then jumps to that component's own component, so long paths shrink by
    halves; the driver sees one count per round.
    """
    links = cut_lineage(both_ways(edges))
    state = cut_lineage(
        links.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("near"))
        .select("id", F.least("id", "near").alias("component"))
    )
    while True:
        near = (
            links.join(state.select(F.col("id").alias("src"), "component"), "src")
            .groupBy(F.col("dst").alias("id")).agg(F.min("component").alias("near"))
        )
        hooked = state.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        # One row per component in use, so a giant component is looked up once.
        heads = (
            hooked.select("component").distinct()
            .join(hooked.select(F.col("id").alias("component"), F.col("component").alias("head")),
                  "component")
        )
        moved = cut_lineage(
            hooked.join(heads, "component").select(
                "id", "old", F.least("component", "head").alias("component")
            )
        )
        state = moved.select("id", "component")
        if moved.filter("component <> old").isEmpty():
            return state


def _hubs(edges: DataFrame) -> DataFrame | None:
    return hot_parts(both_ways(edges), ["src"], HUB_ROWS)


def _spread_links(edges: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """``src, part, dst, dst_parts``: neighbours of a hub lie in several parts.

    A frontier row of the hub is repeated once per part, so that no task
    expands the whole neighbourhood for all roots.
    """
    links = add_part(both_ways(edges), hubs, ["src"], "dst").select("src", "part", "dst")
    if hubs is None:
        links = links.withColumn("dst_parts", F.lit(1))
    else:
        ends = hubs.select(F.col("src").alias("dst"), F.col("parts").alias("dst_parts"))
        links = links.join(ends, "dst", "left").withColumn(
            "dst_parts", F.coalesce("dst_parts", F.lit(1)))
    # Small graphs travel to the frontier; larger ones are joined by shuffle.
    return broadcast_checked(cut_lineage(links))


def _expand(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Join rows (.., node, parts) to the neighbours ``dst, dst_parts`` of their node."""
    spread = rows.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    return spread.join(links.withColumnRenamed("src", "node"), ["node", "part"]).drop("part")


def _bfs_levels(links: DataFrame, roots: DataFrame, wanted: DataFrame | None = None) -> list[DataFrame]:
    """Per distance: ``root, node, parts, paths`` with the number of shortest paths.

    With ``wanted`` (root, node) a root's search ends where all its wanted nodes are found.
    """
    own = links.groupBy(F.col("src").alias("root")).agg((F.max("part") + 1).alias("parts"))
    level = cut_lineage(
        roots.select(F.col("id").alias("root")).join(own, "root")
        .select("root", F.col("root").alias("node"), "parts", F.lit(1.0).alias("paths"))
    )
    levels = [level]
    while True:
        # A neighbour of distance d lies at d-1, d or d+1: what is not in the last
        # two levels is new. One grouping both adds up paths and finds that out.
        seen = reduce(DataFrame.unionByName, levels[-2:]).select(
            "root", "node", "parts", F.lit(0.0).alias("paths"), F.lit(True).alias("old"))
        front = level
        if wanted is not None:
            wanted = cut_lineage(wanted.join(level.select("root", "node"), ["root", "node"], "left_anti"))
            front = level.join(wanted.select("root").distinct(), "root", "left_semi")
        found = _expand(front, links).select(
            "root", F.col("dst").alias("node"), F.col("dst_parts").alias("parts"), "paths",
            F.lit(False).alias("old"))
        level = cut_lineage(
            found.unionByName(seen).groupBy("root", "node")
            .agg(F.max("parts").alias("parts"), F.sum("paths").alias("paths"), F.max("old").alias("old"))
            .filter(~F.col("old")).drop("old")
        )
        if level.isEmpty():
            return levels
        levels.append(level)


def bfs_path_counts(
    edges: DataFrame, roots: DataFrame | None = None, matrix_nodes: int = MATRIX_NODES
) -> DataFrame:
    """``root, node, dist, n_paths`` for every node reached from every root.

    Paths are counted in floating point: exact up to 2^53, rounded beyond. Components of at most
    ``matrix_nodes`` nodes are searched by tasks that hold the whole component and a share of its roots.
    """
    small, edges, roots = _by_size(edges, roots, matrix_nodes)
    found = []
    if small is not None:
        kind = small.schema["nodes"].dataType.elementType.simpleString()
        found.append(small.mapInArrow(_paths_of, f"root {kind}, node {kind}, dist bigint, n_paths double"))
    if edges is not None:
        levels = _bfs_levels(_spread_links(edges, _hubs(edges)), roots)
        found += [
            level.select("root", "node", F.lit(d).cast("bigint").alias("dist"), F.col("paths").alias("n_paths"))
            for d, level in enumerate(levels)
        ]
    return reduce(DataFrame.unionByName, found)


def _by_size(
    edges: DataFrame, roots: DataFrame | None, matrix_nodes: int
) -> tuple[DataFrame | None, DataFrame | None, DataFrame]:
    """(components that a task can hold, a row per share of their roots; edges of the others; roots in the others)."""
    edges = cut_lineage(edges.select("src", "dst"))
    roots = vertices(edges) if roots is None else roots.select("id")
    component = connected_components(edges)
    own = component.withColumnRenamed("id", "src")
    links = edges.join(own, "src").groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    work = F.col("n").cast("double") * F.col("n") * F.col("n") / PART_WORK
    sizes = cut_lineage(
        component.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= matrix_nodes)
        .join(links.filter(F.col("m") <= MATRIX_EDGES), "component")
        .select("component", F.least(F.lit(MOST_PARTS), F.ceil(work)).cast("int").alias("parts")))
    few = cut_lineage(component.join(sizes, "component").select("id", "component", "parts"))
    parts = sizes.agg(F.sum("parts")).first()[0]
    if parts is None:
        return None, edges, roots
    inside = edges.join(few.withColumnRenamed("id", "src"), "src").select("component", "parts", "src", "dst")
    own = roots.join(few, "id").select(
        "component", "parts", F.col("id").alias("src"), F.lit(None).cast(edges.schema["dst"].dataType).alias("dst"))
    left = cut_lineage(edges.join(few.withColumnRenamed("id", "src"), "src", "left_anti"))
    kind = edges.schema["src"].dataType.simpleString()
    packed = inside.unionByName(own).groupBy("component").applyInArrow(
        _packed, f"number binary, part int, nodes array<{kind}>, starts binary, ends binary, roots binary")
    tasks = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(4 * parts, 512))
    return (packed.repartition(tasks, "number", "part"), None if left.isEmpty() else left, roots.join(few, "id", "left_anti"))


def _packed(table: pa.Table) -> pa.Table:
    """A component as the places of each node's neighbours, repeated with each part of its roots."""
    ends = table.filter(table["dst"].is_valid())
    nodes = pa.chunked_array([*ends["src"].chunks, *ends["dst"].chunks]).unique().sort()
    a, b, roots = (pa.compute.index_in(c, nodes).to_numpy().astype(np.int64) for c in (
        ends["src"], ends["dst"], table.filter(table["dst"].is_null())["src"]))
    n, parts = len(nodes), table["parts"][0].as_py()
    near = np.unique(np.concatenate([a * n + b, b * n + a]))
    starts = np.searchsorted(near, np.arange(n + 1) * n).astype(np.int64)
    near = (near % n).astype(np.uint16 if n <= 1 << 16 else np.int64)
    name = table["component"][:1].cast(pa.string())[0].as_py().encode()
    return pa.table({
        "number": pa.array([name] * parts, pa.binary()), "part": pa.array(range(parts), pa.int32()),
        "nodes": pa.array([nodes.to_pylist()] * parts, pa.list_(nodes.type)), "starts": pa.array([starts.tobytes()] * parts, pa.binary()),
        "ends": pa.array([near.tobytes()] * parts, pa.binary()),
        "roots": pa.array([roots[p::parts].tobytes() for p in range(parts)], pa.binary())})


class _Component:
    """A component in memory: ``ends[starts[i]:starts[i + 1]]`` are the neighbours of node i."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        value = {name: batch.column(name)[row] for name in ("part", "nodes", "starts", "ends", "roots")}
        self.part, self.nodes = value["part"].as_py(), value["nodes"].values
        self.starts, self.roots = (np.frombuffer(value[c].as_py(), np.int64) for c in ("starts", "roots"))
        self.size = len(self.nodes)
        self.ends = np.frombuffer(value["ends"].as_py(), np.uint16 if self.size <= 1 << 16 else np.int64)

    def batches(self) -> Iterator[np.ndarray]:
        """The roots, as many at a time as keep a table of roots and nodes small."""
        step = min(MATRIX_ROOTS, max(16, MATRIX_CELLS // self.size))
        return (self.roots[a : a + step] for a in range(0, len(self.roots), step))

    def blocks(self, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(part of ``rows``, places of their links, row of each link in the part, its end)."""
        for a in range(0, len(rows), BLOCK_ROWS):
            own = rows[a : a + BLOCK_ROWS]
            count = self.starts[own + 1] - self.starts[own]
            row = np.repeat(np.arange(len(own)), count)
            at = np.arange(len(row)) + np.repeat(self.starts[own] - np.cumsum(count) + count, count)
            yield slice(a, a + len(own)), at, row, self.ends[at]

    def search(self, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(distances, path counts) of all nodes from each root, and the nodes that lie at each distance of any."""
        rows = np.arange(len(roots))
        far, paths = np.full((len(roots), self.size), -1, np.int32), np.zeros((len(roots), self.size))
        far[rows, roots], paths[rows, roots] = 0, 1.0
        places = []
        while True:
            here = np.flatnonzero((far == len(places)).any(axis=0))
            if len(here):
                places.append(here)
            if not len(here) or (far >= 0).all():
                return far, paths, places
            front, found = np.where(far[:, here] == len(places) - 1, paths[:, here], 0.0), np.zeros_like(paths)
            for part, _, row, end in self.blocks(here):
                links = np.zeros((part.stop - part.start, self.size))
                links[row, end] = 1.0
                found += front[:, part] @ links
            new = (far < 0) & (found > 0)
            far[new], paths[new] = len(places), found[new]

    def credit(self) -> np.ndarray:
        """The credit of each link, in the order of ``ends``, summed over the roots."""
        total = np.zeros(len(self.ends))
        for roots in self.batches():
            far, paths, places = self.search(roots)
            score = np.zeros_like(paths)
            for d in range(len(places) - 1, 0, -1):
                low, high = places[d], places[d - 1]
                flow = np.divide(1.0 + score[:, low], paths[:, low], where=far[:, low] == d, out=np.zeros((len(far), len(low))))
                above = np.where(far[:, high] == d - 1, paths[:, high], 0.0)
                column = np.full(self.size, -1)
                column[high] = np.arange(len(high))
                given = np.zeros_like(above)
                for part, at, row, end in self.blocks(low):
                    end = column[end]
                    at, row, end = at[end >= 0], row[end >= 0], end[end >= 0]
                    total[at] += (flow[:, part].T @ above)[row, end]
                    if d > 1:
                        links = np.zeros((part.stop - part.start, len(high)))
                        links[row, end] = 1.0
                        given += flow[:, part] @ links
                score[:, high] += given * above
        return total


def _paths_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``root, node, dist, n_paths`` of each component's share of roots."""
    for batch in batches:
        for component in (_Component(batch, i) for i in range(batch.num_rows)):
            for roots in component.batches():
                far, paths, _ = component.search(roots)
                at, node = np.nonzero(far >= 0)
                yield pa.RecordBatch.from_arrays([
                    component.nodes.take(pa.array(roots[at])), component.nodes.take(pa.array(node)),
                    pa.array(far[at, node].astype(np.int64)), pa.array(paths[at, node])], ["root", "node", "dist", "n_paths"])


def _credit_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Credits of a component's edges by its share of roots, some edges a row; their nodes are named with the first share."""
    for batch in batches:
        for i in range(batch.num_rows):
            component = _Component(batch, i)
            credit = component.credit()
            src = np.repeat(np.arange(component.size), np.diff(component.starts))
            # Links by their end, then their start: the way back of each link, in the order of the links.
            credit, first = credit + credit[np.argsort(component.ends, kind="stable")], src < component.ends
            credit, src, dst = credit[first], src[first], component.ends[first].astype(np.int64)
            for a in range(0, len(credit), SLICE_EDGES):
                some = slice(a, a + SLICE_EDGES)
                ends = [component.nodes.take(pa.array(x[some])) for x in (src, dst)]
                none = pa.nulls(1, pa.list_(component.nodes.type))
                named = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) if component.part == 0 else none for x in ends]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("number").slice(i, 1), pa.array([a // SLICE_EDGES], pa.int32()), *named,
                     pa.array([credit[some].tobytes()], pa.binary())], ["number", "slice", "src", "dst", "credit"])


def _summed(table: pa.Table) -> pa.Table:
    """``src, dst, credit`` of some edges, from the credits by all shares of roots."""
    named = table.filter(table["src"].is_valid())
    credit = np.sum([np.frombuffer(x.as_py(), np.float64) for x in table["credit"]], axis=0)
    return pa.table({"src": named["src"][0].values, "dst": named["dst"][0].values, "credit": pa.array(credit)})


def _edge_credit(links: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``src, dst, credit`` summed over the roots, from the farthest level up."""
    score, credits = None, []
    for d in range(len(levels) - 1, 0, -1):
        below = levels[d]
        if score is None:
            below = below.withColumn("flow", F.lit(1.0) / F.col("paths"))
        else:
            below = below.join(score, ["root", "node"], "left").withColumn(
                "flow", (F.lit(1.0) + F.coalesce("score", F.lit(0.0))) / F.col("paths")
            )
        above = levels[d - 1].select("root", F.col("node").alias("dst"), F.col("paths").alias("above"))
        credit = (
            _expand(below.select("root", "node", "parts", "flow"), links)
            .join(above, ["root", "dst"])
            .select("root", "node", F.col("dst").alias("parent"),
                    (F.col("flow") * F.col("above")).alias("credit"))
        )
        if d > 1:
            credit = cut_lineage(credit)
            score = credit.groupBy("root", F.col("parent").alias("node")).agg(
                F.sum("credit").alias("score")
            )
        credits.append(
            credit.select(F.least("node", "parent").alias("src"),
                          F.greatest("node", "parent").alias("dst"), "credit")
        )
    if not credits:
        return links.select("src", "dst", F.lit(0.0).alias("credit")).limit(0)
    return reduce(DataFrame.unionByName, credits).groupBy("src", "dst").agg(
        F.sum("credit").alias("credit")
    )


def edge_betweenness(
    edges: DataFrame, roots: DataFrame | None = None, root_batches: int | None = None,
    matrix_nodes: int = MATRIX_NODES
) -> DataFrame:
    """``src, dst, betweenness``: shortest-path credit of each edge over all roots, halved.

    Components of at most ``matrix_nodes`` nodes are scored by tasks that hold the whole component. For the others
    state is one row per (root, node); the roots go in batches, by default so many that
    a batch has at most about STATE_ROWS rows. The result does not depend on it.
    """
    small, edges, chosen = _by_size(edges, roots, matrix_nodes)
    parts = []
    if small is not None:
        kind = small.schema["nodes"].dataType.elementType.simpleString()
        shares = small.mapInArrow(_credit_of, f"number binary, slice int, src array<{kind}>, dst array<{kind}>, credit binary")
        parts.append(shares.groupBy("number", "slice").applyInArrow(_summed, f"src {kind}, dst {kind}, credit double"))
    if edges is not None:
        parts.append(_credit_by_rows(edges, chosen, root_batches))
    return reduce(DataFrame.unionByName, parts).select(
        "src", "dst", (F.col("credit") / 2).alias("betweenness")).filter(F.col("betweenness") != 0)


def _credit_by_rows(edges: DataFrame, chosen: DataFrame, root_batches: int | None) -> DataFrame:
    """``src, dst, credit`` by breadth-first steps over the tables."""
    links = _spread_links(edges, _hubs(edges))
    if root_batches is None:
        root_batches = max(1, -(-chosen.count() * vertices(edges).count() // STATE_ROWS))
    if root_batches == 1:
        return _edge_credit(links, _bfs_levels(links, chosen))
    chosen = cut_lineage(chosen)
    batch = F.pmod(F.xxhash64("id"), F.lit(root_batches))
    parts = [
        cut_lineage(_edge_credit(links, _bfs_levels(links, chosen.filter(batch == b))))
        for b in range(root_batches)
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("src", "dst").agg(F.sum("credit").alias("credit"))


def vertex_diameter_bound(edges: DataFrame, component: DataFrame | None = None) -> int:
    """Nodes that a shortest path of the graph has at most.

    In a component no path is longer than twice the distance from one of its nodes to the farthest one.
    """
    component = connected_components(edges) if component is None else component
    starts = component.select(F.col("component").alias("id")).distinct()
    levels = _bfs_levels(_spread_links(edges, _hubs(edges)), starts)
    return 2 * (len(levels) - 1) + 1


def sample_bound(diameter: int, eps: float, delta: float) -> int:
    """Paths that are enough for an error of ``eps`` at every edge with probability 1 - ``delta``.

    The sets of paths through an edge have a Vapnik-Chervonenkis dimension of at most
    floor(log2(edges of the longest path)) + 1.
    """
    dimension = math.floor(math.log2(max(diameter - 1, 1))) + 1
    return math.ceil(0.5 / eps**2 * (dimension + math.log(1 / delta)))


def _uniform(*columns) -> Column:
    """A number in (0, 1) that the columns determine."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / float(1 << 53)


def _both_ends(links: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Searches from both ends of each of ``pairs`` (sample, root, target) until they meet.

    Returns ``sample, side, at, node, parts, paths``, the levels from the root (side 0) and the target (side 1) with the
    number of shortest paths from there, and ``sample, ahead, behind``: the levels of both sides that met. In each
    round the side with fewer nodes goes on. Pairs without a path meet nowhere.
    """
    own = links.groupBy(F.col("src").alias("node")).agg((F.max("part") + 1).alias("parts"))
    start = pairs.select("sample", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("root").alias("node")), F.struct(F.lit(1).alias("side"), F.col("target").alias("node")))).alias("s"))
    # The last level of each side, and the one before it (not ``last``), of the pairs that have not met.
    state = cut_lineage(start.select("sample", "s.*").join(own, "node").select(
        "sample", "side", F.lit(0).alias("at"), "node", "parts", F.lit(1.0).alias("paths"), F.lit(True).alias("last")))
    every, met = [state.drop("last")], []
    while True:
        sizes = state.filter("last").groupBy("sample").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
        turn = cut_lineage(sizes.filter("a > 0 and b > 0").select("sample", (F.col("a") > F.col("b")).cast("int").alias("goes")))
        placed = state.join(turn, "sample")
        moving, resting = placed.filter("side = goes").drop("goes"), placed.filter("side <> goes").drop("goes")
        # A neighbour of the last level lies in it, in the one before, or is new.
        found = _expand(moving.filter("last").drop("last"), links).select(
            "sample", "side", (F.col("at") + 1).alias("at"), F.col("dst").alias("node"), F.col("dst_parts").alias("parts"), "paths",
            F.lit(False).alias("old"))
        seen = moving.drop("last").withColumn("paths", F.lit(0.0)).withColumn("old", F.lit(True))
        new = cut_lineage(
            found.unionByName(seen).groupBy("sample", "side", "node")
            .agg(F.max("at").alias("at"), F.max("parts").alias("parts"), F.sum("paths").alias("paths"), F.max("old").alias("old"))
            .filter(~F.col("old")).drop("old"))
        if new.isEmpty():
            break
        here = cut_lineage(new.select("sample", "node", "side", "at").join(
            resting.filter("last").select("sample", "node", F.col("at").alias("other")), ["sample", "node"]).groupBy("sample").agg(
            F.max(F.when(F.col("side") == 0, F.col("at")).otherwise(F.col("other"))).alias("ahead"),
            F.max(F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("at"))).alias("behind")))
        every.append(new)
        met.append(here)
        before = moving.filter("last").withColumn("last", F.lit(False))
        state = cut_lineage(new.withColumn("last", F.lit(True)).unionByName(before).unionByName(resting).join(here, "sample", "left_anti"))
    none = state.limit(0).select("sample", F.col("at").alias("ahead"), F.col("at").alias("behind"))
    return reduce(DataFrame.unionByName, every), cut_lineage(reduce(DataFrame.unionByName, met, none))


def _walk_back(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """``src, dst, sample``: the edges of one shortest path for each of ``pairs`` (sample, root, target).

    From the target on, a parent is chosen with a probability in proportion to its paths, so each of the
    shortest paths is equally likely. Pairs without a path have no edges.
    """
    levels, met = _both_ends(links, pairs)
    levels = levels.join(met.withColumn("far", F.col("ahead") + F.col("behind")), "sample")
    # Nodes by their distance from the root: all as far as that side came, then those on shortest paths, which both sides know.
    ahead = levels.filter((F.col("side") == 0) & (F.col("at") <= F.col("ahead")))
    behind = levels.filter(F.col("side") == 1).select("sample", (F.col("far") - F.col("at")).alias("at"), "node")
    known = [ahead.select("sample", "at", "node", "paths")]
    last = cut_lineage(ahead.filter((F.col("at") == F.col("ahead")) & (F.col("at") < F.col("far") - 1))
                       .join(behind, ["sample", "at", "node"]).select("sample", "at", "node", "parts", "paths", "far"))
    while not last.isEmpty():
        found = _expand(last, links).select(
            "sample", (F.col("at") + 1).alias("at"), F.col("dst").alias("node"), F.col("dst_parts").alias("parts"), "paths", "far")
        found = cut_lineage(found.join(behind, ["sample", "at", "node"], "left_semi").groupBy("sample", "at", "node").agg(
            F.max("parts").alias("parts"), F.sum("paths").alias("paths"), F.max("far").alias("far")))
        known.append(found.select("sample", "at", "node", "paths"))
        last = found.filter(F.col("at") < F.col("far") - 1)
    above = cut_lineage(reduce(DataFrame.unionByName, known))
    ends = cut_lineage(levels.filter((F.col("side") == 1) & (F.col("at") == 0)).select("sample", "node", "parts", "far"))
    walks, steps = None, []
    for d in range(met.agg(F.max(F.col("ahead") + F.col("behind"))).first()[0] or 0, 0, -1):
        here = ends.filter(F.col("far") == d).select("sample", "node", "parts")
        here = here if walks is None else here.unionByName(walks)
        race = -F.log(_uniform("sample", "dst", F.lit(d))) / F.col("above")
        chosen = cut_lineage(
            _expand(here, links)
            .join(above.filter(F.col("at") == d - 1).select("sample", F.col("node").alias("dst"), F.col("paths").alias("above")), ["sample", "dst"])
            .groupBy("sample", "node").agg(F.min(F.struct(race.alias("race"), "dst", "dst_parts")).alias("parent"))
            .select("sample", "node", "parent.dst", "parent.dst_parts"))
        walks = chosen.select("sample", F.col("dst").alias("node"), F.col("dst_parts").alias("parts"))
        steps.append(chosen.select(F.least("node", "dst").alias("src"), F.greatest("node", "dst").alias("dst"), "sample"))
    none = links.select("src", "dst", F.lit(0).cast("bigint").alias("sample")).limit(0)
    return reduce(DataFrame.unionByName, steps, none)


def sampled_betweenness(
    edges: DataFrame, eps: float = 0.05, delta: float = 0.1, seed: int = 42, first: int = 256
) -> DataFrame:
    """``src, dst, betweenness, error, samples``: estimates from shortest paths of random pairs of nodes.

    With probability 1 - ``delta`` every edge's estimate is within ``error`` = ``eps`` * n (n - 1) / 2
    of :func:`edge_betweenness`; edges on no sampled path are left out, as their estimate is 0. The sample
    doubles from ``first`` paths on. It is enough as soon as the empirical Bernstein bound, taken for all
    edges and rounds at once, is below ``eps``, and at the latest at the size that follows from the
    vertex diameter (:func:`sample_bound`); either rule gets half of ``delta``. ``seed`` fixes the
    pairs and paths. Each pair is searched from both ends; the pairs go in batches of at most about STATE_ROWS rows (pair, node).
    """
    nodes = cut_lineage(dense_number(vertices(edges), ["id"], "number", 0))
    n, m = nodes.count(), edges.count()
    if n < 2:
        return edges.select("src", "dst", *[F.lit(0.0).alias(c) for c in ("betweenness", "error")],
                            F.lit(0).cast("bigint").alias("samples")).limit(0)
    component = connected_components(edges)
    most = sample_bound(vertex_diameter_bound(edges, component), eps, delta / 2)
    nodes = cut_lineage(nodes.join(component, "id"))
    rounds = 1 + max(0, math.ceil(math.log2(most / first)))
    links, batch = _spread_links(edges, _hubs(edges)), max(1, STATE_ROWS // n)
    counts, done = None, 0
    for r in range(rounds):
        size = min(most, first << r)
        parts = []
        for start in range(done, size, batch):
            drawn = edges.sparkSession.range(start, min(size, start + batch)).withColumnRenamed("id", "sample")
            own = F.pmod(F.xxhash64("sample", F.lit(seed), F.lit("root")), F.lit(n))
            other = F.pmod(F.xxhash64("sample", F.lit(seed), F.lit("target")), F.lit(n - 1))
            numbers = drawn.select("sample", own.alias("a"), other.alias("b")).withColumn(
                "b", F.when(F.col("b") >= F.col("a"), F.col("b") + 1).otherwise(F.col("b")))
            pairs = cut_lineage(
                numbers.join(nodes.select(F.col("number").alias("a"), F.col("id").alias("root"), "component"), "a")
                # Between two components there is no path to walk.
                .join(nodes.select(F.col("number").alias("b"), F.col("id").alias("target"), "component"), ["b", "component"])
                .select((F.col("sample") + F.lit(seed << 32)).alias("sample"), "root", "target"))
            parts.append(cut_lineage(_walk_back(links, pairs).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))))
        every = reduce(DataFrame.unionByName, parts, *([counts] if counts is not None else []))
        counts = cut_lineage(every.groupBy("src", "dst").agg(F.sum("n").alias("n")))
        done = size
        share = F.col("n") / F.lit(float(size))
        spread = counts.agg(F.max(share * (1 - share))).first()[0] or 0.0
        log = math.log(3 * max(m, 1) * rounds / (delta / 2))
        if math.sqrt(2 * spread * log / size) + 3 * log / size <= eps:
            break
    pairs_of_nodes = n * (n - 1) / 2
    return counts.select(
        "src", "dst", (F.col("n") / F.lit(float(done)) * pairs_of_nodes).alias("betweenness"),
        F.lit(eps * pairs_of_nodes).alias("error"), F.lit(done).cast("bigint").alias("samples"))


def top_edge(betweenness: DataFrame, digits: int = 5) -> DataFrame:
    """The edge of highest rounded betweenness, ties to the smallest (src, dst)."""
    return (
        betweenness.withColumn("betweenness", F.round("betweenness", digits))
        .orderBy(F.desc("betweenness"), "src", "dst").limit(1)
    )


def community_terms(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """``community, inner_edges, degree``: edges inside, and summed degrees, of each community.

    ``communities`` (id, community) may hold several partitions of the nodes at
    once, told apart by the community.
    """
    placed = communities.select("id", "community")
    degrees = both_ways(edges).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    sums = placed.join(degrees, "id").groupBy("community").agg(F.sum("d").alias("degree"))
    src = placed.withColumnRenamed("id", "src")
    dst = placed.withColumnRenamed("id", "dst")
    inner = (
        edges.select("src", "dst").join(src, "src").join(dst, ["dst", "community"])
        .groupBy("community").agg(F.count(F.lit(1)).alias("inner_edges"))
    )
    return sums.join(inner, "community", "left").withColumn(
        "inner_edges", F.coalesce("inner_edges", F.lit(0)))


def modularity(edges: DataFrame, communities: DataFrame, digits: int = 7) -> DataFrame:
    """One row ``modularity`` of a partition, by the edges and degrees of the given graph."""
    terms = community_terms(edges, communities)
    # Every edge has two ends, so the degrees add up to 2m.
    return terms.agg(
        F.round(
            2 * F.sum("inner_edges") / F.sum("degree")
            - F.sum(F.col("degree").cast("double") * F.col("degree"))
            / (F.sum("degree").cast("double") * F.sum("degree")),
            digits,
        ).alias("modularity")
    )


def _partition_terms(graph: DataFrame, where: DataFrame, edge_count: int) -> DataFrame:
    """``community, term`` with modularity = sum(term) / (4 m^2); integers, so sums are exact."""
    terms = community_terms(graph, where)
    return terms.select(
        "community",
        (F.lit(4 * edge_count).cast("bigint") * F.col("inner_edges").cast("bigint")
         - F.col("degree") * F.col("degree")).alias("term"),
    )


def _scored_components(edges: DataFrame, hubs: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(``src, dst, betweenness``, ``id, community``) from one breadth-first pass.

    The smallest node that a root reaches names its component.
    """
    links = _spread_links(edges, hubs)
    levels = _bfs_levels(links, vertices(edges))
    reached = reduce(DataFrame.unionByName, [level.select("root", "node") for level in levels])
    community = reached.groupBy(F.col("root").alias("id")).agg(F.min("node").alias("community"))
    scores = _edge_credit(links, levels).select(
        # Sums taken in another order must not change which edge is the highest.
        "src", "dst", F.round(F.col("credit") / 2, 7).alias("betweenness"))
    return scores, community


def _spread_of(near: dict, nodes: list) -> dict:
    """Shortest-path credit of each edge (smaller end first) of a component in memory, over all roots."""
    credit: dict = {}
    for root in nodes:
        far, paths, order = {root: 0}, {root: 1.0}, [root]
        for v in order:
            for w in near[v]:
                if w not in far:
                    far[w], paths[w] = far[v] + 1, 0.0
                    order.append(w)
                if far[w] == far[v] + 1:
                    paths[w] += paths[v]
        flow = dict.fromkeys(order, 1.0)
        for w in reversed(order):
            for v in near[w]:
                if far[v] == far[w] - 1:
                    share = flow[w] * paths[v] / paths[w]
                    flow[v] += share
                    edge = (v, w) if v < w else (w, v)
                    credit[edge] = credit.get(edge, 0.0) + share
    return credit


def _reached(near: dict, start) -> list:
    found = [start]
    seen = {start}
    for v in found:
        new = near[v] - seen
        seen |= new
        found.extend(new)
    return found


def _cut_whole(alive: list, whole: list, degrees: dict, key: list, four_m: int) -> list:
    """All further cuts of one component in memory: (src, dst, key, gain).

    ``alive`` are its edges, ``whole`` those of the uncut graph between its nodes,
    ``degrees`` the nodes' degrees in the uncut graph.
    """
    near: dict = {v: set() for v in degrees}
    inner: dict = {v: set() for v in degrees}
    for pairs, into in ((alive, near), (whole, inner)):
        for a, b in pairs:
            into[a].add(b)
            into[b].add(a)

    def term(nodes: list) -> int:
        members = set(nodes)
        edges = sum(len(inner[v] & members) for v in nodes) // 2
        return four_m * edges - sum(degrees[v] for v in nodes) ** 2

    todo, cuts = [(list(degrees), list(key))], []
    while todo:
        nodes, before = todo.pop()
        credit = _spread_of(near, nodes)
        if not credit:
            continue
        cut = min((-round(c / 2, 7), a, b) for (a, b), c in credit.items())
        _, a, b = cut
        near[a].discard(b)
        near[b].discard(a)
        path = [e for e in before if e > cut] + [cut]
        parts = [_reached(near, a)]
        if b not in set(parts[0]):
            parts.append(_reached(near, b))
        gain = sum(map(term, parts)) - term(nodes) if len(parts) > 1 else 0
        cuts.append((a, b, path, gain))
        todo += [(part, path) for part in parts]
    return cuts


def _cut_small(graph: DataFrame, alive: DataFrame, where: DataFrame, key: str, edge_count: int) -> DataFrame:
    """``src, dst, cut_key, gain`` of all cuts of components that one task can hold.

    ``alive`` (src, dst, community, key) are their edges, ``where`` (id, community) their nodes.
    """
    kind = graph.schema["src"].dataType.simpleString()
    src, dst = (where.select(F.col("id").alias(c), "community") for c in ("src", "dst"))
    degrees = both_ways(graph).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    nothing = F.lit(None).cast("bigint")
    rows = (
        alive.select("community", "src", "dst", F.lit("alive").alias("what"), nothing.alias("d"), "key")
        .unionByName(graph.join(src, "src").join(dst, ["dst", "community"]).select(
            "community", "src", "dst", F.lit("whole").alias("what"), nothing.alias("d"), F.lit(None).cast(key).alias("key")))
        .unionByName(where.join(degrees, "id").select(
            "community", F.col("id").alias("src"), F.col("id").alias("dst"), F.lit("node").alias("what"), "d",
            F.lit(None).cast(key).alias("key")))
    )

    def run(table: pa.Table) -> pa.Table:
        parts: dict = {"alive": [], "whole": [], "node": []}
        before: list = []
        for row in table.to_pylist():
            parts[row["what"]].append((row["src"], row["dst"], row["d"]))
            if row["key"]:
                before = [(e["rank"], e["src"], e["dst"]) for e in row["key"]]
        cuts = _cut_whole([r[:2] for r in parts["alive"]], [r[:2] for r in parts["whole"]],
                          {r[0]: r[2] for r in sorted(parts["node"])}, before, 4 * edge_count)
        own = table.schema.field("src").type
        entry = pa.struct([("rank", pa.float64()), ("src", own), ("dst", own)])
        return pa.table({
            "src": pa.array([c[0] for c in cuts], own), "dst": pa.array([c[1] for c in cuts], own),
            "cut_key": pa.array([[dict(zip(("rank", "src", "dst"), e)) for e in c[2]] for c in cuts], pa.list_(entry)),
            "gain": pa.array([c[3] for c in cuts], pa.int64())})

    return rows.groupBy("community").applyInArrow(run, f"src {kind}, dst {kind}, cut_key {key}, gain bigint")


def cut_sequence(edges: DataFrame, small_edges: int = SMALL_EDGES) -> DataFrame:
    """``src, dst, cut_key, gain``: every edge with its place in the order of cuts.

    The order is: always cut the edge of highest betweenness in the whole graph,
    ties to the smallest (src, dst), and score again. The betweenness of an edge
    depends on its component only, so each round cuts the highest edge of *every*
    component at once. ``cut_key`` restores the single order: a component waits
    for the cuts it came from, and among waiting components the better edge goes
    first, so a cut is ranked by the worst edge on its way, then by the worst
    one after that, and so on. ``gain`` is the change of 4 m^2 * modularity.

    A component of at most ``small_edges`` edges is cut to the end by one task; the rounds
    over the tables go on with the larger ones.
    """
    graph = cut_lineage(edges.select("src", "dst"))
    kind = graph.schema["src"].dataType.simpleString()
    key = f"array<struct<rank:double,src:{kind},dst:{kind}>>"
    if graph.isEmpty():
        return graph.select("src", "dst", F.lit(None).cast(key).alias("cut_key"), F.lit(0).cast("bigint").alias("gain"))
    hubs, edge_count = _hubs(graph), graph.count()
    if edge_count <= small_edges:
        # No component can be too large for a task: none is scored over the tables.
        community = connected_components(graph).withColumnRenamed("component", "community")
        scores = graph.withColumn("betweenness", F.lit(0.0))
    else:
        scores, community = _scored_components(graph, hubs)
    where = cut_lineage(community.withColumn("parent", F.col("community")))
    keys = where.select("community").distinct().withColumn(
        "key", F.array().cast(key))
    cuts, history, finished = [], [where.withColumn("round", F.lit(0))], []
    while True:
        alive = cut_lineage(
            scores.join(where.select(F.col("id").alias("src"), "community"), "src").join(keys, "community")
        )
        sizes = alive.groupBy("community").agg(F.count(F.lit(1)).alias("n"))
        small = cut_lineage(sizes.filter(F.col("n") <= small_edges).select("community"))
        if not small.isEmpty():
            finished.append(cut_lineage(_cut_small(
                graph, alive.join(small, "community", "left_semi").select("src", "dst", "community", "key"),
                where.join(small, "community", "left_semi").select("id", "community"), key, edge_count)))
            alive = cut_lineage(alive.join(small, "community", "left_anti"))
        if alive.isEmpty():
            break
        edge = F.struct((-F.col("betweenness")).alias("rank"), "src", "dst")
        chosen = alive.groupBy("community").agg(F.min(edge).alias("cut"), F.any_value("key").alias("key"))
        chosen = cut_lineage(chosen.select(
            "community", "cut",
            F.concat(F.filter("key", lambda e: e > F.col("cut")), F.array("cut")).alias("key")))
        cuts.append(chosen.withColumn("round", F.lit(len(history))))
        left = alive.select("src", "dst").join(
            chosen.select("cut.src", "cut.dst"), ["src", "dst"], "left_anti")
        scores, reached = _scored_components(left, hubs)
        # Only nodes of components that were cut; one without edges is alone from now on.
        where = cut_lineage(
            where.join(chosen.select("community"), "community", "left_semi")
            .select("id", F.col("community").alias("parent"))
            .join(reached, "id", "left")
            .select("id", F.coalesce("community", "id").alias("community"), "parent"))
        history.append(where.withColumn("round", F.lit(len(history))))
        keys = where.select("community", "parent").distinct().join(
            chosen.select(F.col("community").alias("parent"), "key"), "parent").select("community", "key")
    if cuts:
        finished.append(_with_gain(graph, reduce(DataFrame.unionByName, cuts), reduce(DataFrame.unionByName, history)))
    return reduce(DataFrame.unionByName, finished)


def _with_gain(graph: DataFrame, cuts: DataFrame, history: DataFrame) -> DataFrame:
    """Each cut with what its component's successors add to 4 m^2 * modularity.

    ``history`` places the nodes in components after every round; a component
    that is cut in one round arose in the round before.
    """
    stamp = F.struct("round", "community")
    terms = cut_lineage(
        history.select("round", "community", "parent").distinct()
        .join(_partition_terms(graph, history.select("id", stamp.alias("community")), graph.count())
              .select("community.*", "term"), ["round", "community"], "left")
        .withColumn("term", F.coalesce("term", F.lit(0))))
    after = terms.groupBy("round", F.col("parent").alias("community")).agg(F.sum("term").alias("after"))
    before = terms.select((F.col("round") + 1).alias("round"), "community", "term")
    return cuts.join(after, ["round", "community"]).join(before, ["round", "community"]).select(
        F.col("cut.src").alias("src"), F.col("cut.dst").alias("dst"),
        F.col("key").alias("cut_key"), (F.col("after") - F.col("term")).alias("gain"))


def divisive_communities(edges: DataFrame, digits: int = 7, small_edges: int = SMALL_EDGES) -> DataFrame:
    """``id, community, modularity``: the best partition on the way of :func:`cut_sequence`.

    The uncut graph counts too; of equal partitions the earlier one wins.
    """
    graph = cut_lineage(edges.select("src", "dst"))
    if graph.isEmpty():  # no node has an edge, so there is none to place
        return graph.select(F.col("src").alias("id"), F.col("src").alias("community"), F.lit(0.0).alias("modularity"))
    whole = connected_components(graph).withColumnRenamed("component", "community")
    norm = 4.0 * graph.count() ** 2
    start = _partition_terms(graph, whole, graph.count()).agg(F.sum("term")).first()[0]
    cuts = cut_lineage(
        running_sum(cut_sequence(graph, small_edges), ["cut_key"], "gain", "gained")
        .withColumn("score", F.round((F.lit(start) + F.col("gained")) / norm, digits))
    )
    best = cuts.orderBy(F.desc("score"), "cut_key").first()
    if round(start / norm, digits) >= best["score"]:
        return whole.withColumn("modularity", F.lit(round(start / norm, digits)))
    stop = cuts.filter(
        (F.col("src") == best["src"]) & (F.col("dst") == best["dst"])).select(F.col("cut_key").alias("stop"))
    left = cuts.join(F.broadcast(stop), F.col("cut_key") > F.col("stop")).select("src", "dst")  # one row
    left = cut_lineage(left)
    nodes = vertices(graph)
    if left.isEmpty():
        return nodes.select("id", F.col("id").alias("community"), F.lit(best["score"]).alias("modularity"))
    parts = connected_components(left)
    return nodes.join(parts, "id", "left").select(
        "id", F.coalesce("component", "id").alias("community"), F.lit(best["score"]).alias("modularity"))
