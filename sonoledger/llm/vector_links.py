"""Near-duplicate vectors by NN-descent.

Equal vectors are one class. Classes that lie together are gathered into balls: every member is
within half the link angle of the ball's leader, so all members of a ball link with each other
and need no pairs. Leaders and the classes left alone are the sites of a neighbour graph.

NN-descent refines the graph: lists of ``NEIGHBOURS`` sites begin with those that sort next to
each other under random codes, then the neighbours of a site (forward and backward) are compared
with each other and better ones enter their lists, until few change. A list is saturated when its
last entry is near enough to be a link; such lists are doubled and refined again until none is.
An audit measures a bounded sample of sites against all sites; while its recall is below
``RECALL``, more codes and steps follow. The recall reached can be read from :func:`audit`.

Edges near enough are then decided in double precision on the original components. A member is
measured against the leaders of neighbouring balls; by the triangle inequality of angles it links
with all of a ball, none of it, or is measured against its members, block by block, giving counts
and no pairs. So links are counted for every vector whatever the size of a group, and no list,
bucket or ball has a cap: sorted codes and backward lists only propose candidates.

Graph steps are written to the shared folder. Vectors travel as half-precision unit vectors while
candidates are sought; bounds are widened by ``SLACK``, the error this can make.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and are their own component; vectors of different lengths do not link; a null id takes no part,
its component is null and it is kept; repeated rows (and repeated ids) are vectors of their own,
and equal vectors link. Labels and other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoledger.llm._components import components
from sonoledger.llm.vectors import usable
from sonoledger.session import materialise

COSINE = 0.9
NEIGHBOURS = 8
TABLES, NEXT = 6, 3  # random codes, and sites that follow in their order
STEPS = 8  # of descent between two audits
SETTLED = 0.01  # of all list entries: fewer changes end the descent
AUDITED, RECALL, AUDITS = 256, 0.99, 3
BLOCK = 1024  # members measured at once
SLACK = 0.0015  # of a cosine of half-precision unit vectors


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small components."""

    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _stack(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
    for dim in np.unique(dims):
        yield int(dim), batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))


def _codes(x: np.ndarray, dim: int, table: int) -> np.ndarray:
    """Two cross-polytope codes of each row in one number: the largest of random projections, with its sign."""

    rng = np.random.default_rng((table, dim))
    wide = min(max(dim, 8), 64)
    code = np.zeros(len(x), np.int64)
    for _ in range(2):
        seen = x @ rng.normal(size=(dim, wide)).astype(np.float32)
        at = np.abs(seen).argmax(axis=1)
        code = code * (2 * wide) + 2 * at + (np.take_along_axis(seen, at[:, None], axis=1)[:, 0] < 0)
    return (code << 24) + (dim << 8) + table % 256


def _coded(sites: DataFrame, tables: range) -> DataFrame:
    """(code, near, node, dim, x, prio) for each site and table; ``near`` orders the sites of a code."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                x = _stack(part.column(part.schema.get_field_index("x")), np.float16).astype(np.float32)
                for table in tables:
                    lean = np.random.default_rng((table, dim, 1)).normal(size=dim).astype(np.float32)
                    yield pa.RecordBatch.from_pydict({
                        "code": _codes(x, dim, table), "near": x @ lean,
                        **{c: part.column(part.schema.get_field_index(c)) for c in ("node", "dim", "x", "prio")},
                    })

    return sites.select("node", "dim", "x", "prio").mapInArrow(
        work, "code long, near float, node long, dim int, x binary, prio long"
    )


def _gathered(sites: DataFrame, half_cosine: float, tables: range) -> DataFrame:
    """(node, site, radius): sites that join the ball of a site; ``radius`` bounds the angle between them.

    In each code the site of the lowest ``prio`` is proposed to the others. A site joins one that
    itself saw no lower one near; sites with a ball (prio below 0) stay.
    """

    coded = _coded(sites, tables)
    lead = coded.groupBy("code").agg(
        F.min(F.struct("prio", "node", "x")).alias("lead"), F.count("*").alias("n")
    ).filter("n > 1").select("code", "lead.*").toDF("code", "lead_prio", "lead", "lead_x")
    met = coded.filter("prio >= 0").join(lead, "code").filter("node != lead").select(
        "node", "dim", "x", "lead", "lead_prio", "lead_x"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                x, y = (_stack(part.column(i), np.float16).astype(np.float32) for i in (2, 5))
                cosine = np.einsum("ij,ij->i", x, y).astype(float)
                near = pa.array(cosine - SLACK >= half_cosine)
                if len(part := part.append_column("cosine", pa.array(cosine)).filter(near)):
                    yield part.select(["node", "lead", "lead_prio", "cosine"])

    tight = materialise(
        met.mapInArrow(work, "node long, lead long, lead_prio long, cosine double")
        .groupBy("node", "lead").agg(F.min("lead_prio").alias("lead_prio"), F.min("cosine").alias("cosine")),
        "links-tight",
    )
    rooted = tight.join(tight.select(F.col("node").alias("lead")).distinct(), "lead", "left_anti")
    chosen = rooted.groupBy("node").agg(F.min(F.struct("lead_prio", "lead", "cosine")).alias("c"))
    return chosen.select(
        "node", F.col("c.lead").alias("site"), F.acos(F.least(F.lit(1.0), F.col("c.cosine") - SLACK)).alias("radius")
    )


class Descent:
    """The neighbour graph of the sites: rows (node, other, cosine, fresh, k), the best ``k`` of each node."""

    GRAPH = "node long, other long, cosine float, fresh boolean, k int"

    def __init__(self, sites: DataFrame, k: int) -> None:
        self.sites = sites.withColumn("k", F.lit(k))  # node, dim, x, prio, cut
        self.graph: DataFrame | None = None
        self.count = sites.count()
        self.k = k

    def seed(self, tables: range) -> None:
        """Compare each site with those that follow it in the order of random codes."""

        ordered = _coded(self.sites, tables).repartitionByRange("code", "near").sortWithinPartitions("code", "near")
        k = self.k

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, part in _by_dim(batch):
                    node = part.column(2).to_numpy()
                    x = _stack(part.column(4), np.float16).astype(np.float32)
                    for step in range(1, min(NEXT, len(node) - 1) + 1):
                        cosine = np.einsum("ij,ij->i", x[:-step], x[step:])
                        a, b, c = (np.r_[node[:-step], node[step:]], np.r_[node[step:], node[:-step]], np.r_[cosine, cosine])
                        there = a != b
                        yield _rows(a[there], b[there], c[there], k)

        self._merge(ordered.mapInArrow(work, self.GRAPH))

    def _merge(self, found: DataFrame) -> None:
        """Take the best of old and found entries; only new ones are fresh."""

        everything = found.groupBy("node", "other").agg(
            F.max("cosine").alias("cosine"), F.lit(True).alias("fresh"), F.max("k").alias("k")
        )
        if self.graph is not None:
            everything = everything.unionByName(self.graph.withColumn("fresh", F.lit(False)))
        once = everything.groupBy("node", "other").agg(
            F.max("cosine").alias("cosine"), F.min("fresh").alias("fresh"), F.max("k").alias("k")
        )
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("cosine"), "other"))
        self.graph = materialise(once.withColumn("place", place).filter("place <= k").drop("place"), "links-graph")

    def step(self) -> int:
        """One join of neighbours with neighbours; the number of entries that changed."""

        last = self.graph.groupBy("node").agg(F.count("*").alias("n"), F.min("cosine").alias("least"))
        told = self.sites.join(last, "node", "left").select(
            F.col("node").alias("other"), "dim", "x", "k",
            F.when(F.col("n") >= F.col("k"), F.col("least")).otherwise(F.lit(-2.0)).cast("float").alias("least"),
        )
        forward = self.graph.select(F.col("node").alias("at"), "other", "fresh")
        place = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("cosine"), "node"))
        backward = (
            self.graph.withColumn("place", place).filter(F.col("place") <= self.k)
            .select(F.col("other").alias("at"), F.col("node").alias("other"), "fresh")
        )
        around = forward.unionByName(backward).join(told, "other").groupBy("at", "dim").agg(
            F.collect_list(F.struct("other", "fresh", "x", "k", "least")).alias("around")
        )

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(2)
                ends = lists.offsets.to_numpy()
                held = lists.values
                node, fresh, k, least = (
                    held.field(c).to_numpy(zero_copy_only=False) for c in ("other", "fresh", "k", "least")
                )
                raw, out = held.field("x"), []
                for row in range(len(lists)):
                    a, b = ends[row], ends[row + 1]
                    x = _stack(raw.slice(a, b - a), np.float16).astype(np.float32)
                    out.append(_compared(node[a:b], fresh[a:b], k[a:b], least[a:b], x))
                if out:
                    yield _rows(*(np.concatenate(c) for c in zip(*out)))

        self._merge(around.mapInArrow(work, self.GRAPH))
        return self.graph.filter("fresh").count()

    def refine(self, steps: int) -> None:
        for _ in range(steps):
            if self.step() <= SETTLED * self.k * self.count:
                break

    def enlarge(self) -> bool:
        """Double the lists whose last entry may be a link; False if there are none."""

        last = self.graph.groupBy("node").agg(
            F.count("*").alias("n"), F.min("cosine").alias("least"), F.first("k").alias("held")
        )
        full = materialise(
            last.join(self.sites.select("node", "cut"), "node")
            .filter((F.col("n") >= F.col("held")) & (F.col("least") >= F.col("cut")) & (F.col("n") < self.count - 1))
            .select("node", (2 * F.col("held")).alias("wide")),
            "links-full",
        )
        if full.isEmpty():
            return False
        k = F.coalesce("wide", "k").alias("k")
        self.sites = self.sites.join(full, "node", "left").select("node", "dim", "x", "prio", "cut", k)
        self.graph = self.graph.join(full, "node", "left").select(
            "node", "other", "cosine", (F.col("fresh") | F.col("wide").isNotNull()).alias("fresh"), k
        )
        return True


def _rows(node: np.ndarray, other: np.ndarray, cosine: np.ndarray, k) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "node": node, "other": other, "cosine": np.asarray(cosine, np.float32), "fresh": np.ones(len(node), bool),
        "k": np.broadcast_to(np.asarray(k, np.int32), len(node)),
    })


def _compared(node: np.ndarray, fresh: np.ndarray, k: np.ndarray, least: np.ndarray, x: np.ndarray) -> tuple:
    """(node, other, cosine, k) of the pairs of a neighbourhood, one of them fresh, that improve a list."""

    order = np.lexsort((~fresh, node))
    order = order[np.r_[True, node[order][1:] != node[order][:-1]]]  # once each, fresh if either entry is
    node, fresh, k, least, x = node[order], fresh[order], k[order], least[order], x[order]
    cosine = x @ x.T
    better = (cosine > least[:, None]) & (fresh[:, None] | fresh)
    np.fill_diagonal(better, False)
    i, j = np.nonzero(better)
    return node[i], node[j], cosine[i, j], k[i]


def audit(sites: DataFrame, graph: DataFrame, widest: float, link_angle: float, n: int = AUDITED) -> tuple[int, int]:
    """(found, all) site pairs that may hold links, for a bounded sample of sites against all sites."""

    asked = sites.orderBy(F.xxhash64("node"), "node").limit(n).select("node", "dim", "x", "radius").collect()
    sample: dict[int, tuple] = {}
    for dim in {r["dim"] for r in asked}:
        mine = [r for r in asked if r["dim"] == dim]
        x = np.stack([np.frombuffer(r["x"], np.float16) for r in mine]).astype(np.float32)
        sample[dim] = np.array([r["node"] for r in mine]), x, np.array([r["radius"] for r in mine])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                if dim not in sample:
                    continue
                ids, x, radius = sample[dim]
                node, reach = part.column(0).to_numpy(), part.column(3).to_numpy()
                cosine = x @ _stack(part.column(2), np.float16).astype(np.float32).T
                bound = np.cos(np.minimum(np.pi, link_angle + radius[:, None] + reach[None]))
                i, j = np.nonzero((cosine >= bound) & (ids[:, None] != node[None]))
                yield pa.RecordBatch.from_pydict({"node": ids[i], "other": node[j]})

    true = sites.select("node", "dim", "x", "radius").mapInArrow(work, "node long, other long")
    held = graph.select("node", "other").unionByName(graph.select(F.col("other").alias("node"), F.col("node").alias("other")))
    mine = held.join(F.broadcast(sites.orderBy(F.xxhash64("node"), "node").limit(n).select("node")), "node").distinct()
    got = true.join(mine.withColumn("held", F.lit(1)), ["node", "other"], "left")
    return tuple(got.agg(F.count("held"), F.count("*")).first())


def neighbour_graph(sites: DataFrame, link_angle: float, k: int = NEIGHBOURS) -> DataFrame:
    """(node, other) of the sites whose balls may hold links, each pair once, by NN-descent.

    ``sites``: node, dim, x (half-precision unit vector), prio, radius (angle that holds the ball).
    """

    widest = sites.agg(F.max("radius")).first()[0] or 0.0
    cut = F.cos(F.least(F.lit(np.pi), F.lit(link_angle + widest) + F.col("radius"))) - SLACK
    descent = Descent(sites.withColumn("cut", cut), k)
    tables = 0
    for _ in range(AUDITS):
        descent.seed(range(100 + tables, 100 + tables + TABLES))
        tables += TABLES
        descent.refine(STEPS)
        while descent.enlarge():
            descent.refine(STEPS)
        found, true = audit(sites, descent.graph, widest, link_angle)
        if found >= RECALL * true:
            break
    reach = sites.select("node", "radius")
    pairs = descent.graph.groupBy(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    ).agg(F.max("cosine").alias("cosine")).toDF("node", "other", "cosine")
    bound = F.cos(F.least(F.lit(np.pi), F.lit(link_angle) + F.col("radius") + F.col("other_radius"))) - SLACK
    return (
        pairs.filter(F.col("cosine") >= np.cos(min(np.pi, link_angle + 2 * widest)) - SLACK)
        .join(reach, "node").join(reach.toDF("other", "other_radius"), "other")
        .filter(F.col("cosine") >= bound).select("node", "other")
    )


def _measured(members: DataFrame, pairs: DataFrame, sites: DataFrame, cosine: float) -> DataFrame:
    """(node, site, other, links): how many vectors of the site ``other`` each member links with.

    ``members``: node, site, dim, v (doubles), weight; ``sites``: site, radius, mass. ``pairs``: site, other.
    """

    leaders = members.filter("node = site").select(F.col("site").alias("other"), F.col("v").alias("other_v")).join(
        sites.select(F.col("site").alias("other"), "radius", "mass"), "other"
    )
    met = members.join(pairs, "site").join(leaders, "other").select(
        "node", "site", "dim", "v", "other", "other_v", "radius", "mass"
    )
    angle = float(np.arccos(cosine))

    def against_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                x, y = units(_stack(part.column(3), float)), units(_stack(part.column(5), float))
                radius, mass = part.column(6).to_numpy(), part.column(7).to_numpy()
                c = np.einsum("ij,ij->i", x, y)
                turned = np.arccos(np.clip(c, -1, 1))
                alone = radius == 0  # the leader is all there is: the cosine decides
                linked = np.where(alone, c >= cosine, turned + radius <= angle - 1e-9)
                open_ = ~linked & ~alone & (turned - radius <= angle + 1e-9)
                kept = pa.array(linked | open_)
                links = pa.array(np.where(linked, mass, -1), mask=None)
                out = part.select(["node", "site", "dim", "other"]).append_column("links", links)
                raw = pa.array([v if o else None for v, o in zip(part.column(3).to_pylist(), open_)], pa.binary())
                yield out.append_column("v", raw).filter(kept)

    first = materialise(
        met.mapInArrow(against_leader, "node long, site long, dim int, other long, links long, v binary"), "links-measured"
    )
    sure = first.filter("links >= 0").select("node", "site", "other", "links")
    doubt = first.filter("links < 0")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    askers = doubt.groupBy("other").agg(blocks(F.count("*")).alias("ask_blocks"))
    sizes = members.join(askers.select(F.col("other").alias("site")), "site", "left_semi").groupBy("site").agg(
        blocks(F.count("*")).alias("held_blocks")
    )
    plan = materialise(askers.join(sizes.toDF("other", "held_blocks"), "other"), "links-blocks")
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = doubt.join(plan, "other").withColumn("ask", number("ask_blocks")).withColumn("held", every("held_blocks"))
    holding = (
        members.select("node", F.col("site").alias("other"), "v", "weight").join(plan, "other")
        .withColumn("held", number("held_blocks")).withColumn("ask", every("ask_blocks"))
    )
    keys = ["other", "ask", "held"]

    def block(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "site", "other", "links")})
        x, y = (units(_stack(t.column("v").combine_chunks(), float)) for t in (a, b))
        links = (x @ y.T >= cosine) @ b.column("weight").to_numpy()
        return a.select(["node", "site", "other"]).append_column("links", pa.array(links.astype(np.int64)))

    told = asking.select("node", "site", "v", *keys).groupBy(*keys).cogroup(
        holding.select("node", "v", "weight", *keys).groupBy(*keys)
    ).applyInArrow(block, "node long, site long, other long, links long")
    return sure.unionByName(told.filter("links > 0"))


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = COSINE, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""

    held = usable(vectors, id_col, vector_col)
    classes = materialise(
        held.groupBy("vector", "dim").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"))
        .withColumn("node", F.monotonically_increasing_id()),
        "links-classes",
    )
    angle = float(np.arccos(cosine))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                v = part.column(2).flatten().to_numpy().reshape(len(part), dim)
                small = units(v).astype(np.float16)
                yield pa.RecordBatch.from_pydict({
                    "node": part.column(0), "dim": part.column(1), "weight": part.column(3), "low": part.column(4),
                    "v": pa.array([r.tobytes() for r in v], pa.binary()), "x": pa.array([r.tobytes() for r in small], pa.binary()),
                })

    nodes = materialise(
        classes.select("node", "dim", "vector", "weight", "low").mapInArrow(
            raw, "node long, dim int, weight long, low long, v binary, x binary"
        ), "links-nodes",
    )
    free = nodes.select("node", "dim", "x", F.shiftrightunsigned(F.xxhash64("node"), 1).alias("prio"))
    # Two rounds: the second offers the balls of the first, largest first, to what was left alone.
    first = materialise(_gathered(free, float(np.cos(angle / 2)), range(TABLES)), "links-balls")
    sizes = first.groupBy("site").agg(F.count("*").alias("n"))
    left = free.join(first, "node", "left_anti").join(sizes.withColumnRenamed("site", "node"), "node", "left").select(
        "node", "dim", "x", F.coalesce(-F.col("n"), "prio").alias("prio")
    )
    second = _gathered(materialise(left, "links-left"), float(np.cos(angle / 2)), range(TABLES, 2 * TABLES))
    # A ball never moves, so what joins in the second round joins a site.
    joined = materialise(first.unionByName(second), "links-balls")
    members = materialise(
        nodes.join(joined, "node", "left").select(
            "node", F.coalesce("site", "node").alias("site"), F.coalesce("radius", F.lit(0.0)).alias("radius"),
            "dim", "weight", "low", "v",
        ), "links-members",
    )
    balls = members.groupBy("site").agg(
        F.max("radius").alias("radius"), F.sum("weight").alias("mass"), F.min("low").alias("low")
    )
    sites = materialise(
        balls.join(free.withColumnRenamed("node", "site"), "site").select(
            F.col("site").alias("node"), "dim", "x", "prio", "radius", "mass", "low"
        ), "links-sites",
    )
    close = materialise(neighbour_graph(sites.drop("mass", "low"), angle, k), "links-close")
    both = close.toDF("site", "other").unionByName(close.select(F.col("other").alias("site"), F.col("node").alias("other")))
    measured = materialise(
        _measured(members.drop("radius", "low"), both, sites.withColumnRenamed("node", "site"), cosine), "links-counted"
    )
    joins = components(measured.select(F.col("site").alias("a"), F.col("other").alias("b")))
    rooted = sites.join(joins, "node", "left").select("node", "mass", "low", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_site = rooted.join(lowest, "root").select(F.col("node").alias("site"), "mass", "component_id")
    outside = measured.groupBy("node").agg(F.sum("links").alias("outside"))
    of_node = members.select("node", "site").join(of_site, "site").join(outside, "node", "left").select(
        "node", "component_id", (F.col("mass") - 1 + F.coalesce("outside", F.lit(0))).cast("long").alias("n_links")
    )
    of_vector = classes.select("node", "vector").join(of_node, "node").drop("node")
    linked = held.select("vec_id", "vector").join(of_vector, "vector").select("vec_id", "n_links", "component_id")
    alone = vectors.filter(~_takes_part(id_col, vector_col)).select(F.col(id_col).cast("long").alias("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _takes_part(id_col: str, vector_col: str):
    """The rows that :func:`usable` keeps, never NULL."""

    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(F.col(id_col).isNotNull() & v.isNotNull() & good, F.lit(False))
