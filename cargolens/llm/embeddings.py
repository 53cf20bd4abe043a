"""Near-duplicate vectors by navigable small-world graphs per shard.

1. Equal vectors of a label are one class (a single row with its copies).
2. The classes of a label are dealt by hash to shards of about ``SHARD`` rows,
   and one task a shard builds its graph (:mod:`hnsw`).
3. Every vector queries every shard of its label; one task takes a pair of
   shards, in both directions.  A sample of its queries is also compared with
   the whole shard: while the graph finds too few of their links with others
   (or, where links are few, of the nearest others), the beam is doubled.
4. What the graphs propose is verified by cosine in double precision.  A task
   returns its classes' link counts and a spanning forest of its links; the
   forests' connected components are the groups.

Defined results: a vector that is null, empty, zero or holds null or
non-finite components, and one without label, links with nothing; repeated rows
are copies that link with each other; a null id is kept and never names a
group unless all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, shared_table
from .components import components
from .hnsw import Graph, levels

COSINE = 0.98
SHARD = 8192
BEAM = 48
AUDITED, RECALL = 128, 0.99
AUDIT_ROUNDS = 16                            # samples of AUDITED queries until as many have a link
NEAREST = 0.9                                # share of nearest neighbours to be found where links are few
# The graphs work in single precision: they propose from a little below the threshold.
SLACK = 1e-4


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def audited(graph: Graph, queries: np.ndarray, least: float, goal: float = RECALL) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (query, node) of at least that similarity, with the beam widened
    until the audit passes; also returns the beam.  A graph's own vectors do not
    count as found by themselves."""
    own = queries is graph.x
    # queries in a spread order, until enough of them have a link
    rounds = max(1, min(AUDIT_ROUNDS, -(-len(queries) // AUDITED)))
    step = max(1, len(queries) // (AUDITED * rounds))
    order = np.arange(0, len(queries), step)
    linked, first = [], None
    for k in range(rounds):
        sample = order[k::rounds]
        exact = queries[sample] @ graph.x.T
        if own:
            exact[np.arange(len(sample)), sample] = -np.inf
        if k == 0:
            first, nearest = sample, exact.argmax(axis=1)
        linked += [(sample[i], np.flatnonzero(exact[i] >= least)) for i in np.flatnonzero((exact >= least).any(axis=1))]
        if len(linked) >= AUDITED:
            break
    asked = np.array([i for i, _ in linked], int)
    total = sum(len(t) for _, t in linked)
    truth = np.zeros((len(asked), len(graph.x)), bool)
    for row, (_, t) in enumerate(linked):
        truth[row, t] = True
    beam, n = min(BEAM, len(graph.x)), len(graph.x)
    while True:
        recall = 1.0
        if total:
            q, node = graph.within(queries[asked], least, beam)
            recall = truth[q, node].sum() / total
        if len(linked) < AUDITED and recall >= goal and n > own:
            ids, _ = graph.search(queries[first], beam)
            if (ids == nearest[:, None]).any(axis=1).mean() < NEAREST:
                recall = 0.0
        if recall >= goal or beam >= n:
            break
        beam = min(n, 2 * beam)
    q, node = graph.within(queries, least, beam)
    return q, node, beam


def _link(cid: np.ndarray, copies: np.ndarray, vectors: np.ndarray, found: tuple[np.ndarray, np.ndarray],
          cosine: float) -> list[tuple[int, int, int]]:
    """(class, linked rows, root) from proposed pairs of positions, verified in double precision."""
    i, j = found
    keep = i != j
    i, j = np.minimum(i[keep], j[keep]), np.maximum(i[keep], j[keep])
    code = np.unique(i * len(cid) + j)
    i, j = code // len(cid), code % len(cid)
    u = _unit(vectors)
    good = np.zeros(len(i), bool)
    for lo in range(0, len(i), 20_000):
        s = slice(lo, lo + 20_000)
        good[s] = np.einsum("kd,kd->k", u[i[s]], u[j[s]]) >= cosine
    i, j = i[good], j[good]
    n = np.bincount(i, copies[j], len(cid)) + np.bincount(j, copies[i], len(cid))
    label = np.arange(len(cid))
    while True:                                             # smallest linked position
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    return [(int(cid[k]), int(n[k]), int(cid[label[k]])) for k in np.flatnonzero(n)]


def usable(vector: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, shard_rows: int = SHARD) -> DataFrame:
    """(id, n_links, component_id, kept): one row for each row of ``df``."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", usable(F.col("v")) & F.col("label").isNotNull())
    rows = shared_table(rows.withColumn("key", F.when(F.col("ok"), F.concat_ws(
        ":", F.size("v"), F.xxhash64("label", "v", F.lit(1)), F.xxhash64("v", "label", F.lit(2))))), "vectors")
    classes = (rows.filter("ok").groupBy("key")
               .agg(F.any_value("label").alias("label"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                    F.any_value("v").alias("v"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = shared_table(classes, "classes")
    sized = (classes.groupBy("label", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
             .select("label", "dim", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards")))
    sized = shared_table(sized.withColumn("part", F.xxhash64("label", "dim")), "parts")
    dealt = (classes.withColumn("dim", F.size("v")).join(sized, ["label", "dim"])
             .select("cid", "copies", "v", "part", "shards", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int").alias("shard")))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("cid")
        x = _unit(np.stack(t.column("v").to_numpy())).astype(np.float32)
        level = levels(t.column("cid").to_numpy())
        graph = Graph.build(x, level)
        links = [[] for _ in range(len(x))]
        for nodes, near in graph.layers:
            for k, node in enumerate(nodes):
                links[node].append(near[k])
        stray = np.zeros(len(x), bool)
        stray[graph.stray] = True
        # within a layer a node's place is its place in the order of insertion
        place = np.full((len(x), len(graph.layers)), -1)
        for l, (nodes, _) in enumerate(graph.layers):
            place[nodes, l] = np.arange(len(nodes))
        return pa.table({**{c: t.column(c) for c in ("cid", "copies", "v", "part", "shards", "shard")},
                         "places": pa.array([p[p >= 0] for p in place], pa.list_(pa.int32())),
                         "links": pa.array([np.concatenate(x) for x in links], pa.list_(pa.int32())),
                         "stray": pa.array(stray)})

    graphs = shared_table(dealt.groupBy("part", "shard").applyInArrow(
        build, "cid long, copies long, v array<double>, part long, shards int, shard int, "
               "places array<int>, links array<int>, stray boolean"), "graphs")
    pairs = graphs.withColumn("pair", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda x: F.struct(F.least(x, F.col("shard")).alias("lo"), F.greatest(x, F.col("shard")).alias("hi")))))
    pairs = pairs.select("*", F.col("pair.lo").alias("lo"), F.col("pair.hi").alias("hi")).drop("pair")

    def load(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
        t = t.sort_by("cid")
        v = np.stack(t.column("v").to_numpy())
        places, links = t.column("places").to_pylist(), t.column("links").to_numpy()
        layers = []
        for l in range(max(map(len, places))):
            own = np.array([i for i, p in enumerate(places) if len(p) > l])
            at = np.array([places[i][l] for i in own])
            own = own[np.argsort(at)]
            width = len(links[own[0]]) // len(places[own[0]])
            layers.append((own, np.stack([links[i][l * width:(l + 1) * width] for i in own]).astype(np.int64)))
        graph = Graph(_unit(v).astype(np.float32), layers)
        graph.stray = np.flatnonzero(t.column("stray").to_numpy())
        return t.column("cid").to_numpy(), t.column("copies").to_numpy(), v, graph

    def query(t: pa.Table) -> pa.Table:
        import pyarrow.compute as pc
        lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
        sides = [load(t.filter(pc.equal(t.column("shard"), s))) for s in ([lo] if lo == hi else [lo, hi])]
        cid, copies, v = (np.concatenate([s[k] for s in sides]) for k in range(3))
        first = len(sides[0][0])
        least = cosine - SLACK
        if lo == hi:
            q, node, _ = audited(sides[0][3], sides[0][3].x, least)
        else:
            q1, n1, _ = audited(sides[1][3], sides[0][3].x, least)
            q2, n2, _ = audited(sides[0][3], sides[1][3].x, least)
            q, node = np.concatenate([q1, q2 + first]), np.concatenate([n1 + first, n2])
        found = _link(cid, copies, v, (q, node), cosine)
        return pa.table([pa.array(c, pa.int64()) for c in (list(zip(*found)) or [[], [], []])], ["cid", "n", "root"])

    links = shared_table(pairs.groupBy("part", "lo", "hi").applyInArrow(query, "cid long, n long, root long"), "verified")
    groups = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    groups = groups.select(F.col("node").alias("cid"), F.col("component").alias("group"))
    counted = links.groupBy("cid").agg(F.sum("n").alias("n"))
    graded = (classes.select("cid", "key", "rep", "copies").join(counted, "cid", "left").join(groups, "cid", "left")
              .withColumn("group", F.coalesce("group", "cid")))
    graded = shared_table(graded, "graded")
    smallest = shared_table(graded.groupBy(F.col("group").alias("_g")).agg(F.min("rep").alias("component_id")), "smallest")
    result = shared_table(graded.join(smallest, F.col("group") == F.col("_g"))
                          .select(F.col("key").alias("_key"), "component_id",
                                  (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "result")
    out = rows.select("id", "key").join(result, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
