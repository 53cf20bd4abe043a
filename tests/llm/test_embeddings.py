import numpy as np

from cargolens.llm import embeddings
from cargolens.llm.hnsw import Graph, levels

SCHEMA = "vec_id long, embedding array<float>, label int, id string, key string"


def brute(rows, cosine=0.98):
    n, comp = {}, {}
    ok = [(i, np.array(v, np.float64), l) for i, v, l in rows
          if v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    at = {i: i for i, *_ in rows}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for i, *_ in rows:
        n[i] = 0
    for k, (i, v, l) in enumerate(ok):
        for j, w, m in ok[k + 1:]:
            if l == m and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= cosine:
                n[i] += 1
                n[j] += 1
                x, y = find(i), find(j)
                at[max(x, y)] = min(x, y)
    return {i: (n[i], find(i)) for i, *_ in rows}


def vectors(seed, n, d=16):
    return np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "x", "y")
                                for i, v, l in rows], SCHEMA)
    return embeddings.near_duplicates(df, **kw).collect()


def test_links_and_components(spark):
    r = np.random.default_rng(2)
    base = vectors(1, 250)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    for k in range(90):                                               # near copies, and chains of them
        src = rows[r.integers(len(rows))]
        rows.append((1000 + k, (np.array(src[1]) + r.normal(size=16) * 0.03).tolist(), src[2]))
    hub = vectors(7, 1)[0]
    rows += [(2000 + k, (hub + r.normal(size=16) * 0.01).tolist(), 1) for k in range(150)]    # one large group
    rows += [(3000 + k, base[5].tolist(), 2) for k in range(40)]                              # exact copies
    rows += [(4000, base[6].tolist(), None), (4001, None, 0), (4002, [], 0), (4003, [0.0] * 16, 0), (4004, [0.0] * 16, 0),
             (4005, [None] + [1.0] * 15, 0), (4006, [float("nan")] + [1.0] * 15, 0), (4007, [float("inf")] * 16, 0),
             (4008, [1.0] * 5, 0), (4009, [1.0] * 5, 0)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    want = brute(rows)
    for shard in (8192, 90):                                          # one shard a label, and several
        got = {x.vec_id: (x.n_links, x.component_id) for x in run(spark, rows, shard_rows=shard)}
        assert got == want
    assert all(x.kept == (x.vec_id == x.component_id) for x in run(spark, rows))


def test_empty_null_and_repeated_ids(spark):
    assert run(spark, []) == []
    v = vectors(3, 2).tolist()
    out = run(spark, [(1, v[0], 0), (1, v[0], 0), (None, v[1], 0), (None, v[1], 0), (5, v[1], 0)])
    assert sorted((x.vec_id or -1, x.n_links, x.component_id) for x in out) == [
        (-1, 2, 5), (-1, 2, 5), (1, 1, 1), (1, 1, 1), (5, 2, 5)]


def test_recall_against_brute_force():
    x = vectors(11, 3000, 64)
    x[1500:] = x[:1500] + np.random.default_rng(4).normal(size=(1500, 64)).astype(np.float32) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph.build(x, levels(np.arange(3000)))
    truth = (x @ x.T) >= 0.98
    q, n, _ = embeddings.audited(graph, x, 0.98)
    assert truth[q, n].sum() >= 0.99 * truth.sum()


class Narrow:
    """Finds each vector itself, and the others only with a beam of at least ``enough``."""

    def __init__(self, x, enough):
        self.x, self.enough = x, enough

    def within(self, queries, least, beam):
        sim = queries @ self.x.T
        return np.nonzero(sim >= (least if beam >= self.enough else 0.99999))

    def search(self, queries, beam):
        ids = np.argsort(-(queries @ self.x.T), axis=1)
        return ids[:, :beam], None


def test_audit_does_not_count_a_vector_as_its_own_link():
    x = vectors(21, 1000, 64)
    x[999] = x[0] + 0.01 * x[1]                                       # one link
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, n, beam = embeddings.audited(Narrow(x, 100), x, 0.98)
    assert beam >= 100 and (0, 999) in set(zip(q.tolist(), n.tolist()))


def test_audit_between_shards_without_links_is_of_the_nearest():
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (vectors(22, 1000, 64), vectors(23, 1000, 64)))
    assert embeddings.audited(Narrow(x, 100), y, 0.98)[2] == embeddings.BEAM
