"""A hierarchical navigable small-world graph over unit vectors, with batched
inserts and beam searches (many queries advance together in NumPy).

Nodes draw a level; the graph of a level joins all nodes of at least that
level.  A node's forward links are chosen to point in different directions, its
backward links are the nearest nodes that chose it.  Searches descend from the
top level and keep a beam of the best nodes seen.
"""

from __future__ import annotations

import numpy as np

FORWARD, BACKWARD = 12, 20
BUILD_BEAM = 48
BATCH = 256
TOGETHER = 4                        # beam nodes that a query expands in one step


def levels(keys: np.ndarray) -> np.ndarray:
    """Level of each node from a hash of its key: level l has 1 / FORWARD**l of the nodes."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    u = ((x ^ (x >> np.uint64(29))) >> np.uint64(11)).astype(np.float64) / 2**53
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(FORWARD)).astype(np.int64)


def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of the best ``beam`` nodes that each query reaches, best first; -1 pads."""
    many, n = len(q), len(x)
    seen = np.zeros((many, n + 1), bool)
    seen[:, n] = True                                           # stands for "no link"
    node = np.full((many, beam), n)
    sim = np.full((many, beam), -np.inf, np.float32)
    done = np.ones((many, beam), bool)
    start = np.sort(entry, axis=1)
    start[:, 1:][start[:, 1:] == start[:, :-1]] = n
    k = min(start.shape[1], beam)
    start = start[:, :k]
    good = start < n
    node[:, :k] = start
    sim[:, :k] = np.where(good, np.einsum("qd,qkd->qk", q, x[np.minimum(start, n - 1)]), -np.inf)
    done[:, :k] = ~good
    np.put_along_axis(seen, start, True, axis=1)
    active = np.arange(many)
    while len(active):
        s = np.where(done[active], -np.inf, sim[active])
        best = np.argsort(-s, axis=1, kind="stable")[:, :TOGETHER]
        open_ = np.take_along_axis(s, best, axis=1) > -np.inf
        go = open_.any(axis=1)
        active, best, open_ = active[go], best[go], open_[go]
        if not len(active):
            break
        from_ = np.where(open_, np.take_along_axis(node[active], best, axis=1), n)
        flags = done[active]
        np.put_along_axis(flags, best, True, axis=1)
        near = links[from_].reshape(len(active), -1)            # row n of links holds only n
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        mine = seen[active]
        near = np.where(np.take_along_axis(mine, near, axis=1), n, near)
        width = max(1, int((near < n).sum(axis=1).max()))
        near = np.sort(near, axis=1)[:, :width]                 # the new nodes first
        seen[active[:, None], near] = True
        new = np.einsum("qd,qkd->qk", q[active], x[np.minimum(near, n - 1)])
        new = np.where(near < n, new, -np.inf).astype(np.float32)
        all_sim = np.concatenate([sim[active], new], axis=1)
        all_node = np.concatenate([node[active], near], axis=1)
        all_done = np.concatenate([flags, near >= n], axis=1)
        top = np.argsort(-all_sim, axis=1, kind="stable")[:, :beam]
        sim[active] = np.take_along_axis(all_sim, top, axis=1)
        node[active] = np.take_along_axis(all_node, top, axis=1)
        done[active] = np.take_along_axis(all_done, top, axis=1)
    return np.where(node < n, node, -1), sim


def _spread(x: np.ndarray, cand: np.ndarray, sim: np.ndarray, keep: int) -> np.ndarray:
    """Of candidates (best first) those nearer to the query than to any chosen
    one, then the nearest of the others; up to ``keep``, padded with -1."""
    many, width = cand.shape
    v = x[np.maximum(cand, 0)]
    cross = np.einsum("qid,qjd->qij", v, v)
    chosen = np.zeros((many, width), bool)
    for i in range(width):
        worst = np.where(chosen, cross[:, i, :], -np.inf).max(axis=1)
        chosen[:, i] = (cand[:, i] >= 0) & (worst < sim[:, i]) & (chosen.sum(axis=1) < keep)
    rank = np.where(cand < 0, 2 * width, np.where(chosen, 0, width)) + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :keep]
    out = np.take_along_axis(cand, order, axis=1)
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


class Graph:
    """``layers[l]``: (nodes of level l or more, their links as positions among these nodes)."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.layers = x, layers
        self.stray = np.zeros(0, np.int64)

    @classmethod
    def build(cls, x: np.ndarray, level: np.ndarray) -> Graph:
        graph = cls(x, [])
        for l in range(int(level.max(initial=0)), -1, -1):
            nodes = np.flatnonzero(level >= l)
            # nodes of the level above come first: they are the entries of the others
            nodes = nodes[np.argsort(-np.minimum(level[nodes], l + 1), kind="stable")]
            graph.layers.insert(0, (nodes, graph._layer(nodes)))
        found = graph.search(x, BUILD_BEAM)[0]
        graph.stray = np.flatnonzero(~(found == np.arange(len(x))[:, None]).any(axis=1))
        return graph

    def _layer(self, nodes: np.ndarray) -> np.ndarray:
        v, n = self.x[nodes], len(nodes)
        forward, backward = np.full((n, FORWARD), -1), np.full((n, BACKWARD), -1)
        near = np.full((n, BACKWARD), -np.inf, np.float32)
        lo = 0
        while lo < n:
            hi = min(n, lo + max(1, min(BATCH, max(lo, 32))))
            q = v[lo:hi]
            inside = q @ q.T
            inside[np.triu_indices(hi - lo)] = -np.inf          # earlier nodes of the same batch
            k = min(BUILD_BEAM, hi - lo)
            own = np.argsort(-inside, axis=1)[:, :k]
            own_sim = np.take_along_axis(inside, own, axis=1)
            cand, sim = np.where(own_sim > -np.inf, own + lo, -1), own_sim
            if lo:
                links = self._padded(np.concatenate([forward[:lo], backward[:lo]], axis=1), lo)
                entry = self._entries(q, nodes[:lo], len(self.layers))
                old, old_sim = _beam(v[:lo], links, q, entry, BUILD_BEAM)
                cand, sim = np.concatenate([old, cand], axis=1), np.concatenate([old_sim, sim], axis=1)
                top = np.argsort(-sim, axis=1, kind="stable")[:, :BUILD_BEAM]
                cand, sim = np.take_along_axis(cand, top, axis=1), np.take_along_axis(sim, top, axis=1)
            forward[lo:hi] = _spread(v, cand, sim, FORWARD)
            self._back(v, forward[lo:hi], lo, backward, near)
            lo = hi
        return np.concatenate([forward, backward], axis=1)

    @staticmethod
    def _back(v, forward, lo, backward, near) -> None:
        to = forward.ravel()
        from_ = np.repeat(np.arange(lo, lo + len(forward)), forward.shape[1])
        from_, to = from_[to >= 0], to[to >= 0]
        if not len(to):
            return
        s = np.einsum("kd,kd->k", v[from_], v[to])
        order = np.lexsort((-s, to))
        from_, to, s = from_[order], to[order], s[order]
        target, first, many = np.unique(to, return_index=True, return_counts=True)
        nth = np.arange(len(to)) - np.repeat(first, many)
        keep = nth < BACKWARD
        row = np.repeat(np.arange(len(target)), many)[keep]
        node = np.full((len(target), BACKWARD), -1)
        sim = np.full((len(target), BACKWARD), -np.inf, np.float32)
        node[row, nth[keep]], sim[row, nth[keep]] = from_[keep], s[keep]
        node = np.concatenate([backward[target], node], axis=1)
        sim = np.concatenate([near[target], sim], axis=1)
        top = np.argsort(-sim, axis=1, kind="stable")[:, :BACKWARD]
        backward[target] = np.take_along_axis(node, top, axis=1)
        near[target] = np.take_along_axis(sim, top, axis=1)

    @staticmethod
    def _padded(links: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate([np.where((links < 0) | (links >= n), n, links), np.full((1, links.shape[1]), n)])

    def _entries(self, q: np.ndarray, nodes: np.ndarray, above: int) -> np.ndarray:
        """Positions among ``nodes`` where the queries enter, found in the ``above`` layers built so far."""
        at = np.zeros((len(q), 1), np.int64)
        if not above:
            return at
        found = None
        for upper, links in reversed(self.layers):
            if found is not None:
                place = np.full(len(self.x), len(upper))
                place[upper] = np.arange(len(upper))
                at = place[found]
            ids, _ = _beam(self.x[upper], self._padded(links, len(upper)), q, at, 4)
            found = upper[np.where(ids < 0, ids[:, :1], ids)]
        place = np.full(len(self.x), len(nodes))
        place[nodes] = np.arange(len(nodes))
        at = place[found]
        at[:, 0] = np.where((at < len(nodes)).any(axis=1), at[:, 0], 0)
        return at

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) for each query, best first; -1 pads."""
        nodes, links = self.layers[0]
        padded = self._padded(links, len(nodes))
        upper = Graph(self.x, self.layers[1:])
        v = self.x[nodes]
        beam = min(beam, len(nodes))
        out, sims = [], []
        for lo in range(0, len(q), BATCH):
            part = q[lo:lo + BATCH]
            ids, sim = _beam(v, padded, part, upper._entries(part, nodes, len(upper.layers)), beam)
            ids = np.where(ids < 0, -1, nodes[ids])
            if len(self.stray):                                 # nodes that no search reaches are compared outright
                s = part @ self.x[self.stray].T
                known = (ids[:, :, None] == self.stray).any(axis=1)
                ids = np.concatenate([ids, np.broadcast_to(self.stray, s.shape)], axis=1)
                sim = np.concatenate([sim, np.where(known, -np.inf, s)], axis=1).astype(np.float32)
                ids = np.where(sim > -np.inf, ids, -1)
            out.append(ids)
            sims.append(sim)
        if not out:
            return np.zeros((0, beam), np.int64), np.zeros((0, beam), np.float32)
        return np.concatenate(out), np.concatenate(sims)

    def within(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) for the nodes of at least that similarity: the beam's, and from
        them along the links as long as new ones turn up, so that a group larger
        than the beam is found whole."""
        ids, sim = self.search(q, beam)
        hit = (ids >= 0) & (sim >= least)
        row, col = np.nonzero(hit)
        found_q, found_n = [row], [ids[row, col]]
        nodes, links = self.layers[0]
        place = np.empty(len(self.x), np.int64)
        place[nodes] = np.arange(len(nodes))
        for r in np.flatnonzero(hit.any(axis=1)):
            seen = np.zeros(len(nodes) + 1, bool)
            seen[len(nodes)] = True
            seen[place[ids[r][ids[r] >= 0]]] = True
            front = place[ids[r][hit[r]]]
            while len(front):
                near = np.unique(links[front])
                near = near[near >= 0]
                near = near[~seen[near]]
                seen[near] = True
                front = near[self.x[nodes[near]] @ q[r] >= least]
                if len(front):
                    found_q.append(np.full(len(front), r))
                    found_n.append(nodes[front])
        return np.concatenate(found_q), np.concatenate(found_n)
