"""A hierarchical navigable small-world graph over unit vectors, inside one task."""

from __future__ import annotations

import numpy as np

LINKS = 12  # links of a node on upper layers, twice as many on the lowest
BUILD_BEAM = 48
WIDE = 8  # nodes expanded at a time


class Graph:
    """``vectors``: float64 rows of length 1. ``layers[0]`` holds all nodes; unused links are -1."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.vectors = np.ascontiguousarray(vectors, np.float64)
        n = len(vectors)
        level = (-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
        self.layers = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)]
        self.entry, self._top = 0, int(level[0]) if n else 0
        self._seen, self._mark = np.zeros(n, np.int64), 0
        for node in range(1, n):
            self._insert(node, int(level[node]))

    def _beam(self, layer: int, q: np.ndarray, start: np.ndarray, width: int, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nodes nearest to ``q`` that a beam search from ``start`` meets, and their cosines; ``met`` gets all it meets."""
        links = self.layers[layer]
        self._mark += 1
        self._seen[start] = self._mark
        found, cos = start, self.vectors[start] @ q
        done = np.zeros(len(found), bool)
        if met is not None:
            met.append((found, cos))
        while True:
            todo = np.flatnonzero(~done)[:WIDE]
            if not len(todo):
                return found, cos
            done[todo] = True
            next_ = links[found[todo]].ravel()
            next_ = next_[next_ >= 0]
            next_ = np.unique(next_[self._seen[next_] != self._mark])
            if not len(next_):
                continue
            self._seen[next_] = self._mark
            near = self.vectors[next_] @ q
            if met is not None:
                met.append((next_, near))
            found, cos, done = np.concatenate([found, next_]), np.concatenate([cos, near]), np.concatenate([done, np.zeros(len(next_), bool)])
            order = np.argsort(-cos, kind="stable")[:width]
            found, cos, done = found[order], cos[order], done[order]

    def _choose(self, q: np.ndarray, nodes: np.ndarray, cos: np.ndarray, most: int) -> np.ndarray:
        """Neighbours in different directions: one is taken if it is nearer to ``q`` than to those taken; then the nearest others."""
        if len(nodes) <= most:
            return nodes
        order = np.argsort(-cos, kind="stable")
        nodes, cos = nodes[order], cos[order]
        among = self.vectors[nodes] @ self.vectors[nodes].T
        closest = np.full(len(nodes), -2.0)
        taken = []
        for k in range(len(nodes)):
            if closest[k] < cos[k]:
                taken.append(k)
                if len(taken) == most:
                    break
                np.maximum(closest, among[k], out=closest)
        if len(taken) < most:
            kept = set(taken)
            taken += [k for k in range(len(nodes)) if k not in kept][: most - len(taken)]
        return nodes[taken]

    def _insert(self, node: int, level: int) -> None:
        q = self.vectors[node]
        start = np.array([self.entry])
        for layer in range(self._top, -1, -1):
            found, cos = self._beam(layer, q, start, BUILD_BEAM if layer <= level else 1)
            start = found
            if layer > level:
                continue
            links = self.layers[layer]
            most = links.shape[1]
            near = self._choose(q, found, cos, LINKS)
            links[node, : len(near)] = near
            for other in near.tolist():
                row = links[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                else:
                    both = np.append(row, node)
                    kept = self._choose(self.vectors[other], both, self.vectors[both] @ self.vectors[other], most)
                    row[:] = -1
                    row[: len(kept)] = kept
        if level > self._top:
            self.entry, self._top = node, level

    def within(self, q: np.ndarray, least: float, beam: int, slack: float = 0.04) -> np.ndarray:
        """Nodes with a cosine of at least ``least`` to ``q``: a beam search, then a flood among those nearly as close."""
        if not len(self.vectors):
            return np.empty(0, np.int64)
        if beam >= len(self.vectors):
            return np.flatnonzero(self.vectors @ q >= least)
        start = np.array([self.entry])
        for layer in range(self._top, 0, -1):
            start = self._beam(layer, q, start, 1)[0]
        met: list[tuple[np.ndarray, np.ndarray]] = []
        self._beam(0, q, start, beam, met)
        # Nodes that the beam met and dropped for nearer ones count too: more nodes may be linked than the beam is wide.
        found, cos = np.concatenate([n for n, _ in met]), np.concatenate([c for _, c in met])
        close = cos >= least - slack
        edge, hits = found[close], [found[cos >= least]]
        while len(edge):
            next_ = self.layers[0][edge].ravel()
            next_ = next_[next_ >= 0]
            next_ = np.unique(next_[self._seen[next_] != self._mark])
            self._seen[next_] = self._mark
            cos = self.vectors[next_] @ q
            edge = next_[cos >= least - slack]
            hits.append(next_[cos >= least])
        return np.concatenate(hits)

    def audited(self, queries: np.ndarray, least: float, beam: int, recall: float, own: np.ndarray | None = None) -> int:
        """The beam, doubled until the links of ``queries`` are found with ``recall`` against all vectors.

        ``own`` are the queries' nodes, if they stand in the graph: a query that finds itself proves nothing. Without a link
        among the queries it goes by nine in ten of their nearest nodes instead, so that an audit never passes on nothing.
        """
        cos = self.vectors @ queries.T
        if own is not None:
            cos[own, np.arange(len(own))] = -2.0
        truth = [np.flatnonzero(c >= least) for c in cos.T]
        bounds = np.full(len(queries), least)
        if not any(map(len, truth)) and len(self.vectors) > 1:
            truth, bounds, recall = [np.array([int(c.argmax())]) for c in cos.T], cos.max(axis=0) - 1e-9, min(recall, 0.9)
        total = sum(map(len, truth))
        while beam < len(self.vectors):
            if sum(int(np.isin(t, self.within(q, b, beam)).sum()) for q, t, b in zip(queries, truth, bounds, strict=True) if len(t)) >= recall * total:
                break
            beam *= 2
        return beam
