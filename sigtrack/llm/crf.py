"""Linear-chain conditional random fields over many sequences laid end to end.

Sequences follow each other in one array; ``first`` marks their first items. The array is cut
into equal chunks that are worked on side by side: the product of each chunk's transition
matrices gives what reaches the next one, so long sequences cost no more than short ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Learned transitions (from, to) and weights of first labels, both as logarithms."""

    transitions: np.ndarray
    start: np.ndarray

    def marginals(self, scores: np.ndarray, first: np.ndarray, chunk: int = 256, pairs: bool = False):
        """Posterior of each item's labels by forward-backward; with ``pairs`` also the expected transitions."""
        n, k = scores.shape
        if not n:
            return (scores, np.zeros((k, k))) if pairs else scores
        chunk = min(chunk, n)
        s = -(-n // chunk)
        pot = np.ones((s * chunk, k), np.float32)
        pot[:n] = np.exp(scores - scores.max(1, keepdims=True))
        new = np.ones(s * chunk, bool)
        new[:n], new[0] = first, True
        pot, new = pot.reshape(s, chunk, k).transpose(1, 0, 2).copy(), new.reshape(s, chunk).T.copy()
        t = np.exp(self.transitions - self.transitions.max()).astype(np.float32)
        begin = np.exp(self.start - self.start.max()).astype(np.float32)

        prod = np.broadcast_to(np.eye(k, dtype=np.float32), (s, k, k)).copy()
        for c in range(chunk):
            step = (prod.reshape(-1, k) @ t).reshape(s, k, k)
            if new[c].any():
                step[new[c]] = prod[new[c]].sum(2, keepdims=True) * begin
            prod = step * pot[c][:, None, :]
            prod /= prod.max((1, 2), keepdims=True)
        into = np.ones((s, k), np.float32)
        for i in range(1, s):
            v = into[i - 1] @ prod[i - 1]
            into[i] = v / v.max()
        back = np.ones((s, k), np.float32)
        for i in range(s - 2, -1, -1):
            v = prod[i + 1] @ back[i + 1]
            back[i] = v / v.max()

        ahead = np.empty((chunk, s, k), np.float32)
        v = into
        for c in range(chunk):
            step = v @ t
            if new[c].any():
                step[new[c]] = v[new[c]].sum(1, keepdims=True) * begin
            v = step * pot[c]
            v /= v.max(1, keepdims=True)
            ahead[c] = v
        expected = np.zeros((k, k))
        post, v = np.empty((chunk, s, k), np.float32), back
        for c in range(chunk - 1, -1, -1):
            p = ahead[c] * v
            post[c] = p / p.sum(1, keepdims=True)
            e = pot[c] * v
            if pairs:
                before = ahead[c - 1] if c else into
                real = ~new[c]
                xi = before[real][:, :, None] * t[None] * e[real][:, None, :]
                expected += (xi / xi.sum((1, 2), keepdims=True)).sum(0)
            v = e @ t.T
            if new[c].any():
                v[new[c]] = (e[new[c]] * begin).sum(1, keepdims=True)
            v /= v.max(1, keepdims=True)
        post = post.transpose(1, 0, 2).reshape(-1, k)[:n]
        return (post, expected) if pairs else post

    def viterbi(self, scores: list[list[float]]) -> list[int]:
        """The best labels of one sequence."""
        t, k = self.transitions.tolist(), range(len(self.start))
        best, came = [s + x for s, x in zip(self.start.tolist(), scores[0])] if scores else [], []
        for row in scores[1:]:
            ways = [max((best[i] + t[i][j], -i) for i in k) for j in k]
            came.append([-i for _, i in ways])
            best = [w + x for (w, _), x in zip(ways, row)]
        at = max(k, key=lambda j: (best[j], -j)) if scores else 0
        out = [at] if scores else []
        for row in reversed(came):
            out.append(row[out[-1]])
        return out[::-1]


def fit(features: np.ndarray, owner: np.ndarray, n_features: int, items: np.ndarray, labels: np.ndarray, first: np.ndarray, k: int, *, steps: int = 25, rate: float = 0.25, decay: float = 1e-4, values: np.ndarray | None = None) -> tuple[np.ndarray, Chain]:
    """Weights (feature, label) and chain that make ``labels`` likely, by Adam on all sequences at once.

    Item types have sparse features: ``features[i]`` belongs to type ``owner[i]`` with value
    ``values[i]`` (1 if not given); ``items`` has the type of each place in the sequences.
    """
    types = int(owner.max()) + 1 if len(owner) else 0
    values = np.ones(len(features), np.float32) if values is None else values
    w, t, b = np.zeros((n_features, k)), np.zeros((k, k)), np.zeros(k)
    follows = np.flatnonzero(~first)
    seen_t = np.zeros((k, k))
    np.add.at(seen_t, (labels[follows - 1], labels[follows]), 1)
    seen_b = np.bincount(labels[first], minlength=k).astype(float)
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (w, t, b)]
    at = np.arange(len(items))
    for step in range(1, steps + 1):
        score = np.stack([np.bincount(owner, w[features, j] * values, types) for j in range(k)], 1)
        post, pairs = Chain(t, b).marginals(score[items], first, pairs=True)
        error = -post.astype(float)
        error[at, labels] += 1
        by_type = np.stack([np.bincount(items, error[:, j], types) for j in range(k)], 1)
        grad = np.stack([np.bincount(features, by_type[owner, j] * values, n_features) for j in range(k)], 1)
        n = len(items)
        grads = [grad / n - decay * w, (seen_t - pairs) / n, (seen_b - post[first].sum(0)) / n]
        for x, g, (m, v) in zip((w, t, b), grads, state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w.astype(np.float32), Chain(t, b)
