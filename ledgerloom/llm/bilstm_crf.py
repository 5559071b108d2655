"""A character tagger in numpy: embedding, bidirectional LSTM, linear-chain CRF; Adam on the exact gradient."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


class Tagger:
    """Batches are (time, row) arrays of symbols; all rows have one length, padded with symbol 0."""

    def __init__(self, n_symbols: int, n_tags: int, embed: int = 12, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        w = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {"emb": w(n_symbols, embed), "out": w(2 * hidden, n_tags), "bias": np.zeros(n_tags, np.float32), "trans": np.zeros((n_tags, n_tags), np.float32), "first": np.zeros(n_tags, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": w(embed, 4 * hidden), f"h{d}": w(hidden, 4 * hidden), f"g{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"g{d}"][hidden : 2 * hidden] = 1.0

    def _run(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        p, k = self.p, self.hidden
        gates_x = x @ p[f"x{d}"] + p[f"g{d}"]
        h = c = np.zeros((x.shape[1], k), np.float32)
        out = np.empty((*x.shape[:2], k), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = gates_x[t] + h @ p[f"h{d}"]
            s = _sigmoid(z[:, : 3 * k])
            i, f, o, g = s[:, :k], s[:, k : 2 * k], s[:, 2 * k :], np.tanh(z[:, 3 * k :])
            before, was = c, h
            c = f * c + i * g
            u = np.tanh(c)
            h = o * u
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before, was, u))
        return out

    def emissions(self, symbols: np.ndarray, tapes: dict | None = None) -> np.ndarray:
        x = self.p["emb"][symbols]
        halves = []
        for d in "fb":
            tape = [] if tapes is not None else None
            halves.append(self._run(x, d, tape))
            if tapes is not None:
                tapes[d] = tape
        both = np.concatenate(halves, 2)
        if tapes is not None:
            tapes |= {"x": x, "both": both}
        return both @ self.p["out"] + self.p["bias"]

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tag marginals, forward and backward messages, log partition."""
        n, a = len(e), self.p["trans"]
        fore, back = np.empty_like(e), np.zeros_like(e)
        fore[0] = e[0] + self.p["first"]
        for t in range(1, n):
            fore[t] = e[t] + _logsum(fore[t - 1][:, :, None] + a, 1)
        for t in range(n - 2, -1, -1):
            back[t] = _logsum(a + (e[t + 1] + back[t + 1])[:, None, :], 2)
        z = _logsum(fore[-1], 1)
        return np.exp(fore + back - z[None, :, None]), fore, back, z

    def decode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags, and for each symbol the probability that it has any tag but 0 (where a row has such a tag)."""
        e = self.emissions(symbols)
        best, prev = e[0] + self.p["first"], []
        for t in range(1, len(e)):
            paths = best[:, :, None] + self.p["trans"]
            prev.append(paths.argmax(1))
            best = paths.max(1) + e[t]
        tags = np.empty(symbols.shape, np.int64)
        tags[-1] = best.argmax(1)
        rows = np.arange(symbols.shape[1])
        for t in range(len(e) - 2, -1, -1):
            tags[t] = prev[t][rows, tags[t + 1]]
        sure = np.zeros(symbols.shape, np.float32)
        some = (tags > 0).any(0)
        if some.any():
            m = self.marginals(e[:, some])[0]
            sure[:, some] = 1 - m[:, :, 0]
        return tags, sure

    def _gradient(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        p, k, (n, rows) = self.p, self.hidden, symbols.shape
        tapes: dict = {}
        e = self.emissions(symbols, tapes)
        m, fore, back, z = self.marginals(e)
        grad = {name: np.zeros_like(v) for name, v in p.items()}
        hot = np.eye(e.shape[2], dtype=np.float32)[tags]
        gold = (e * hot).sum() + p["first"][tags[0]].sum() + p["trans"][tags[:-1], tags[1:]].sum()
        de = (m - hot) / rows
        grad["first"] += de[0].sum(0)
        for t in range(1, n):
            pair = np.exp(fore[t - 1][:, :, None] + p["trans"] + (e[t] + back[t] - z[:, None])[:, None, :])
            grad["trans"] += pair.sum(0) / rows
        np.add.at(grad["trans"], (tags[:-1].ravel(), tags[1:].ravel()), -1.0 / rows)
        grad["out"] += np.tensordot(tapes["both"], de, ((0, 1), (0, 1)))
        grad["bias"] += de.sum((0, 1))
        dboth = de @ p["out"].T
        dx = np.zeros_like(tapes["x"])
        for d, own in (("f", dboth[:, :, :k]), ("b", dboth[:, :, k:])):
            dh = dc = np.zeros((rows, k), np.float32)
            for t, i, f, o, g, before, was, u in reversed(tapes[d]):
                dh = dh + own[t]
                dc = dc + dh * o * (1 - u * u)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * u * o * (1 - o), dc * i * (1 - g * g)], 1)
                grad[f"x{d}"] += tapes["x"][t].T @ dz
                grad[f"h{d}"] += was.T @ dz
                grad[f"g{d}"] += dz.sum(0)
                dx[t] += dz @ p[f"x{d}"].T
                dh, dc = dz @ p[f"h{d}"].T, dc * f
        np.add.at(grad["emb"], symbols.ravel(), dx.reshape(-1, dx.shape[2]))
        return float((z.sum() - gold) / rows), grad

    def fit(self, symbols: np.ndarray, tags: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 11) -> list[float]:
        """Train on (row, time) arrays; returns the loss of each epoch."""
        rng, losses, step = np.random.default_rng(seed), [], 0
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            order, loss = rng.permutation(len(symbols)), 0.0
            lr = rate * (1 - epoch / epochs) + 1e-3
            for a in range(0, len(order), batch):
                own = order[a : a + batch]
                value, grad = self._gradient(symbols[own].T, tags[own].T)
                loss += value * len(own)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - lr * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(loss / max(1, len(symbols)))
        return losses
