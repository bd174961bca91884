"""Bidirectional recurrent networks in numpy: GRU and LSTM cells with backpropagation through time, and a linear-chain CRF.

Inputs are integer symbols (time x batch). The input weights are one table row for each symbol, so a
step is a row lookup, a product with the recurrent weights and a few element-wise passes. Gates are hard
sigmoids (clip(x, 0, 1), with the offset of 1/2 in the table), candidates and outputs softsign
(x / (1 + |x|)): their cost per position is a fraction of exp's or tanh's.

The last symbol is padding: its fixed row closes the gates so that the state stays as it is. Shorter
sequences are padded at the end, for either direction.
"""

from __future__ import annotations

import numpy as np

F32 = np.float32
_SHUT = F32(1e4)


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Recurrent:
    """Both directions of a recurrent layer. kind: gru or lstm. n_symbols counts padding, the last one."""

    def __init__(self, kind: str, n_symbols: int, hidden: int, rng: np.random.Generator) -> None:
        self.kind, self.hidden, self.n_symbols = kind, hidden, n_symbols
        k = {"gru": 3, "lstm": 4}[kind]
        self.x = [rng.normal(0, 0.3, (n_symbols, k * hidden)).astype(F32) for _ in range(2)]
        self.u = [(rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, k * hidden))).astype(F32) for _ in range(2)]
        for x in self.x:
            x[:, : (k - 1) * hidden] += 0.5  # gates start half open
        self.shut()

    def shut(self) -> None:
        """Padding's row: keeps the state. GRU gates are z, r; LSTM's i, f, o."""
        for x in self.x:
            x[-1] = 0
            x[-1, : self.hidden] = _SHUT if self.kind == "gru" else -_SHUT

    def params(self) -> list[np.ndarray]:
        return [*self.x, *self.u]

    # ---- inference: no state is kept for gradients, buffers are reused, features are rows ----

    def states(self, ids: np.ndarray) -> np.ndarray:
        """States (time, 2 hidden, batch) of symbols (time, batch)."""
        steps, n = ids.shape
        H = self.hidden
        tables = [np.ascontiguousarray(x.T) for x in self.x]
        u = np.stack([np.ascontiguousarray(x.T) for x in self.u])
        k = u.shape[1] // H
        G = (k - 1) * H
        ids = np.ascontiguousarray(ids, dtype=np.intp)
        out = np.empty((steps, 2 * H, n), dtype=F32)
        h = np.zeros((2, H, n), dtype=F32)
        g, a = np.empty((2, k * H, n), F32), np.empty((2, k * H, n), F32)
        t1, t2, c = np.empty((2, H, n), F32), np.empty((2, H, n), F32), np.zeros((2, H, n), F32)
        ga, aa, last = g[:, :G], a[:, :G], g[:, G:]
        zero, one = F32(0), F32(1)
        for t in range(steps):
            np.take(tables[0], ids[t], axis=1, out=g[0], mode="clip")
            np.take(tables[1], ids[steps - 1 - t], axis=1, out=g[1], mode="clip")
            np.matmul(u, h, out=a)
            if self.kind == "gru":
                np.add(ga, aa, out=ga)
                np.maximum(ga, zero, out=ga)
                np.minimum(ga, one, out=ga)
                np.multiply(g[:, H:G], a[:, G:], out=t1)
                np.add(t1, last, out=t1)
                np.abs(t1, out=t2)
                np.add(t2, one, out=t2)
                np.divide(t1, t2, out=t1)  # candidate
                np.subtract(h, t1, out=t2)
                np.multiply(t2, g[:, :H], out=t2)
                np.add(t1, t2, out=h)
            else:
                np.add(g, a, out=g)
                np.maximum(ga, zero, out=ga)
                np.minimum(ga, one, out=ga)
                np.abs(last, out=t2)
                np.add(t2, one, out=t2)
                np.divide(last, t2, out=t1)
                np.multiply(t1, g[:, :H], out=t1)
                np.multiply(c, g[:, H : 2 * H], out=c)
                np.add(c, t1, out=c)
                np.abs(c, out=t2)
                np.add(t2, one, out=t2)
                np.divide(c, t2, out=t1)
                np.multiply(t1, g[:, 2 * H : G], out=h)
            out[t, :H] = h[0]
            out[steps - 1 - t, H:] = h[1]
        return out

    # ---- training ----

    def forward(self, ids: np.ndarray) -> tuple[np.ndarray, list]:
        """States (time, batch, 2 hidden) and what backward needs."""
        H, hs, tapes = self.hidden, [], []
        for d in range(2):
            seq = ids if d == 0 else ids[::-1]
            n = seq.shape[1]
            h, c = np.zeros((n, H), F32), np.zeros((n, H), F32)
            tape, states = [], []
            for s in seq:
                g, a = self.x[d][s], h @ self.u[d]
                if self.kind == "gru":
                    pre = g[:, : 2 * H] + a[:, : 2 * H]
                    gate = np.clip(pre, 0, 1)
                    raw = g[:, 2 * H :] + gate[:, H:] * a[:, 2 * H :]
                    cand = softsign(raw)
                    new = cand + gate[:, :H] * (h - cand)
                    tape.append((h, pre, gate, a[:, 2 * H :], cand))
                    h = new
                else:
                    pre = g + a
                    gate = np.clip(pre[:, : 3 * H], 0, 1)
                    cand = softsign(pre[:, 3 * H :])
                    new = gate[:, H : 2 * H] * c + gate[:, :H] * cand
                    out = softsign(new)
                    tape.append((h, c, pre, gate, cand, out))
                    c, h = new, gate[:, 2 * H :] * out
                states.append(h)
            hs.append(np.stack(states if d == 0 else states[::-1]))
            tapes.append(tape)
        return np.concatenate(hs, axis=2), [ids, tapes]

    def backward(self, dh_all: np.ndarray, saved: list) -> list[np.ndarray]:
        """Gradients in the order of params, from those of the states."""
        ids, tapes = saved
        H, dxs, dus = self.hidden, [], []
        for d in range(2):
            seq = ids if d == 0 else ids[::-1]
            dh_seq = dh_all[:, :, :H] if d == 0 else dh_all[::-1, :, H:]
            u, du = self.u[d], np.zeros_like(self.u[d])
            k = u.shape[1]
            n = seq.shape[1]
            carry, dc = np.zeros((n, H), F32), np.zeros((n, H), F32)
            dgs = np.empty((len(seq), n, k), F32)
            for t in range(len(seq) - 1, -1, -1):
                dh = dh_seq[t] + carry
                if self.kind == "gru":
                    h, pre, gate, an, cand = tapes[d][t]
                    z, r = gate[:, :H], gate[:, H:]
                    dn = dh * (1 - z) * (1 - np.abs(cand)) ** 2
                    dgate = np.concatenate([dh * (h - cand), dn * an], axis=1) * ((pre > 0) & (pre < 1))
                    dg = np.concatenate([dgate, dn], axis=1)
                    da = np.concatenate([dgate, dn * r], axis=1)
                    carry = dh * z + da @ u.T
                else:
                    h, c, pre, gate, cand, out = tapes[d][t]
                    i, f, o = gate[:, :H], gate[:, H : 2 * H], gate[:, 2 * H :]
                    dcell = dc + dh * o * (1 - np.abs(out)) ** 2
                    dgate = np.concatenate([dcell * cand, dcell * c, dh * out], axis=1) * ((pre[:, : 3 * H] > 0) & (pre[:, : 3 * H] < 1))
                    dg = da = np.concatenate([dgate, dcell * i * (1 - np.abs(cand)) ** 2], axis=1)
                    dc = dcell * f
                    carry = da @ u.T
                du += h.T @ da
                dgs[t] = dg
            onehot = np.zeros((seq.size, self.n_symbols), F32)
            onehot[np.arange(seq.size), seq.ravel()] = 1
            dx = onehot.T @ dgs.reshape(-1, k)
            dx[-1] = 0
            dxs.append(dx)
            dus.append(du)
        return [*dxs, *dus]


class Adam:
    """Adam with clipped gradients, over arrays that are changed in place."""

    def __init__(self, params: list[np.ndarray], rate: float = 0.01, clip: float = 1.0) -> None:
        self.params, self.rate, self.clip, self.t = params, rate, clip, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray], rate: float | None = None) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        scale = F32(min(1.0, self.clip / (norm + 1e-9)))
        rate = self.rate if rate is None else rate
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)).astype(p.dtype)


def log_sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class CRF:
    """Linear-chain CRF: transitions between tags, and scores of the first and last one."""

    def __init__(self, tags: int) -> None:
        self.trans, self.start, self.end = np.zeros((tags, tags), F32), np.zeros(tags, F32), np.zeros(tags, F32)

    def params(self) -> list[np.ndarray]:
        return [self.trans, self.start, self.end]

    def loss(self, e: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, list[np.ndarray]]:
        """Mean negative log likelihood of tags y (time, batch) for emissions e (time, batch, tags); gradients of e and params."""
        steps, n, k = e.shape
        alpha = np.empty_like(e)
        alpha[0] = self.start + e[0]
        for t in range(1, steps):
            alpha[t] = log_sum_exp(alpha[t - 1][:, :, None] + self.trans, 1) + e[t]
        z = log_sum_exp(alpha[-1] + self.end, 1)
        beta = np.empty_like(e)
        beta[-1] = self.end
        for t in range(steps - 2, -1, -1):
            beta[t] = log_sum_exp(self.trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        rows = np.arange(n)
        gold = self.start[y[0]] + self.end[y[-1]]
        for t in range(steps):
            gold = gold + e[t, rows, y[t]] + (self.trans[y[t - 1], y[t]] if t else 0)
        de = np.exp(alpha + beta - z[None, :, None])
        d_start, d_end = de[0].sum(0), de[-1].sum(0)
        d_trans = np.zeros_like(self.trans)
        for t in range(1, steps):
            d_trans += np.exp(alpha[t - 1][:, :, None] + self.trans + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
            np.subtract.at(d_trans, (y[t - 1], y[t]), 1)
        np.subtract.at(d_start, y[0], 1)
        np.subtract.at(d_end, y[-1], 1)
        de[np.arange(steps)[:, None], rows[None, :], y] -= 1
        scale = F32(1 / (steps * n))
        return float((z - gold).sum()) / (steps * n), (de * scale).astype(F32), [(g * scale).astype(F32) for g in (d_trans, d_start, d_end)]

    def decode(self, e: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """Best tags (time, batch); beyond a sequence's length tags are 0.

        Sequences whose best path is surely tag 0 throughout skip the search. A stretch of m positions with
        other tags gains at most the sum of their emissions' leads over tag 0's, m - 1 transitions within, one
        into it (or the start) and one out of it (or the end). If the best stretch, found by a running
        maximum, gains nothing, neither do several.
        """
        steps, n, k = e.shape
        lengths = np.full(n, steps) if lengths is None else lengths
        t00, inner = self.trans[0, 0], self.trans[1:, 1:].max() - self.trans[0, 0]
        enter, leave = self.trans[0, 1:].max() - t00, self.trans[1:, 0].max() - t00
        start, end = max(0.0, self.start[1:].max() - self.start[0] - enter), max(0.0, self.end[1:].max() - self.end[0] - leave)
        y = np.zeros((steps, n), dtype=np.int8)
        lead = e[:, :, 1].copy()
        for j in range(2, k):
            np.maximum(lead, e[:, :, j], out=lead)
        lead -= e[:, :, 0]
        lead += inner
        lead[0] += start
        lead[lengths - 1, np.arange(n)] += end
        best, now = np.full(n, -np.inf, F32), np.zeros(n, F32)
        lead[np.arange(steps)[:, None] >= lengths] = -np.inf
        for row in lead:
            np.maximum(now, 0, out=now)
            now += row
            np.maximum(best, now, out=best)
        some = np.flatnonzero(best > inner - enter - leave - 1e-3)  # rounding
        if not len(some):
            return y
        e, lens = e[:, some], lengths[some]
        score = self.start + e[0]
        back = np.zeros((steps, len(some), k), dtype=np.int8)
        for t in range(1, steps):
            best = score[:, :1] + self.trans[0]
            arg = back[t]
            for j in range(1, k):
                alt = score[:, j : j + 1] + self.trans[j]
                better = alt > best
                np.copyto(best, alt, where=better)
                arg[better] = j
            best += e[t]
            live = t < lens
            score = np.where(live[:, None], best, score)
            arg[~live] = np.arange(k)
        tag = (score + self.end).argmax(axis=1)
        rows = np.arange(len(some))
        for t in range(steps - 1, -1, -1):
            y[t, some] = np.where(t < lens, tag, 0)
            if t:
                tag = back[t, rows, tag]
        return y
