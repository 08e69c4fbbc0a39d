"""A gated recurrent network over symbols with a class-factored softmax, in numpy.

Each step mixes the state with a candidate by a gate; both see the symbol through a row of a table (the product
of one-hot input and weights) and the state through one small matrix. A symbol is predicted from the state
before it: first its class, then the symbol among those of its class. Training runs over many texts side by
side, in windows of ``WINDOW`` steps: gradients stop at a window's start, the state goes on, and is zero at the
start of a text, in training also after every ``PIECE`` symbols of one. Scoring carries the state through a whole text.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

STATE = 16
WINDOW = 16
LANES = 512
PIECE = 2048  # symbols learned in a row, so that long texts fill many lanes
SCORED = 16384  # symbols scored at once
RATE = 0.08
_CLIP = 1.0
_NAMES = ("table", "state", "class_w", "class_b", "word_w", "word_b")


@dataclass
class GatedLM:
    """``bounds``: the symbols of class k are ``bounds[k]`` up to ``bounds[k + 1]``."""

    bounds: np.ndarray
    table: np.ndarray  # symbols x 2 states: gate and candidate
    state: np.ndarray  # states x 2 states
    class_w: np.ndarray  # states x classes
    class_b: np.ndarray
    word_w: np.ndarray  # states x symbols
    word_b: np.ndarray
    squares: dict[str, np.ndarray]  # sums of squared gradients

    @classmethod
    def start(cls, counts: np.ndarray, bounds: np.ndarray, state: int = STATE, seed: int = 1) -> GatedLM:
        """Small random weights; the biases are those of the symbols' frequencies."""
        random = np.random.default_rng(seed)
        n, k = len(counts), len(bounds) - 1
        smooth = counts.astype(np.float64) + 1
        in_class = np.add.reduceat(smooth, bounds[:-1])
        small = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
        own = dict(
            table=small(n, 2 * state),
            state=small(state, 2 * state),
            class_w=small(state, k),
            class_b=np.log(in_class / in_class.sum()).astype(np.float32),
            word_w=small(state, n),
            word_b=np.log(smooth / np.repeat(in_class, np.diff(bounds))).astype(np.float32),
        )
        return cls(bounds=bounds, squares={name: np.full_like(x, 1e-4) for name, x in own.items()}, **own)

    # -- parameters as one vector, for averaging

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in _NAMES] + [self.squares[n].ravel() for n in _NAMES])

    def with_vector(self, vector: np.ndarray) -> GatedLM:
        parts, at = {}, 0
        for where in ("own", "squares"):
            for n in _NAMES:
                like = getattr(self, n)
                parts[where, n] = vector[at : at + like.size].reshape(like.shape).astype(np.float32)
                at += like.size
        own = {n: parts["own", n] for n in _NAMES}
        return GatedLM(bounds=self.bounds, squares={n: parts["squares", n] for n in _NAMES}, **own)

    # -- one window

    def _states(self, symbols: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States before each step, activations of each step, and the last state. ``symbols``: steps x lanes."""
        steps, lanes = symbols.shape
        size = self.state.shape[0]
        states = np.empty((steps, lanes, size), np.float32)
        active = self.table[symbols]
        for t in range(steps):
            if fresh[t].any():
                h = h * ~fresh[t][:, None]
            states[t] = h
            a = active[t]
            a += h @ self.state
            np.tanh(a, out=a)
            h = h + (a[:, :size] * 0.5 + 0.5) * (a[:, size:] - h)
        return states, active, h

    def _small(self, weights: np.ndarray, bias: np.ndarray) -> bool:
        """Whether no score of these weights can overflow an exponential: states are between -1 and 1."""
        return float((np.abs(weights).sum(axis=0) + np.abs(bias)).max(initial=0.0)) < 80.0

    @staticmethod
    def _exponentials(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, small: bool) -> np.ndarray:
        scores = states @ weights
        scores += bias
        if not small:
            scores -= scores.max(axis=1, keepdims=True)
        return np.exp(scores, out=scores)

    def _by_class(self, symbols: np.ndarray, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the symbols by class, their classes in it, and where each class starts."""
        classes = class_of[symbols]
        order = np.argsort(classes, kind="stable")
        classes = classes[order]
        return order, classes, np.searchsorted(classes, np.arange(len(self.bounds), dtype=classes.dtype))

    def log_probs(self, states: np.ndarray, symbols: np.ndarray, class_of: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each symbol after the state of the same row."""
        order, classes, stops = self._by_class(symbols, class_of)
        states, symbols = states[order], symbols[order]
        e = self._exponentials(states, self.class_w, self.class_b, self._small(self.class_w, self.class_b))
        p = e[np.arange(len(symbols)), classes] / e.sum(axis=1)
        small = self._small(self.word_w, self.word_b)
        for k in np.flatnonzero((np.diff(self.bounds) > 1) & (np.diff(stops) > 0)):
            rows, a, b = slice(stops[k], stops[k + 1]), self.bounds[k], self.bounds[k + 1]
            e = self._exponentials(states[rows], self.word_w[:, a:b], self.word_b[a:b], small)
            p[rows] *= e[np.arange(len(e)), symbols[rows] - a] / e.sum(axis=1)
        out = np.empty(len(p))
        out[order] = np.log(np.maximum(p, np.finfo(np.float32).tiny))
        return out

    def _learn(self, symbols: np.ndarray, fresh: np.ndarray, valid: np.ndarray, h: np.ndarray, class_of: np.ndarray, rate: float) -> np.ndarray:
        """One step of gradient descent on a window; returns the state after it."""
        steps, lanes = symbols.shape
        size = self.state.shape[0]
        states, active, last = self._states(symbols, fresh, h)
        flat, target = states.reshape(-1, size), symbols.ravel()
        weight = np.float32(1.0 / max(1, int(valid.sum())) * lanes)
        keep = np.flatnonzero(valid.ravel())
        order, classes, stops = self._by_class(target[keep], class_of)
        keep = keep[order]
        seen, wanted = flat[keep], target[keep]
        # Classes
        off = self._exponentials(seen, self.class_w, self.class_b, self._small(self.class_w, self.class_b))
        off *= weight / off.sum(axis=1, keepdims=True)
        off[np.arange(len(classes)), classes] -= weight
        grads = {"class_w": seen.T @ off, "class_b": off.sum(axis=0)}
        back = off @ self.class_w.T
        # Symbols of each class
        grads["word_w"], grads["word_b"] = np.zeros_like(self.word_w), np.zeros_like(self.word_b)
        small = self._small(self.word_w, self.word_b)
        for k in np.flatnonzero((np.diff(self.bounds) > 1) & (np.diff(stops) > 0)):
            rows, a, b = slice(stops[k], stops[k + 1]), self.bounds[k], self.bounds[k + 1]
            own = seen[rows]
            off = self._exponentials(own, self.word_w[:, a:b], self.word_b[a:b], small)
            off *= weight / off.sum(axis=1, keepdims=True)
            off[np.arange(len(off)), wanted[rows] - a] -= weight
            grads["word_w"][:, a:b] = own.T @ off
            grads["word_b"][a:b] = off.sum(axis=0)
            back[rows] += off @ self.word_w[:, a:b].T
        d_states = np.zeros_like(flat)
        d_states[keep] = back
        d_states = d_states.reshape(states.shape)
        # Through time, from the last step to the window's start
        gate = active[:, :, :size] * 0.5 + 0.5
        slopes = 1 - active**2
        slopes[:, :, :size] *= 0.5 * (active[:, :, size:] - states)
        slopes[:, :, size:] *= gate
        stays = 1 - gate
        d_active = slopes  # each step's part is filled in place
        d = np.zeros((lanes, size), np.float32)
        turned = self.state.T.copy()
        for t in range(steps - 1, -1, -1):
            x = d_active[t]
            x[:, :size] *= d
            x[:, size:] *= d
            d = d * stays[t]
            d += x @ turned
            d += d_states[t]
            if fresh[t].any():
                d = d * ~fresh[t][:, None]
        d_flat = d_active.reshape(-1, 2 * size)
        grads["state"] = flat.T @ d_flat
        order = np.argsort(target.astype(np.uint16) if len(self.table) < 1 << 16 else target, kind="stable")
        met, starts = np.unique(target[order], return_index=True)
        rows = np.add.reduceat(d_flat[order], starts, axis=0)
        np.clip(rows, -_CLIP, _CLIP, out=rows)
        self.squares["table"][met] += rows**2
        self.table[met] -= rate * rows / np.sqrt(self.squares["table"][met])
        for name, grad in grads.items():
            np.clip(grad, -_CLIP, _CLIP, out=grad)
            self.squares[name] += grad**2
            getattr(self, name)[...] -= rate * grad / np.sqrt(self.squares[name])
        return last

    # -- whole texts

    def class_of(self) -> np.ndarray:
        kind = np.uint16 if len(self.bounds) < 1 << 16 else np.int64
        return np.repeat(np.arange(len(self.bounds) - 1, dtype=kind), np.diff(self.bounds))

    def train(self, texts: list[np.ndarray], lanes: int = LANES, rate: float = RATE) -> int:
        """One pass over texts; returns the number of symbols. Texts follow one another in each lane."""
        class_of = self.class_of()
        pieces = [text[at : at + PIECE] for text in texts for at in range(0, len(text), PIECE)]
        symbols, fresh, valid = _side_by_side(pieces, lanes)[:3]
        h = np.zeros((symbols.shape[1], self.state.shape[0]), np.float32)
        for at in range(0, len(symbols), WINDOW):
            live = int(valid[at].sum())  # lanes are in order of length
            part = slice(at, at + WINDOW)
            h = self._learn(symbols[part, :live], fresh[part, :live], valid[part, :live], h[:live], class_of, rate)
        return int(valid.sum())

    def score(self, texts: list[np.ndarray], lanes: int = LANES) -> np.ndarray:
        """Natural log of each whole text's probability."""
        class_of = self.class_of()
        symbols, fresh, valid, owner = _side_by_side(texts, lanes)
        h = np.zeros((symbols.shape[1], self.state.shape[0]), np.float32)
        total, at = np.zeros(len(texts)), 0
        while at < len(symbols):
            live = int(valid[at].sum())
            part = slice(at, at := at + max(WINDOW, SCORED // live))  # fewer lanes, longer windows
            states, _, h = self._states(symbols[part, :live], fresh[part, :live], h[:live])
            keep = np.flatnonzero(valid[part, :live].ravel())
            values = self.log_probs(states.reshape(-1, states.shape[2])[keep], symbols[part, :live].ravel()[keep], class_of)
            total += np.bincount(owner[part, :live].ravel()[keep], values, minlength=len(texts))
        return total


def _side_by_side(texts: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts dealt to lanes of about equal length, longest first: symbols, starts, valid places, text numbers (steps x lanes)."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    longest = max(map(len, texts), default=0)
    # No more lanes than the longest text leaves work for: places stay about as many as symbols.
    lanes = max(1, min(lanes, len(texts), 1 + sum(map(len, texts)) // max(1, longest)))
    heap = [(0, lane) for lane in range(lanes)]
    dealt: list[list[int]] = [[] for _ in range(lanes)]
    for i in order:
        length, lane = heapq.heappop(heap)
        dealt[lane].append(i)
        heapq.heappush(heap, (length + len(texts[i]), lane))
    dealt.sort(key=lambda ids: -sum(len(texts[i]) for i in ids))
    steps = sum(len(texts[i]) for i in dealt[0]) if texts else 0
    symbols, owner = np.zeros((lanes, steps), np.int32), np.zeros((lanes, steps), np.int32)
    fresh, valid = np.zeros((lanes, steps), bool), np.zeros((lanes, steps), bool)
    for lane, ids in enumerate(dealt):
        at = 0
        for i in ids:
            stop = at + len(texts[i])
            symbols[lane, at:stop], owner[lane, at:stop] = texts[i], i
            if stop > at:
                fresh[lane, at] = True
            at = stop
        valid[lane, :at] = True
    return tuple(np.ascontiguousarray(x.T) for x in (symbols, fresh, valid, owner))
