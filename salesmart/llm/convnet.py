"""A small convolutional text classifier in numpy: embeddings, several filter widths, max pooling, softmax."""

from __future__ import annotations

import numpy as np


class ConvNet:
    """Symbols are integers below ``symbols``; symbol 0 is padding and has a zero embedding.

    Every filter passes on its ``top`` largest responses among the maxima of stretches of
    ``stretch`` positions (``stretch`` 0: one maximum over all positions).
    """

    def __init__(self, symbols: int, size: int, widths: tuple[int, ...], filters: int, classes: int, top: int = 1, stretch: int = 0, seed: int = 7):
        self.top, self.stretch = top, stretch
        rng = np.random.default_rng(seed)
        self.widest, self.size = max(widths), size
        wide = self.widest * size
        self.embedding = rng.normal(0, 0.3, (symbols, size)).astype(np.float32)
        self.embedding[0] = 0
        self.mask = np.zeros((wide, filters * len(widths)), np.float32)
        for k, w in enumerate(widths):
            self.mask[: w * size, k * filters : (k + 1) * filters] = 1
        self.weights = (rng.normal(0, 1, self.mask.shape) * self.mask / np.sqrt(self.mask.sum(0))).astype(np.float32)
        self.bias = np.zeros(self.weights.shape[1], np.float32)
        self.head = rng.normal(0, 0.1, (top * self.weights.shape[1], classes)).astype(np.float32)
        self.offset = np.zeros(classes, np.float32)

    def _padded(self, ids: np.ndarray) -> np.ndarray:
        return np.pad(ids, ((0, 0), (0, self.widest - 1)))

    def _responses(self, ids: np.ndarray) -> np.ndarray:
        """(rows, positions, filters) before pooling."""
        x = self.embedding[self._padded(ids)]
        rows, length, d = x.shape
        view = np.lib.stride_tricks.as_strided(x, (rows, ids.shape[1], self.widest * d), x.strides)
        return (view.reshape(-1, self.widest * d) @ self.weights).reshape(rows, ids.shape[1], -1)

    def _winners(self, responses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest responses (rows, top, filters) and their positions."""
        rows, length, n = responses.shape
        if not self.stretch:
            best = responses.argmax(1)[:, None]
            return np.take_along_axis(responses, best, 1), best
        count = max(self.top, -(-length // self.stretch))
        filled = np.full((rows, count * self.stretch, n), -np.inf, np.float32)
        filled[:, :length] = responses
        filled = filled.reshape(rows, count, self.stretch, n)
        largest = filled.max(2)
        first = np.argpartition(-largest, self.top - 1, axis=1)[:, : self.top] if count > self.top else np.broadcast_to(np.arange(count)[None, :, None], largest.shape)
        value = np.take_along_axis(largest, first, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        first, value = np.take_along_axis(first, order, 1), np.take_along_axis(value, order, 1)
        inner = filled[np.arange(rows)[:, None, None], first, :, np.arange(n)].argmax(3)
        return value, np.minimum(first * self.stretch + inner, length - 1)

    def _found(self, ids: np.ndarray, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """Winners of ``ids``; rows of more than ``most`` symbols together go through in parts that hold whole stretches."""
        if ids.size <= most or not self.stretch:
            return self._winners(self._responses(ids))
        part = max(1, most // (len(ids) * self.stretch)) * self.stretch
        some = []
        for start in range(0, ids.shape[1], part):
            here = ids[:, start : start + part + self.widest - 1]
            value, best = self._winners(self._responses(here)[:, : min(part, ids.shape[1] - start)])
            some.append((value, best + start))
            if len(some) > 1:
                value, best = (np.concatenate(x, 1) for x in zip(*some, strict=True))
                order = np.argsort(-value, axis=1, kind="stable")[:, : self.top]
                some = [(np.take_along_axis(value, order, 1), np.take_along_axis(best, order, 1))]
        return some[0]

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """The largest responses of every filter, one row per row of ``ids``: (rows, top, filters)."""
        responses = self._responses(ids)
        if not self.stretch:
            return np.maximum(responses.max(1, keepdims=True) + self.bias, 0)
        rows, length, n = responses.shape
        count = max(self.top, -(-length // self.stretch))
        whole = length // self.stretch
        largest = np.full((rows, count, n), -np.inf, np.float32)
        largest[:, :whole] = responses[:, : whole * self.stretch].reshape(rows, whole, self.stretch, n).max(2)
        if length % self.stretch:
            largest[:, whole] = responses[:, whole * self.stretch :].max(1)
        return np.maximum(self.strongest(largest) + self.bias, 0)

    def strongest(self, values: np.ndarray) -> np.ndarray:
        """The ``top`` largest along the second axis, in descending order."""
        if values.shape[1] > self.top:
            values = -np.partition(-values, self.top - 1, axis=1)[:, : self.top]
        return -np.sort(-values, axis=1)

    def log_probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled.reshape(len(pooled), -1) @ self.head + self.offset
        z = z - z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def step(self, ids: np.ndarray, labels: np.ndarray, weight: np.ndarray, rate: float, decay: float) -> None:
        """One Adam step; only the winning positions of the pooling carry gradients."""
        value, best = self._found(ids)
        pooled = np.maximum(value + self.bias, 0)
        error = np.exp(self.log_probabilities(pooled))
        error[np.arange(len(labels)), labels] -= 1
        error *= (weight / weight.sum())[:, None]
        back = (error @ self.head.T).reshape(pooled.shape) * (pooled > 0)
        won = self._padded(ids)[np.arange(len(ids))[:, None, None, None], best[..., None] + np.arange(self.widest)]
        x = self.embedding[won].reshape(*best.shape, -1)
        grads = {
            "head": pooled.reshape(len(pooled), -1).T @ error, "offset": error.sum(0), "bias": back.sum((0, 1)),
            "weights": np.einsum("btf,btfk->kf", back, x) * self.mask + decay * self.weights,
        }
        to_symbols = (back[..., None] * self.weights.T).reshape(*won.shape, self.size)
        grad = np.zeros_like(self.embedding)
        np.add.at(grad, won.reshape(-1), to_symbols.reshape(-1, self.size))
        grad[0] = 0
        grads["embedding"] = grad + decay * self.embedding
        if not hasattr(self, "moments"):
            self.moments, self.steps = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in grads.items()}, 0
        self.steps += 1
        for name, g in grads.items():
            m, v = self.moments[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            getattr(self, name)[...] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)

    def trained(self) -> ConvNet:
        self.__dict__.pop("moments", None)
        return self
