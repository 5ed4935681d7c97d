"""A small character convolutional network in numpy.

Characters become vectors, a convolution looks at five in a row, the strongest response of each
filter over the candidate and over its surroundings is kept, and a hidden layer joins them.
Trained with Adam on the logistic loss, one epoch a call: networks that started alike and learned from
different parts of the examples are put together by averaging their states.
"""

from __future__ import annotations

import numpy as np

from ledgerloom.llm.boosting import sigmoid

#: The characters told apart; all others share one code, and 0 pads.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n\"'=:;,.+/_-()[]{}<>@#$%&*!?"
SIZE = len(ALPHABET) + 2
_CODES = np.ones(129, np.uint8)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(2, SIZE)


class CharCNN:
    def __init__(self, inside: int = 48, around: int = 16, width: int = 5, vector: int = 8, filters: int = 24, hidden: int = 16, seed: int = 5):
        """A window holds ``around`` characters before the candidate, its first ``inside``, and
        ``around`` behind it; a longer candidate gives further windows, of which the best counts."""
        self.inside, self.around, self.width = inside, around, width
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        channels = vector + 1
        self.w = {
            "embed": rng.normal(0, 0.5, (SIZE, vector)),
            "conv": normal(width * channels, filters),
            "conv0": np.zeros(filters),
            "dense": normal(2 * filters, hidden),
            "dense0": np.zeros(hidden),
            "out": normal(hidden, 1),
            "out0": np.zeros(1),
        }
        self.step = np.zeros(1)
        self.moved = {**self.w, "step": self.step}
        self.moved |= {f"{moment} {k}": np.zeros_like(v) for k, v in self.w.items() for moment in ("mean", "square")}

    def encode(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """One window for each ``inside`` characters of the candidate: its codes, and how many characters are its own."""
        own = np.minimum(self.inside, end - np.arange(start, max(end, start + 1), self.inside))
        shown = text[max(0, start - self.around) : end + self.around].encode("utf-32-le", "surrogatepass")
        points = np.minimum(np.frombuffer(shown, "<u4"), 128)
        length = self.inside + 2 * self.around
        codes = np.zeros((len(own) - 1) * self.inside + length, np.uint8)
        lead = max(0, self.around - start)
        codes[lead : lead + len(points)] = _CODES[points]
        return np.lib.stride_tricks.sliding_window_view(codes, length)[:: self.inside], own

    def windows(self, asked: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, own characters and owners of the windows of several candidates."""
        coded = [self.encode(*a) for a in asked]
        length = self.inside + 2 * self.around
        return (
            np.concatenate([np.zeros((0, length), np.uint8), *[c for c, _ in coded]]),
            np.concatenate([np.zeros(0, int), *[o for _, o in coded]]),
            np.repeat(np.arange(len(coded)), [len(o) for _, o in coded]),
        )

    def _marked(self, own: np.ndarray) -> np.ndarray:
        at = np.arange(self.inside + 2 * self.around) - self.around
        return ((at >= 0) & (at < own[:, None])).astype(float)

    def _forward(self, codes: np.ndarray, own: np.ndarray):
        w, own = self.w, self._marked(own)
        x = np.concatenate((w["embed"][codes] * (codes > 0)[..., None], own[..., None]), axis=2)
        rows = np.lib.stride_tricks.sliding_window_view(x, self.width, axis=1).transpose(0, 1, 3, 2)
        rows = rows.reshape(len(x), x.shape[1] - self.width + 1, -1)
        act = rows @ w["conv"] + w["conv0"]
        middle = own[:, self.width // 2 : self.width // 2 + act.shape[1], None] > 0
        inner, outer = np.where(middle, act, -1e9), np.where(middle, -1e9, act)
        tops = [inner.argmax(axis=1), outer.argmax(axis=1)]
        pooled = np.concatenate([np.take_along_axis(act, t[:, None], axis=1)[:, 0] for t in tops], axis=1)
        pooled = np.maximum(pooled, 0)
        hidden = np.maximum(pooled @ w["dense"] + w["dense0"], 0)
        return (hidden @ w["out"] + w["out0"])[:, 0], (rows, tops, pooled, hidden)

    def margin(self, codes: np.ndarray, own: np.ndarray, batch: int = 512) -> np.ndarray:
        parts = [self._forward(codes[i : i + batch], own[i : i + batch])[0] for i in range(0, len(codes), batch)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _gradients(self, codes, own, y):
        w = self.w
        margin, (rows, tops, pooled, hidden) = self._forward(codes, own)
        d = ((sigmoid(margin) - y) / len(y))[:, None]
        g = {"out": hidden.T @ d, "out0": d.sum(axis=0)}
        d = (d @ w["out"].T) * (hidden > 0)
        g["dense"], g["dense0"] = pooled.T @ d, d.sum(axis=0)
        d = (d @ w["dense"].T) * (pooled > 0)
        filters = w["conv"].shape[1]
        g["conv"], g["conv0"] = np.zeros_like(w["conv"]), np.zeros(filters)
        g["embed"] = np.zeros_like(w["embed"])
        vector, n = w["embed"].shape[1], np.arange(len(y))[:, None]
        for part, top in enumerate(tops):
            dp = d[:, part * filters : (part + 1) * filters]
            chosen = rows[n, top]  # the five characters that each filter liked best
            g["conv"] += np.einsum("nfk,nf->kf", chosen, dp)
            g["conv0"] += dp.sum(axis=0)
            back = (dp[:, :, None] * w["conv"].T[None]).reshape(len(y), filters, self.width, vector + 1)
            seen = codes[n[:, :, None], top[:, :, None] + np.arange(self.width)]
            np.add.at(g["embed"], seen.ravel(), back[..., :vector].reshape(-1, vector))
        g["embed"][0] = 0
        return g

    def state(self) -> np.ndarray:
        """Weights, Adam's moments and its number of steps, as one row of numbers."""
        return np.concatenate([self.moved[k].ravel() for k in self.moved])

    def restored(self, state: np.ndarray) -> CharCNN:
        at = 0
        for v in self.moved.values():
            v[...] = state[at : at + v.size].reshape(v.shape)
            at += v.size
        return self

    def epoch(self, codes: np.ndarray, own: np.ndarray, y: np.ndarray, seed: list[int], batch: int = 128, rate: float = 4e-3) -> CharCNN:
        """Every example once, in an order that ``seed`` fixes."""
        order = np.random.default_rng(seed).permutation(len(y))
        for at in range(0, len(y), batch):
            rows = order[at : at + batch]
            self.step += 1
            for k, g in self._gradients(codes[rows], own[rows], y[rows]).items():
                mean, square = self.moved["mean " + k], self.moved["square " + k]
                mean[...] = 0.9 * mean + 0.1 * g
                square[...] = 0.999 * square + 0.001 * g * g
                self.w[k] -= rate * (mean / (1 - 0.9**self.step)) / (np.sqrt(square / (1 - 0.999**self.step)) + 1e-8)
        return self
