"""A small character tagger: a bidirectional LSTM under a linear-chain CRF, in numpy.

Tags are O, and B and I of each kind. Both directions run as one batched product for each step. The
CRF's gradient is the difference between its marginals and the labels; transitions to an I that does
not continue its own kind are forbidden throughout. ``fit`` takes adaptive gradient steps on labelled
windows of equal length; the same windows give the same weights.
"""

from __future__ import annotations

import numpy as np

# Sizes of a character's vector and of each direction's state, steps of training.
VECTOR, STATE = 12, 16
BATCH, STEPS, RATE = 64, 320, 0.02
FORBIDDEN = -1e4
# Characters: printable ASCII each, other white space, all others, and what lies outside a text.
SPACE, OTHER, OUTSIDE, CHARACTERS = 95, 96, 97, 98


def character_ids(codes: np.ndarray) -> np.ndarray:
    """Code points to characters of the model."""
    ids = np.where((codes >= 32) & (codes < 127), codes.astype(np.int64) - 32, OTHER)
    return np.where((codes >= 9) & (codes <= 13), SPACE, ids).astype(np.uint8)


def allowed(kinds: int) -> np.ndarray:
    """Which tag may follow which: 0 is O, 1 + 2k is B and 2 + 2k is I of kind k."""
    tags = 1 + 2 * kinds
    out = np.ones((tags, tags), dtype=bool)
    for k in range(kinds):
        out[:, 2 + 2 * k] = False
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


class Tagger:
    def __init__(self, kinds: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        tags = 1 + 2 * kinds
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.allowed = allowed(kinds)
        self.weights = {
            "vectors": draw(CHARACTERS, VECTOR),
            "inner": draw(2, VECTOR + STATE, 4 * STATE),
            "bias": np.zeros((2, 4 * STATE), np.float32),
            "out": draw(2 * STATE, tags),
            "out_bias": np.zeros(tags, np.float32),
            "follow": np.zeros((tags, tags), np.float32),
            "first": np.zeros(tags, np.float32),
        }
        # Remember at first.
        self.weights["bias"][:, STATE : 2 * STATE] = 1

    def _run(self, ids: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of tags for windows of characters, and what the way back needs."""
        w = self.weights
        vectors = w["vectors"][ids]
        inputs = np.stack([vectors, vectors[:, ::-1]])
        ahead = np.matmul(inputs, w["inner"][:, None, :VECTOR]) + w["bias"][:, None, None]
        windows, steps = ids.shape
        gates = np.empty((steps, 2, windows, 4 * STATE), np.float32)
        cells = np.zeros((steps + 1, 2, windows, STATE), np.float32)
        states = np.zeros((steps + 1, 2, windows, STATE), np.float32)
        inner = w["inner"][:, VECTOR:]
        for t in range(steps):
            z = ahead[:, :, t] + np.matmul(states[t], inner)
            gates[t, ..., : 3 * STATE] = _sigmoid(z[..., : 3 * STATE])
            gates[t, ..., 3 * STATE :] = np.tanh(z[..., 3 * STATE :])
            i, f, o, g = np.split(gates[t], 4, axis=-1)
            cells[t + 1] = f * cells[t] + i * g
            states[t + 1] = o * np.tanh(cells[t + 1])
        both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=-1).transpose(1, 0, 2)
        scores = both @ w["out"] + w["out_bias"]
        return scores, {"ids": ids, "inputs": inputs, "gates": gates, "cells": cells,
                        "states": states, "both": both}

    def _chain(self) -> np.ndarray:
        return np.where(self.allowed, self.weights["follow"], FORBIDDEN).astype(np.float32)

    def _forward_backward(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log totals from the left and from the right of each place, and of the whole."""
        chain, steps = self._chain(), scores.shape[1]
        left, right = np.empty_like(scores), np.zeros_like(scores)
        left[:, 0] = scores[:, 0] + self.weights["first"]
        for t in range(1, steps):
            left[:, t] = scores[:, t] + _log_sum(left[:, t - 1, :, None] + chain, 1)
            back = steps - 1 - t
            right[:, back] = _log_sum(chain + (scores[:, back + 1] + right[:, back + 1])[:, None], 2)
        return left, right, _log_sum(left[:, -1], 1)

    def log_marginals(self, ids: np.ndarray) -> np.ndarray:
        """Each tag's log probability at each place of each window."""
        left, right, total = self._forward_backward(self._run(ids)[0])
        return left + right - total[:, None, None]

    def loss_and_gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        w, (scores, kept) = self.weights, self._run(ids)
        left, right, total = self._forward_backward(scores)
        windows, steps, _ = scores.shape
        rows = np.arange(windows)
        chain = self._chain()
        own = scores[rows[:, None], np.arange(steps), tags].sum(axis=1) + w["first"][tags[:, 0]]
        own += chain[tags[:, :-1], tags[:, 1:]].sum(axis=1)
        back = np.exp(left + right - total[:, None, None])
        pairs = np.zeros_like(w["follow"])
        for t in range(1, steps):
            after = scores[:, t] + right[:, t] - total[:, None]
            pairs += np.exp(left[:, t - 1, :, None] + chain + after[:, None]).sum(axis=0)
        np.add.at(pairs, (tags[:, :-1], tags[:, 1:]), -1)
        back[rows[:, None], np.arange(steps), tags] -= 1
        gradients = {
            "first": back[:, 0].sum(axis=0),
            "follow": np.where(self.allowed, pairs, 0),
        }
        gradients |= self._way_back(back, kept)
        return float((total - own).mean()), {k: g / windows for k, g in gradients.items()}

    def _way_back(self, back: np.ndarray, kept: dict) -> dict:
        """Gradients of the recurrent part from those of the tags' scores."""
        w, (windows, steps, _) = self.weights, back.shape
        onto = (back @ w["out"].T).transpose(1, 0, 2)
        onto = np.stack([onto[..., :STATE], onto[::-1, ..., STATE:]], axis=1)
        inner = w["inner"][:, VECTOR:].transpose(0, 2, 1)
        state = np.zeros((2, windows, STATE), np.float32)
        cell = np.zeros_like(state)
        shaped = np.empty_like(kept["gates"])
        for t in range(steps - 1, -1, -1):
            i, f, o, g = np.split(kept["gates"][t], 4, axis=-1)
            state = state + onto[t]
            curved = np.tanh(kept["cells"][t + 1])
            cell = cell + state * o * (1 - curved * curved)
            shaped[t] = np.concatenate(
                [
                    cell * g * i * (1 - i),
                    cell * kept["cells"][t] * f * (1 - f),
                    state * curved * o * (1 - o),
                    cell * i * (1 - g * g),
                ],
                axis=-1,
            )
            cell = cell * f
            state = np.matmul(shaped[t], inner)
        shaped = shaped.transpose(1, 2, 0, 3)
        inputs = np.concatenate([kept["inputs"], kept["states"][:-1].transpose(1, 2, 0, 3)], axis=-1)
        # A product for each window is small enough to stay in one thread.
        gradient = np.matmul(inputs.transpose(0, 1, 3, 2), shaped).sum(axis=1)
        onto = np.matmul(shaped, w["inner"][:, None, :VECTOR].transpose(0, 1, 3, 2))
        vectors = np.zeros_like(w["vectors"])
        np.add.at(vectors, kept["ids"], onto[0] + onto[1][:, ::-1])
        out = np.matmul(kept["both"].transpose(0, 2, 1), back).sum(axis=0)
        return {"vectors": vectors, "inner": gradient, "bias": shaped.sum(axis=(1, 2)),
                "out": out, "out_bias": back.sum(axis=(0, 1))}

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> Tagger:
        """Adam with a rate that falls to zero, on windows in a fixed random order."""
        rng = np.random.default_rng(5)
        mean = {k: np.zeros_like(x) for k, x in self.weights.items()}
        square = {k: np.zeros_like(x) for k, x in self.weights.items()}
        order = np.zeros(0, dtype=np.int64)
        for done in range(1, steps + 1):
            if len(order) < min(BATCH, len(ids)):
                order = np.concatenate([order, rng.permutation(len(ids))])
            part, order = order[:BATCH], order[BATCH:]
            _, gradients = self.loss_and_gradients(ids[part], tags[part])
            size = np.sqrt(sum(float((g * g).sum()) for g in gradients.values()))
            rate = RATE * (1 - (done - 1) / steps)
            for k, g in gradients.items():
                g = g * min(1.0, 5.0 / max(size, 1e-9))
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                step = mean[k] / (1 - 0.9**done)
                step /= np.sqrt(square[k] / (1 - 0.999**done)) + 1e-8
                self.weights[k] -= (rate * step).astype(np.float32)
        return self


def best_paths(scores: np.ndarray, lengths: np.ndarray, may_follow: np.ndarray) -> np.ndarray:
    """The best allowed path of tags through each row of ``scores``, of which ``lengths`` count."""
    rows, steps, tags = scores.shape
    chain = np.where(may_follow, 0.0, FORBIDDEN)
    best = scores[:, 0].astype(float)
    came = np.zeros((steps, rows, tags), dtype=np.int8)
    same = np.arange(tags)
    for t in range(1, steps):
        ways = best[:, :, None] + chain
        came[t] = ways.argmax(axis=1)
        onward = ways.max(axis=1) + scores[:, t]
        # Beyond a row's end its state stays as it is.
        ended = (t >= lengths)[:, None]
        came[t] = np.where(ended, same, came[t])
        best = np.where(ended, best, onward)
    path = np.zeros((rows, steps), dtype=np.int64)
    path[:, -1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = came[t, np.arange(rows), path[:, t]]
    return path
