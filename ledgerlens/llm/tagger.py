"""Character tagger: bidirectional LSTM with CRF transitions, written in numpy.

Windows are (time, batch) arrays of character codes. Training is plain Adam on the CRF likelihood
with hand-written gradients; decoding is Viterbi over the batch."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lstm(inputs: np.ndarray, wh: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states for precomputed input parts (time, batch, 4 * size)."""
    steps, batch, wide = inputs.shape
    size = wide // 4
    h = np.zeros((batch, size), inputs.dtype)
    c = np.zeros((batch, size), inputs.dtype)
    out, trace = np.empty((steps, batch, size), inputs.dtype), []
    for t in range(steps):
        z = inputs[t] + h @ wh
        gates = _sigmoid(z[:, : 3 * size])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        g = np.tanh(z[:, 3 * size :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            trace.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        out[t] = h
    return out, trace


def _lstm_back(grad: np.ndarray, wh: np.ndarray, trace: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input parts and of ``wh`` for gradients of the hidden states."""
    steps, batch, size = grad.shape
    out = np.empty((steps, batch, 4 * size), grad.dtype)
    dwh = np.zeros_like(wh)
    dh = np.zeros((batch, size), grad.dtype)
    dc = np.zeros((batch, size), grad.dtype)
    for t in reversed(range(steps)):
        h, before, i, f, o, g, squashed = trace[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed**2)
        z = out[t]
        z[:, :size] = dc * g * i * (1 - i)
        z[:, size : 2 * size] = dc * before * f * (1 - f)
        z[:, 2 * size : 3 * size] = dh * squashed * o * (1 - o)
        z[:, 3 * size :] = dc * i * (1 - g**2)
        dwh += h.T @ z
        dh = z @ wh.T
        dc = dc * f
    return out, dwh


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Weights by name; ``tags`` counts the labels, ``alphabet`` the character codes."""

    alphabet: int
    tags: int
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, alphabet: int, tags: int, embed: int = 12, size: int = 20, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)

        def some(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        weights = {"embed": rng.standard_normal((alphabet, embed)).astype(np.float32) * 0.3}
        for side in ("left", "right"):
            weights[f"{side}_x"] = some(embed, 4 * size)
            weights[f"{side}_h"] = some(size, 4 * size)
            weights[f"{side}_b"] = np.zeros(4 * size, np.float32)
            weights[f"{side}_b"][size : 2 * size] = 1
        weights["out"] = some(2 * size, tags)
        weights["out_b"] = np.zeros(tags, np.float32)
        weights["moves"] = np.zeros((tags, tags), np.float32)
        return cls(alphabet, tags, weights)

    def _scores(self, codes: np.ndarray, keep: bool = False):
        w = self.weights
        x = w["embed"][codes]
        left, left_trace = _lstm(x @ w["left_x"] + w["left_b"], w["left_h"], keep)
        right, right_trace = _lstm(x[::-1] @ w["right_x"] + w["right_b"], w["right_h"], keep)
        hidden = np.concatenate([left, right[::-1]], axis=2)
        return hidden @ w["out"] + w["out_b"], (x, hidden, left_trace, right_trace)

    def gradients(self, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags, and its gradients."""
        w = self.weights
        scores, (x, hidden, left_trace, right_trace) = self._scores(codes, keep=True)
        steps, batch, tags = scores.shape
        moves = w["moves"]
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = scores[t] + _lse(ahead[t - 1][:, :, None] + moves, 1)
        for t in reversed(range(steps - 1)):
            behind[t] = _lse(moves + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _lse(ahead[-1], 1)
        share = np.exp(ahead + behind - total[:, None])
        rows, columns = np.arange(steps)[:, None], np.arange(batch)
        chosen = scores[rows, columns, gold].sum() + moves[gold[:-1], gold[1:]].sum()
        loss = float((total.sum() - chosen) / batch)
        dscores = share
        dscores[rows, columns, gold] -= 1
        dscores /= batch
        pairs = np.exp(ahead[:-1, :, :, None] + moves + (scores[1:] + behind[1:])[:, :, None, :] - total[:, None, None])
        dmoves = pairs.sum(axis=(0, 1))
        np.subtract.at(dmoves, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        grads = {"moves": dmoves / batch}
        flat = hidden.reshape(-1, hidden.shape[2])
        grads["out"] = flat.T @ dscores.reshape(-1, tags)
        grads["out_b"] = dscores.sum(axis=(0, 1))
        dhidden = dscores @ w["out"].T
        size = dhidden.shape[2] // 2
        dleft, grads["left_h"] = _lstm_back(dhidden[:, :, :size], w["left_h"], left_trace)
        dright, grads["right_h"] = _lstm_back(dhidden[::-1, :, size:], w["right_h"], right_trace)
        dx = dleft @ w["left_x"].T + (dright @ w["right_x"].T)[::-1]
        wide = x.shape[2]
        grads["left_x"] = x.reshape(-1, wide).T @ dleft.reshape(-1, dleft.shape[2])
        grads["right_x"] = x[::-1].reshape(-1, wide).T @ dright.reshape(-1, dright.shape[2])
        grads["left_b"], grads["right_b"] = dleft.sum(axis=(0, 1)), dright.sum(axis=(0, 1))
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], codes.ravel(), dx.reshape(-1, wide))
        return loss, grads

    def fit(self, codes: np.ndarray, gold: np.ndarray, steps: int = 300, batch: int = 64, rate: float = 0.012, seed: int = 5) -> float:
        """Adam over random batches of windows (window, time); returns the last mean loss."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        recent = []
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(codes), batch)
            loss, grads = self.gradients(codes[pick].T, gold[pick].T)
            recent = [*recent[-19:], loss]
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = g * scale
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                at = first[k] / (1 - 0.9**step)
                self.weights[k] = (self.weights[k] - pace * at / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return float(np.mean(recent)) if recent else 0.0

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tags of windows (window, time)."""
        scores, _ = self._scores(codes.T)
        steps, batch, tags = scores.shape
        moves = self.weights["moves"]
        best, back = scores[0], np.empty((steps, batch, tags), np.int8)
        for t in range(1, steps):
            paths = best[:, :, None] + moves
            back[t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + scores[t]
        out = np.empty((steps, batch), np.int8)
        out[-1] = best.argmax(axis=1)
        for t in reversed(range(1, steps)):
            out[t - 1] = back[t][np.arange(batch), out[t]]
        return out.T
