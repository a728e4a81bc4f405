"""A character-level tagger in numpy: embeddings, a bidirectional LSTM, and a CRF over its outputs.

Windows all have the same width, so a batch is one array of character numbers; a position past the end of a text
holds PAD. Weights are a dictionary of float32 arrays. Tag 0 is outside, tags 2k + 1 and 2k + 2 begin and
continue a span of kind k; a tag that continues can only follow a tag of its own kind.
"""

from __future__ import annotations

import numpy as np

CHARS, PAD = 131, 130
_FAR = np.float32(-1e4)
Weights = dict[str, np.ndarray]


def characters(text: str) -> np.ndarray:
    """A number for each code point: ASCII as it is, one for further Latin letters, one for all the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 128, points, np.where((points >= 0xC0) & (points < 0x250), 128, 129)).astype(np.int64)


def allowed(kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Added scores: 0 for a first tag, or a step between two tags, that makes sense, else far below."""
    tags = 2 * kinds + 1
    first, steps = np.zeros(tags, dtype=np.float32), np.zeros((tags, tags), dtype=np.float32)
    for k in range(kinds):
        first[2 * k + 2] = _FAR
        steps[:, 2 * k + 2] = _FAR
        steps[[2 * k + 1, 2 * k + 2], 2 * k + 2] = 0
    return first, steps


def fresh_weights(kinds: int, rng: np.random.Generator, embedding: int = 16, hidden: int = 24) -> Weights:
    def some(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    tags = 2 * kinds + 1
    weights = {"embedding": 0.3 * some(1, CHARS, embedding)[0], "out": some(2 * hidden, tags), "bias": np.zeros(tags, np.float32)}
    weights |= {"first": np.zeros(tags, np.float32), "steps": np.zeros((tags, tags), np.float32)}
    for way in ("ahead", "back"):
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden : 2 * hidden] = 1  # cells remember at first
        weights |= {f"{way}_in": some(embedding, 4 * hidden), f"{way}_state": some(hidden, 4 * hidden), f"{way}_bias": bias}
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(weights: Weights, way: str, inputs: np.ndarray, keep: list | None) -> np.ndarray:
    """States (time, batch, hidden) of one direction; with ``keep``, what the way back needs."""
    steps, batch, _ = inputs.shape
    hidden = weights[f"{way}_state"].shape[0]
    moved = inputs @ weights[f"{way}_in"] + weights[f"{way}_bias"]
    state, cell = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
    out = np.zeros((steps, batch, hidden), np.float32)
    for t in range(steps) if way == "ahead" else range(steps - 1, -1, -1):
        z = moved[t] + state @ weights[f"{way}_state"]
        gates = _sigmoid(z[:, : 3 * hidden])
        enter, stay, leave = (gates[:, i * hidden : (i + 1) * hidden] for i in range(3))
        new = np.tanh(z[:, 3 * hidden :])
        before, cell = cell, stay * cell + enter * new
        squashed = np.tanh(cell)
        if keep is not None:
            keep.append((t, state, before, enter, stay, leave, new, squashed))
        state = leave * squashed
        out[t] = state
    return out


def _lstm_back(weights: Weights, way: str, inputs: np.ndarray, kept: list, grad: np.ndarray, grads: Weights) -> np.ndarray:
    hidden = weights[f"{way}_state"].shape[0]
    moved = np.zeros((*inputs.shape[:2], 4 * hidden), np.float32)
    d_state, d_cell = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    d_weights = np.zeros_like(weights[f"{way}_state"])
    for t, state, before, enter, stay, leave, new, squashed in reversed(kept):
        d = grad[t] + d_state
        d_cell = d_cell + d * leave * (1 - squashed * squashed)
        z = moved[t]
        z[:, :hidden] = d_cell * new * enter * (1 - enter)
        z[:, hidden : 2 * hidden] = d_cell * before * stay * (1 - stay)
        z[:, 2 * hidden : 3 * hidden] = d * squashed * leave * (1 - leave)
        z[:, 3 * hidden :] = d_cell * enter * (1 - new * new)
        d_weights += state.T @ z
        d_state = z @ weights[f"{way}_state"].T
        d_cell = d_cell * stay
    flat = moved.reshape(-1, 4 * hidden)
    grads[f"{way}_state"], grads[f"{way}_bias"] = d_weights, flat.sum(axis=0)
    grads[f"{way}_in"] = inputs.reshape(-1, inputs.shape[2]).T @ flat
    return moved @ weights[f"{way}_in"].T


def emissions(weights: Weights, windows: np.ndarray, kept: dict | None = None) -> np.ndarray:
    """Scores (time, batch, tag) of windows (batch, time) of character numbers."""
    inputs = weights["embedding"][windows.T]
    logs = {way: None if kept is None else [] for way in ("ahead", "back")}
    states = np.concatenate([_lstm(weights, way, inputs, logs[way]) for way in ("ahead", "back")], axis=2)
    if kept is not None:
        kept |= {"inputs": inputs, "states": states, "logs": logs}
    return states @ weights["out"] + weights["bias"]


def _summed(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _transitions(weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    first, steps = allowed((len(weights["first"]) - 1) // 2)
    return weights["first"] + first, weights["steps"] + steps


def marginals(weights: Weights, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability (time, batch, tag) of each tag, the expected steps (tag, tag) over all, and log-partitions."""
    first, steps = _transitions(weights)
    ahead, back = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0] + first
    for t in range(1, len(scores)):
        ahead[t] = scores[t] + _summed(ahead[t - 1][:, :, None] + steps, 1)
    for t in range(len(scores) - 2, -1, -1):
        back[t] = _summed((scores[t + 1] + back[t + 1])[:, None, :] + steps, 2)
    total = _summed(ahead[-1], 1)
    chance = np.exp(ahead + back - total[None, :, None])
    crossed = ahead[:-1, :, :, None] + steps + (scores[1:] + back[1:])[:, :, None, :] - total[None, :, None, None]
    return chance, np.exp(crossed).sum(axis=(0, 1)), total


def viterbi(weights: Weights, scores: np.ndarray) -> np.ndarray:
    """The best tags (batch, time) under the transitions."""
    first, steps = _transitions(weights)
    best, came = scores[0] + first, np.zeros(scores.shape, dtype=np.int8)
    for t in range(1, len(scores)):
        ways = best[:, :, None] + steps
        came[t] = ways.argmax(axis=1)
        best = scores[t] + ways.max(axis=1)
    tags = np.zeros((scores.shape[1], len(scores)), dtype=np.int8)
    rows, tag = np.arange(scores.shape[1]), best.argmax(axis=1)
    for t in range(len(scores) - 1, -1, -1):
        tags[:, t] = tag
        tag = came[t][rows, tag]
    return tags


def loss_and_gradients(weights: Weights, windows: np.ndarray, tags: np.ndarray) -> tuple[float, Weights]:
    """Mean negative log-likelihood of ``tags`` (batch, time), and its gradient for every weight."""
    kept: dict = {}
    scores = emissions(weights, windows, kept)
    chance, crossed, total = marginals(weights, scores)
    first, steps = _transitions(weights)
    by_time, n = tags.T.astype(np.int64), len(tags)
    t, b = np.indices(by_time.shape)
    path = scores[t, b, by_time].sum() + first[by_time[0]].sum() + steps[by_time[:-1], by_time[1:]].sum()
    chance[t, b, by_time] -= 1
    d = (chance / n).astype(np.float32)
    seen = np.zeros_like(crossed)
    np.add.at(seen, (by_time[:-1].ravel(), by_time[1:].ravel()), 1)
    grads = {"first": d[0].sum(axis=0), "steps": ((crossed - seen) / n).astype(np.float32)}
    states, hidden = kept["states"], weights["ahead_state"].shape[0]
    grads["out"] = states.reshape(-1, 2 * hidden).T @ d.reshape(-1, d.shape[2])
    grads["bias"] = d.sum(axis=(0, 1))
    d_states = d @ weights["out"].T
    d_inputs = sum(
        _lstm_back(weights, way, kept["inputs"], kept["logs"][way], d_states[:, :, part], grads)
        for way, part in (("ahead", slice(0, hidden)), ("back", slice(hidden, None)))
    )
    grads["embedding"] = np.zeros_like(weights["embedding"])
    np.add.at(grads["embedding"], windows.T.ravel(), d_inputs.reshape(-1, d_inputs.shape[2]))
    return float(total.sum() - path) / n, grads


def train(windows: np.ndarray, tags: np.ndarray, kinds: int, steps: int, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Weights:
    """Weights learnt from labelled windows in ``steps`` steps of Adam, with a falling rate; the same for the same rows."""
    rng = np.random.default_rng(seed)
    weights = fresh_weights(kinds, rng)
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    order = np.zeros(0, dtype=np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(windows)):
            order = rng.permutation(len(windows))
        rows, order = order[:batch], order[batch:]
        _, grads = loss_and_gradients(weights, windows[rows], tags[rows])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale, now = min(1.0, 5.0 / (size + 1e-9)), rate * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * scale * g
            square[k] = 0.999 * square[k] + 0.001 * (scale * g) ** 2
            weights[k] = (weights[k] - now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return weights
