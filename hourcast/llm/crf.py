"""A character tagger in numpy: bidirectional LSTM with CRF transitions.

Windows are rows of character codes of one length. Training maximises the likelihood of
whole tag sequences (forward-backward over the CRF, back-propagation through both
LSTMs) with Adam; decoding is Viterbi over a batch.
"""

from __future__ import annotations

import numpy as np

#: ASCII 32..126 are codes 1..95; padding is 0.
CODES = 100


def codes(text: str, length: int) -> np.ndarray:
    """Codes of a window, padded; letters beyond ASCII are 96 (upper), 97 (lower), others 98, 99."""
    out = np.zeros(length, dtype=np.int64)
    for k, c in enumerate(text):
        n = ord(c)
        if 32 <= n < 127:
            out[k] = n - 31
        elif c.isalpha():
            out[k] = 96 if c.isupper() else 97
        else:
            out[k] = 98 if c.isspace() else 99
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


def initial(tags: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
    weights = {}
    for side in "fb":
        weights[f"{side}_in"] = draw(CODES, 4 * hidden)
        weights[f"{side}_rec"] = draw(hidden, 4 * hidden)
        weights[f"{side}_in"][:, hidden : 2 * hidden] += 1  # forget gates start open
    weights |= {"out": draw(2 * hidden, tags), "bias": np.zeros(tags, np.float32)}
    return weights | {"move": np.zeros((tags, tags), np.float32)}


def _lstm(x: np.ndarray, w_in: np.ndarray, w_rec: np.ndarray) -> tuple[np.ndarray, list]:
    """States of (time, windows) codes and what the backward pass needs."""
    steps, n = x.shape
    hidden = w_rec.shape[0]
    h = c = np.zeros((n, hidden), np.float32)
    states, kept = np.empty((steps, n, hidden), np.float32), []
    for t in range(steps):
        z = w_in[x[t]] + h @ w_rec
        gates = _sigmoid(z[:, : 3 * hidden])
        i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
        g = np.tanh(z[:, 3 * hidden :])
        last, c = c, f * c + i * g
        squashed = np.tanh(c)
        kept.append((i, f, o, g, last, squashed, h))
        h = states[t] = o * squashed
    return states, kept


def _lstm_back(
    x: np.ndarray, w_rec: np.ndarray, kept: list, grad: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    steps, n, hidden = grad.shape
    all_dz = np.empty((steps, n, 4 * hidden), np.float32)
    d_rec = np.zeros_like(w_rec)
    dh = dc = np.zeros((n, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, last, squashed, before = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz = np.concatenate(
            (dc * g * i * (1 - i), dc * last * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)),
            axis=1,
        )
        all_dz[t] = dz
        d_rec += before.T @ dz
        dh, dc = dz @ w_rec.T, dc * f
    one_hot = np.zeros((steps * n, CODES), np.float32)
    one_hot[np.arange(steps * n), x.ravel()] = 1
    return one_hot.T @ all_dz.reshape(steps * n, -1), d_rec


def emissions(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """(time, windows, tags) scores of (windows, time) codes."""
    forward = np.ascontiguousarray(x.T)
    there, kept_f = _lstm(forward, w["f_in"], w["f_rec"])
    back, kept_b = _lstm(forward[::-1], w["b_in"], w["b_rec"])
    states = np.concatenate((there, back[::-1]), axis=2)
    return states @ w["out"] + w["bias"], (forward, states, kept_f, kept_b)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def loss_and_gradient(
    w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray
) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of tag sequences y and its gradient."""
    e, (forward, states, kept_f, kept_b) = emissions(w, x)
    steps, n, tags = e.shape
    move, gold = w["move"], y.T
    ahead, behind = np.empty_like(e), np.zeros_like(e)
    ahead[0] = e[0]
    for t in range(1, steps):
        ahead[t] = e[t] + _log_sum(ahead[t - 1][:, :, None] + move, 1)
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(move + (e[t + 1] + behind[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    rows = np.arange(n)
    picked = np.take_along_axis(e, gold[:, :, None], 2).sum(0)[:, 0]
    loss = float((total - picked - move[gold[:-1], gold[1:]].sum(0)).mean())

    d_e = np.exp(ahead + behind - total[:, None])
    d_move = np.zeros_like(move)
    for t in range(steps - 1):
        pair = ahead[t][:, :, None] + move + (e[t + 1] + behind[t + 1])[:, None, :]
        d_move += np.exp(pair - total[:, None, None]).sum(0)
        np.add.at(d_move, (gold[t], gold[t + 1]), -1)
    for t in range(steps):
        d_e[t, rows, gold[t]] -= 1
    d_e /= n
    flat = d_e.reshape(-1, tags)
    d_states = d_e @ w["out"].T
    hidden = w["f_rec"].shape[0]
    f_in, f_rec = _lstm_back(forward, w["f_rec"], kept_f, d_states[:, :, :hidden])
    b_in, b_rec = _lstm_back(forward[::-1], w["b_rec"], kept_b, d_states[::-1, :, hidden:])
    return loss, {
        "f_in": f_in, "f_rec": f_rec, "b_in": b_in, "b_rec": b_rec,
        "out": states.reshape(len(flat), -1).T @ flat, "bias": flat.sum(0), "move": d_move / n,
    }


def train(
    x: np.ndarray,
    y: np.ndarray,
    tags: int,
    hidden: int = 16,
    epochs: int = 6,
    batch: int = 64,
    rate: float = 0.02,
    seed: int = 7,
) -> dict[str, np.ndarray]:
    """Weights after so many epochs of Adam over windows x with tags y."""
    w, rng = initial(tags, hidden, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step, steps = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            chosen = order[at : at + batch]
            _, grads = loss_and_gradient(w, x[chosen], y[chosen])
            pace = rate * (1 - step / steps)
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                w[k] = (w[k] - pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return w


def decode(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The most likely tags of each window."""
    e, _ = emissions(w, x)
    steps, n, _ = e.shape
    best, came = e[0], np.empty(e.shape, np.int8)
    for t in range(1, steps):
        reach = best[:, :, None] + w["move"]
        came[t] = reach.argmax(1)
        best = e[t] + reach.max(1)
    out = np.empty((n, steps), np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = came[t][np.arange(n), out[:, t]]
    return out
