"""A gated recurrent language model in numpy, for many texts side by side.

Texts of a group are sorted by length, the longest first, so that those still running
at any step are the first rows of the state. The output is factored: first the word's
class, then the word among its class; words beyond the model's vocabulary are one
class, whose members follow the corpus counts. Training is truncated backpropagation:
gradients stay within a window of steps, the state is carried on from window to
window, and a text is scored from its first token to its end.
"""

from collections.abc import Iterator

import numpy as np

HIDDEN = 16
WINDOW = 16
#: Windows of few texts are longer, to keep the number of tokens up.
LONG_WINDOW = 64
FEW = 256
RATE = 0.08
CLIP = 1.0
#: Of a logit, well within single precision's exponentials.
LARGEST = np.float32(60)


class Model:
    """Weights of the network; ``size`` words, the last being the rare ones.

    ``starts`` cuts the words, most frequent first, into classes of one run each; the
    rare words are the last class.
    """

    NAMES = ("inputs", "state", "gates", "classes", "class_bias", "words", "word_bias")

    def __init__(self, counts: np.ndarray, rare: float, classes: int, seed: int = 1):
        self.size = len(counts) + 1
        mass = np.cumsum(np.sqrt(counts.astype(np.float64)))
        group = (mass / (mass.max(initial=0) or 1) * classes * (1 - 1e-9)).astype(np.int64)
        group = np.concatenate((np.unique(group, return_inverse=True)[1], [group.max(initial=-1) + 1]))
        _, group = np.unique(group, return_inverse=True)
        self.word_class = group.astype(np.int32)
        self.starts = np.searchsorted(group, np.arange(group[-1] + 2))
        random = np.random.default_rng(seed)
        n, h, c = self.size, HIDDEN, len(self.starts) - 1
        every = np.append(counts, rare).astype(np.float64) + 1
        by_class = np.add.reduceat(every, self.starts[:-1])

        def small(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) * 0.1).astype(np.float32)

        # It starts out as the counts' own distribution.
        self.inputs, self.state, self.gates = small(n, 3 * h), small(h, 3 * h), np.zeros(3 * h, np.float32)
        self.classes, self.class_bias = small(h, c), np.log(by_class / by_class.sum()).astype(np.float32)
        self.words, self.word_bias = small(n, h), np.log(every / by_class[group]).astype(np.float32)

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, x).ravel() for x in self.NAMES])

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for x in self.NAMES:
            old = getattr(self, x)
            setattr(self, x, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _windows(lengths: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """First step of each window and the number of texts running at each of its steps."""
    # lengths are in falling order
    at, most = 0, int(lengths[0]) if len(lengths) else 0
    rising = -lengths
    while at < most:
        running = int(np.searchsorted(rising, -at, "left"))
        steps = WINDOW if running > FEW else LONG_WINDOW
        yield at, [int(np.searchsorted(rising, -(at + k), "left")) for k in range(min(steps, most - at))]
        at += steps


def _forward(m: Model, x: np.ndarray, h: np.ndarray) -> tuple:
    a = m.inputs[x] + m.gates
    b = h @ m.state
    n = HIDDEN
    zr = _sigmoid(a[:, : 2 * n] + b[:, : 2 * n])
    z, r = zr[:, :n], zr[:, n:]
    c = np.tanh(a[:, 2 * n :] + r * b[:, 2 * n :])
    return c + z * (h - c), (h, z, r, c, b[:, 2 * n :])


def _outputs(m: Model, h: np.ndarray, y: np.ndarray, grads: dict | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probabilities of the words ``y`` after the states ``h``, and the gradient of
    their sum by the states; the weights' gradients go to ``grads``."""
    rows = np.arange(len(y))
    # States lie between -1 and 1, so only runaway weights could reach the limit.
    logits = h @ m.classes
    logits += m.class_bias
    p = np.exp(np.minimum(logits, LARGEST, out=logits))
    total = p.sum(1)
    group = m.word_class[y]
    out = logits[rows, group] - np.log(total)
    back = None
    if grads is not None:
        p /= -total[:, None]
        p[rows, group] += 1
        back = p @ m.classes.T
        grads["classes"], grads["class_bias"] = h.T @ p, p.sum(0)
        grads["words"], grads["word_bias"] = np.zeros_like(m.words), np.zeros_like(m.word_bias)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(len(m.starts)))
    for g in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        a, b = int(m.starts[g]), int(m.starts[g + 1])
        if b - a == 1:
            continue
        own = order[cuts[g] : cuts[g + 1]]
        hidden, word = h[own], y[own] - a
        inner = hidden @ m.words[a:b].T
        inner += m.word_bias[a:b]
        q = np.exp(np.minimum(inner, LARGEST, out=inner))
        sums = q.sum(1)
        each = np.arange(len(own))
        out[own] += inner[each, word] - np.log(sums)
        if grads is not None:
            q /= -sums[:, None]
            q[each, word] += 1
            back[own] += q @ m.words[a:b]
            grads["words"][a:b], grads["word_bias"][a:b] = q.T @ hidden, q.sum(0)
    return out, back


class Rates:
    """Adaptive steps: every weight's own sum of squared gradients."""

    def __init__(self, m: Model):
        self.sums = {x: np.full(getattr(m, x).shape, 1e-3, np.float32) for x in Model.NAMES}

    def step(self, m: Model, grads: dict[str, np.ndarray], rows: np.ndarray) -> None:
        for name, g in grads.items():
            g = np.clip(g, -CLIP, CLIP)
            weights, sums = getattr(m, name), self.sums[name]
            if name == "inputs":
                sums[rows] += g * g
                weights[rows] += np.float32(RATE) * g / np.sqrt(sums[rows])
            else:
                sums += g * g
                weights += np.float32(RATE) * g / np.sqrt(sums)


def _by_word(words: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    first = np.flatnonzero(np.append(True, sorted_words[1:] != sorted_words[:-1]))
    return sorted_words[first], np.add.reduceat(grad[order], first)


def run(m: Model, tokens: np.ndarray, offsets: np.ndarray, rates: Rates | None = None) -> np.ndarray:
    """Natural log probability of every text; with ``rates`` the model learns them too.

    ``tokens`` holds the texts' words one text after the other, ends included.
    """
    order = np.argsort(-np.diff(offsets), kind="stable")
    first, lengths = offsets[:-1][order], np.diff(offsets)[order]
    scores = np.zeros(len(order))
    h = np.zeros((len(order), HIDDEN), np.float32)
    n = HIDDEN
    # Before the first word stands an end, as after the last.
    for at, running in _windows(lengths):
        kept, targets, inputs, states = [], [], [], []
        for k, live in enumerate(running):
            place = first[:live] + at + k
            x = tokens[place - 1] if at + k else np.full(live, tokens[offsets[1] - 1])
            h = h[:live]
            h, parts = _forward(m, x, h)
            inputs.append(x)
            states.append(h)
            targets.append(tokens[place])
            if rates is not None:
                kept.append(parts)
        every, wanted = np.concatenate(states), np.concatenate(targets)
        grads: dict | None = {} if rates is not None else None
        logs, back = _outputs(m, every, wanted, grads)
        cuts = np.cumsum([0, *running])
        for k, live in enumerate(running):
            scores[:live] += logs[cuts[k] : cuts[k + 1]]
        if rates is None:
            continue
        scale = np.float32(1 / np.sqrt(len(wanted)))
        da_all = np.empty((len(wanted), 3 * n), np.float32)
        grads["state"] = np.zeros_like(m.state)
        carry = np.zeros((0, n), np.float32)
        for k in range(len(running) - 1, -1, -1):
            live = running[k]
            dh = back[cuts[k] : cuts[k + 1]]
            dh[: len(carry)] += carry
            before, z, r, c, u = kept[k]
            dc = dh * (1 - z)
            dn = dc * (1 - c * c)
            da = da_all[cuts[k] : cuts[k + 1]]
            da[:, :n] = dh * (before - c) * z * (1 - z)
            da[:, n : 2 * n] = dn * u * r * (1 - r)
            da[:, 2 * n :] = dn * r
            grads["state"] += before.T @ da
            carry = dh * z + da @ m.state.T
            da[:, 2 * n :] = dn
        grads["gates"] = da_all.sum(0)
        rows, grads["inputs"] = _by_word(np.concatenate(inputs), da_all)
        for x in grads:
            grads[x] = grads[x] * scale
        rates.step(m, grads, rows)
    out = np.empty(len(order))
    out[order] = scores
    return out
