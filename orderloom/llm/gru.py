"""A gated recurrent language model in numpy, with a class-factored softmax.

A token is a symbol: one of the head words, or a band of rarer words. Its class is
predicted from the state, and a head word again within its class, so that a token costs the
classes plus one class instead of the vocabulary. Which word of a band was meant is
not the model's business.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Rows of states whose outputs are computed at a time.
OUTPUT_ROWS = 1 << 14


@dataclass(frozen=True)
class Shape:
    """``heads`` classes of ``width`` words (the last may have fewer: ``head_words`` in
    all), then ``bands`` symbols that are classes of their own."""

    head_words: int
    bands: int
    width: int = 32
    hidden: int = 16
    embedded: int = 16

    @property
    def heads(self) -> int:
        return -(-self.head_words // self.width)

    @property
    def classes(self) -> int:
        return self.heads + self.bands

    @property
    def symbols(self) -> int:
        return self.head_words + self.bands

    @property
    def start(self) -> int:
        """What stands before the first token."""
        return self.symbols

    def parts(self) -> dict[str, tuple[int, ...]]:
        h, e = self.hidden, self.embedded
        return {
            "embed": (self.symbols + 1, e),
            "inward": (e, 3 * h),
            "onward": (h, 3 * h),
            "gate_bias": (3 * h,),
            "to_class": (h, self.classes),
            "class_bias": (self.classes,),
            "to_word": (self.heads, h, self.width),
            "word_bias": (self.heads, self.width),
        }

    @property
    def size(self) -> int:
        return sum(int(np.prod(shape)) for shape in self.parts().values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parameters as arrays that share memory with ``flat``."""
        views, at = {}, 0
        for name, shape in self.parts().items():
            n = int(np.prod(shape))
            views[name] = flat[at : at + n].reshape(shape)
            at += n
        return views

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.head_words, symbols // self.width, self.heads + symbols - self.head_words)


def initial(shape: Shape, counts: np.ndarray, seed: int = 7) -> np.ndarray:
    """Parameters of a model that knows how frequent symbols are, and no order yet."""
    rng, flat = np.random.default_rng(seed), np.zeros(shape.size, np.float32)
    views = shape.views(flat)
    for name, spread in (("embed", 0.3), ("inward", 0.3), ("onward", 0.3), ("to_class", 0.05), ("to_word", 0.05)):
        views[name][...] = rng.normal(0, spread, views[name].shape)
    weight = np.asarray(counts, float) + 1
    mass = np.bincount(shape.class_of(np.arange(shape.symbols)), weights=weight, minlength=shape.classes)
    views["class_bias"][...] = np.log(mass / mass.sum())
    words = np.full(shape.heads * shape.width, -30.0)
    words[: shape.head_words] = np.log(weight[: shape.head_words])
    views["word_bias"][...] = words.reshape(shape.heads, shape.width) - np.log(mass[: shape.heads, None])
    return flat


def by_number(values: np.ndarray, most: int) -> np.ndarray:
    """The order of whole numbers below ``most``, equal ones as they came. Numbers of two
    bytes are sorted by their digits, several times faster than by comparing."""
    return np.argsort(values.astype(np.uint16) if most <= 1 << 16 else values, kind="stable")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _softmax(logits: np.ndarray, at: np.ndarray, odds_too: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The log-probability of column ``at[i]`` in row i, and all probabilities if wanted."""
    rows, ones = np.arange(len(at)), np.ones(logits.shape[1], np.float32)
    # Logits seldom leave the range of single precision, so rows are shifted only where they do.
    with np.errstate(over="ignore"):
        odds = np.exp(logits)
    total = odds @ ones
    if not (1e-30 < total.min(initial=1) and total.max(initial=1) < 1e30):
        logits = logits - logits.max(1, keepdims=True)
        odds = np.exp(logits)
        total = odds @ ones
    found = logits[rows, at] - np.log(total)
    if not odds_too:
        return found, None
    odds /= total[:, None]
    return found, odds


class Model:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat, self.views = shape, flat, shape.views(flat)

    def outputs(self, states: np.ndarray, targets: np.ndarray, grad: dict[str, np.ndarray] | None = None):
        """Log-probability of each target after its state. With ``grad`` (which is added
        to) also the slope of the loss, its negative sum, by the states."""
        v, shape, every = self.views, self.shape, np.arange(len(targets))
        kind = shape.class_of(targets)
        found, odds = _softmax(states @ v["to_class"] + v["class_bias"], kind, grad is not None)
        found = found.astype(float)
        slope = None
        if grad is not None:
            odds[every, kind] -= 1
            grad["to_class"] += states.T @ odds
            grad["class_bias"] += odds.sum(0)
            slope = odds @ v["to_class"].T
        order = by_number(kind, shape.classes)
        ends = np.searchsorted(kind[order], np.arange(shape.heads + 1))
        for c in range(shape.heads):
            at = order[ends[c] : ends[c + 1]]
            if not len(at):
                continue
            some, word, row = states[at], targets[at] - c * shape.width, np.arange(len(at))
            logs, odds = _softmax(some @ v["to_word"][c] + v["word_bias"][c], word, grad is not None)
            found[at] += logs
            if grad is not None:
                odds[row, word] -= 1
                grad["to_word"][c] += some.T @ odds
                grad["word_bias"][c] += odds.sum(0)
                slope[at] += odds @ v["to_word"][c].T
        return found, slope

    def score(self, docs: list[np.ndarray], window: int = 64) -> np.ndarray:
        """Natural log-probability of each document's symbols. The documents run side
        by side, window after window, and take their states along."""
        shape, hidden = self.shape, self.shape.hidden
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        order = np.argsort(-lengths, kind="stable")
        lengths, total = lengths[order], np.zeros(len(docs))
        flat = np.concatenate([np.empty(0, np.int32), *(docs[i] for i in order)]).astype(np.int32)
        first = np.cumsum(lengths) - lengths
        table = self.views["embed"] @ self.views["inward"] + self.views["gate_bias"]
        onward, states = self.views["onward"], np.zeros((len(docs), hidden), np.float32)
        falling = -lengths
        for begin in range(0, int(lengths.max(initial=0)), window):
            steps, places = [], []
            for t in range(begin, begin + window):
                n = int(np.searchsorted(falling, -t))  # documents longer than t
                if not n:
                    break
                before = flat[first[:n] + t - 1] if t else np.full(n, shape.start)
                gates, h = table[before], states[:n]
                back = h @ onward
                zr = _sigmoid(gates[:, : 2 * hidden] + back[:, : 2 * hidden])
                back[:, 2 * hidden :] *= zr[:, hidden:]
                new = np.tanh(gates[:, 2 * hidden :] + back[:, 2 * hidden :])
                new += zr[:, :hidden] * (h - new)
                states[:n] = new
                steps.append(new)
                places.append(first[:n] + t)
            rows, place = np.concatenate(steps), np.concatenate(places)
            doc = np.concatenate([np.arange(len(s)) for s in steps])
            for at in range(0, len(rows), OUTPUT_ROWS):
                part = slice(at, at + OUTPUT_ROWS)
                found, _ = self.outputs(rows[part], flat[place[part]])
                total += np.bincount(doc[part], weights=found, minlength=len(docs))
        result = np.empty(len(docs))
        result[order] = total
        return result

    def slopes(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """One window of truncated backpropagation: loss, slopes, and the state after it.

        All arrays are (steps, streams); ``fresh`` marks the first token of a document,
        before which the state is empty. ``state`` comes from the window before, through
        which nothing is propagated back.
        """
        v, hidden = self.views, self.shape.hidden
        steps, streams = inputs.shape
        flat_grad = np.zeros(self.shape.size, np.float32)
        grad = self.shape.views(flat_grad)
        embedded = v["embed"][inputs.reshape(-1)]
        gates = (embedded @ v["inward"] + v["gate_bias"]).reshape(steps, streams, 3 * hidden)
        keep = np.float32(1) - fresh[:, :, None].astype(np.float32)
        before = np.empty((steps, streams, hidden), np.float32)
        after, zr = np.empty_like(before), np.empty((steps, streams, 2 * hidden), np.float32)
        new, back = np.empty_like(before), np.empty((steps, streams, 3 * hidden), np.float32)
        for t in range(steps):
            h = np.multiply(state, keep[t], out=before[t])
            np.matmul(h, v["onward"], out=back[t])
            zr[t] = _sigmoid(gates[t, :, : 2 * hidden] + back[t, :, : 2 * hidden])
            np.tanh(gates[t, :, 2 * hidden :] + zr[t, :, hidden:] * back[t, :, 2 * hidden :], out=new[t])
            state = np.add(new[t], zr[t, :, :hidden] * (h - new[t]), out=after[t])
        found, slope = self.outputs(after.reshape(-1, hidden), targets.reshape(-1), grad)
        slope = slope.reshape(steps, streams, hidden)

        z, r = zr[:, :, :hidden], zr[:, :, hidden:]
        by_new = (1 - z) * (1 - new * new)
        by_z = (before - new) * z * (1 - z)
        by_r = back[:, :, 2 * hidden :] * r * (1 - r)
        into, through, carry = np.empty_like(back), np.empty_like(back), np.zeros((streams, hidden), np.float32)
        for t in range(steps - 1, -1, -1):
            carry += slope[t]
            pull = np.multiply(carry, by_new[t], out=into[t, :, 2 * hidden :])
            np.multiply(carry, by_z[t], out=into[t, :, :hidden])
            np.multiply(pull, by_r[t], out=into[t, :, hidden : 2 * hidden])
            through[t, :, : 2 * hidden] = into[t, :, : 2 * hidden]
            np.multiply(pull, r[t], out=through[t, :, 2 * hidden :])
            carry = (carry * z[t] + through[t] @ v["onward"].T) * keep[t]
        into, through = into.reshape(-1, 3 * hidden), through.reshape(-1, 3 * hidden)
        grad["onward"] += before.reshape(-1, hidden).T @ through
        grad["inward"] += embedded.T @ into
        grad["gate_bias"] += into.sum(0)
        by_input = into @ v["inward"].T
        order = by_number(inputs.reshape(-1), self.shape.symbols + 1)
        ids = inputs.reshape(-1)[order]
        heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        grad["embed"][ids[heads]] += np.add.reduceat(by_input[order], heads)
        return -found.sum(), flat_grad, state.copy()


def windows(
    docs: list[np.ndarray], shape: Shape, steps: int, streams: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The documents end to end, cut into streams of one length: inputs, targets and
    starts of documents, window after window. A few tokens at the end of the streams,
    fewer than there are streams, repeat the beginning."""
    targets = np.concatenate(docs).astype(np.int32)
    fresh = np.zeros(len(targets), bool)
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    fresh[np.cumsum(lengths) - lengths] = True
    inputs = np.concatenate([targets[:1], targets[:-1]])
    inputs[fresh] = shape.start
    long = -(-len(targets) // streams)
    place = np.resize(np.arange(len(targets)), long * streams).reshape(streams, long).T
    for at in range(0, long, steps):
        some = place[at : at + steps]
        yield inputs[some], targets[some], fresh[some]


class Adam:
    def __init__(self, size: int, rate: float, clip: float = 1.0):
        self.rate, self.clip, self.step = rate, clip, 0
        self.mean, self.square = np.zeros(size, np.float32), np.zeros(size, np.float32)

    def update(self, flat: np.ndarray, slope: np.ndarray) -> None:
        norm = float(np.sqrt(np.dot(slope, slope)))
        if norm > self.clip:
            slope *= self.clip / norm
        self.step += 1
        self.mean += 0.1 * (slope - self.mean)
        slope *= slope
        slope -= self.square
        slope *= 0.01
        self.square += slope
        rate = self.rate * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        flat -= np.float32(rate) * self.mean / (np.sqrt(self.square) + np.float32(1e-6))


def train(model: Model, docs: list[np.ndarray], rate: float, steps: int = 16, most_streams: int = 256) -> float:
    """One pass over the documents, changing the model; the loss per token. More tokens
    run in more streams side by side."""
    tokens = sum(map(len, docs))
    streams = int(np.clip(tokens // (steps * 200), 8, most_streams))
    rule, state, loss = Adam(model.shape.size, rate), None, 0.0
    for inputs, targets, fresh in windows(docs, model.shape, steps, streams):
        if state is None:
            state = np.zeros((streams, model.shape.hidden), np.float32)
        here, slope, state = model.slopes(inputs, targets, fresh, state)
        slope /= targets.size
        rule.update(model.flat, slope)
        loss += here
    return loss / max(1, tokens)
