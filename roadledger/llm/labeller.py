"""A bidirectional LSTM in numpy that labels every block of a page as main text or not."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np

from roadledger.llm.pages import Block, Step

PATHS, WORDS, EXTRA, HIDDEN = 96, 48, 5, 16
INPUTS = PATHS + WORDS + EXTRA
WORD = re.compile(r"\w+")
_SLOTS: dict[tuple[str, int], tuple[int, float]] = {}


def _slot(token: str, size: int) -> tuple[int, float]:
    """Place and sign of a token among ``size`` hashed inputs."""
    if (token, size) not in _SLOTS:
        if len(_SLOTS) > 300_000:
            _SLOTS.clear()
        code = crc32(token.encode("utf-8", "surrogatepass"))
        _SLOTS[token, size] = code % size, 1.0 if code >> 20 & 1 else -1.0
    return _SLOTS[token, size]


def _path(step: Step, known: dict[int, np.ndarray]) -> np.ndarray:
    """Hashed labels of a step and those around it, inner ones over outer ones; ``known`` has those of the page so far.

    Besides the steps asked for, every sixteenth on the way is remembered, so no walk goes over the same part twice.
    """
    way, at = [], step
    while at and id(at) not in known:
        way.append(at)
        at = at.above
    row = known[id(at)].copy() if at else np.zeros(PATHS, np.float32)
    for at in reversed(way):
        for token in at.label.split("."):
            place, sign = _slot(token, PATHS)
            row[place] = sign
        if at.depth % 16 == 0 and at is not step:
            known[id(at)] = row.copy()
    known[id(step)] = row
    return row


def vectors(page: list[Block]) -> np.ndarray:
    """One row of inputs per block: hashed tag path, hashed words, and five plain numbers."""
    out = np.zeros((len(page), INPUTS), np.float32)
    paths: dict[int, np.ndarray] = {}
    for row, block in zip(out, page):
        if block.at:
            row[:PATHS] = _path(block.at, paths)
        words = WORD.findall(block.text)
        for word in words:
            place, sign = _slot(word.lower(), WORDS)
            row[PATHS + place] += sign
        row[PATHS:PATHS + WORDS] /= 1 + len(words)
        row[-EXTRA:] = (np.log1p(min(len(words), 150)) / 5, block.links, block.text[-1:] in ".!?", (block.at.depth if block.at else 0) / 8, 1)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(seed: int = 3) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    draw = lambda *shape: (random.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    net = {f"{n}{d}": draw(size, 4 * HIDDEN) for d in "fb" for n, size in (("x", INPUTS), ("h", HIDDEN))}
    net |= {f"c{d}": np.repeat([0, 1, 0, 0], HIDDEN).astype(np.float32) for d in "fb"}  # gates open at first
    return net | {"out": draw(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1, np.float32)}


def _run(net: dict, d: str, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States of one direction over (time, page, inputs), and what going back needs; masked steps keep the state."""
    steps, pages = mask.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    states, saved = np.zeros((steps, pages, HIDDEN), np.float32), []
    inputs = x @ net["x" + d] + net["c" + d]
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        gates = inputs[t] + h @ net["h" + d]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g, m = np.tanh(gates[:, 3 * HIDDEN:]), mask[t][:, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        if keep:
            saved.append((t, h, c, i, f, o, g, squashed, m))
        c = m * new + (1 - m) * c
        h = m * o * squashed + (1 - m) * h
        states[t] = h
    return states, saved


def _back(net: dict, d: str, x: np.ndarray, saved: list, outer: np.ndarray, grads: dict) -> None:
    dh, dc = np.zeros_like(outer[0]), np.zeros_like(outer[0])
    dgates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    for t, h, c, i, f, o, g, squashed, m in reversed(saved):
        dh = dh + outer[t]
        inner = m * (dc + dh * o * (1 - squashed**2))
        now = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), m * dh * squashed * o * (1 - o),
                              inner * i * (1 - g**2)], axis=1)
        dgates[t] = now
        grads["h" + d] += h.T @ now
        dh = now @ net["h" + d].T + (1 - m) * dh
        dc = inner * f + (1 - m) * dc
    grads["x" + d] += np.tensordot(x, dgates, axes=([0, 1], [0, 1]))
    grads["c" + d] += dgates.sum(axis=(0, 1))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), INPUTS), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[:len(page), k], mask[:len(page), k] = page, 1
    return x, mask


def loss_and_grads(net: dict, pages: list[np.ndarray], labels: list[np.ndarray]) -> tuple[float, dict]:
    x, mask = _padded(pages)
    y = np.zeros_like(mask)
    for k, label in enumerate(labels):
        y[:len(label), k] = label
    runs = {d: _run(net, d, x, mask, keep=True) for d in "fb"}
    both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
    p = _sigmoid(both @ net["out"] + net["bias"])
    n = mask.sum()
    loss = -float((mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n)
    grads = {k: np.zeros_like(v) for k, v in net.items()}
    error = (mask * (p - y) / n).astype(np.float32)
    grads["out"] += np.tensordot(both, error, axes=([0, 1], [0, 1]))
    grads["bias"] += error.sum()
    outer = error[:, :, None] * net["out"]
    _back(net, "f", x, runs["f"][1], outer[:, :, :HIDDEN], grads)
    _back(net, "b", x, runs["b"][1], outer[:, :, HIDDEN:], grads)
    return loss, grads


def fit(pages: list[np.ndarray], labels: list[np.ndarray], steps: int = 160, batch: int = 24, rate: float = 0.02,
        seed: int = 5) -> dict[str, np.ndarray]:
    """Adam over random batches of pages."""
    net, random = start(), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    for step in range(1, steps + 1 if pages else 1):
        chosen = random.integers(0, len(pages), batch)
        _, grads = loss_and_grads(net, [pages[k] for k in chosen], [labels[k] for k in chosen])
        pace = rate * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g**2
            net[k] = (net[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


#: Padded block rows labelled at a time, but for one longer page.
STEP_ROWS = 20_000


def label(net: dict, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of main text for every block; pages of like length run together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    while order:
        count = 0
        while count < len(order) and (count == 0 or len(pages[order[count]]) * (count + 1) <= STEP_ROWS):
            count += 1
        group, order = order[:count], order[count:]
        x, mask = _padded([pages[k] for k in group])
        both = np.concatenate([_run(net, d, x, mask)[0] for d in "fb"], axis=2)
        p = _sigmoid(both @ net["out"] + net["bias"])
        for column, k in enumerate(group):
            out[k] = p[:len(pages[k]), column]
    return out

