"""Statistics of whole texts, computed by numpy for a slice of an Arrow column at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Byte classes counted in every text and in every line; ``spaces`` are ASCII white space.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "stops": b".,;:?'\"()-",
           "symbols": b"#$%&*+/<=>@[\\]^_`{}~", "bangs": b"!", "bars": b"|", "spaces": b" \t\n\v\f\r", "wide": bytes(range(128, 256))}
NAMES = ([f"share_{c}" for c in CLASSES] + [f"line_{c}" for c in ("upper", "digits", "symbols", "bangs", "bars")]
         + ["log_bytes", "log_words", "word_bytes", "lines_per_word", "repeated_lines", "repeated_words",
            "next_same", "longest_same", "short_words", "long_words"])
#: Shorter lines give no line maximum.
LINE_BYTES = 20


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[ends] - running[starts]


def _most(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    np.maximum.at(out, owner, values)
    return out


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text; null counts as empty, an empty text has zeros only."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = np.frombuffer(b"".join(texts.cast(pa.large_binary()).to_pylist()), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    some = np.maximum(sizes, 1)

    breaks = np.nonzero(joined == 10)[0]
    cuts = np.unique(np.concatenate([starts[sizes > 0], breaks + 1, ends[sizes > 0]]))
    from_, to = cuts[:-1], cuts[1:]
    owner = np.searchsorted(ends, from_, side="right")
    length = to - from_
    counted = length >= LINE_BYTES

    out, lines = {}, {}
    for name, members in CLASSES.items():
        is_in = np.zeros(256, np.uint8)
        is_in[np.frombuffer(members, np.uint8)] = 1
        marks = is_in[joined]
        out[f"share_{name}"] = _sums(marks, starts, ends) / some
        lines[name] = _sums(marks, from_, to)[counted] / length[counted]
    for name in ("upper", "digits", "symbols", "bangs", "bars"):
        out[f"line_{name}"] = _most(lines[name], owner[counted], n)

    n_lines = np.bincount(owner, minlength=n)
    hashes = np.array([hash(joined[a:b].tobytes()) for a, b in zip(from_.tolist(), to.tolist())], np.int64)
    different = np.unique(np.stack([owner, hashes], axis=1), axis=0)[:, 0] if len(owner) else owner
    out["repeated_lines"] = 1 - np.bincount(different, minlength=n) / np.maximum(n_lines, 1)
    out["repeated_lines"][n_lines == 0] = 0

    lists = pc.utf8_split_whitespace(pc.ascii_lower(texts))
    words, of = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    size = pc.binary_length(words).to_numpy(zero_copy_only=False)
    real = size > 0
    code = words.dictionary_encode().indices.to_numpy()[real]
    of, size = of[real], size[real]
    n_words = np.bincount(of, minlength=n)
    per = np.maximum(n_words, 1)
    kinds = np.unique(of.astype(np.int64) << 32 | code) >> 32
    out["repeated_words"] = np.where(n_words > 0, 1 - np.bincount(kinds, minlength=n) / per, 0)
    same = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    out["next_same"] = np.bincount(of[1:][same], minlength=n) / per
    place = np.arange(len(code))
    first = np.concatenate([[True], ~same]) if len(code) else np.zeros(0, bool)
    run = place - np.maximum.accumulate(np.where(first, place, 0)) if len(code) else place
    out["longest_same"] = _most(run.astype(float), of, n)
    out["short_words"] = np.bincount(of[size <= 2], minlength=n) / per
    out["long_words"] = np.bincount(of[size >= 14], minlength=n) / per
    out["word_bytes"] = np.bincount(of, weights=size, minlength=n) / per
    out["lines_per_word"] = n_lines / per
    out["log_bytes"], out["log_words"] = np.log1p(sizes), np.log1p(n_words)
    return np.stack([out[name] for name in NAMES], axis=1).astype(np.float32)
