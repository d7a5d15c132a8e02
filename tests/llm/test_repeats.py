"""Column-wise transforms and repeat removal against brute force."""

import hashlib
import random
import tempfile
from collections import Counter

import numpy as np
import pytest

from cases import awkward_rows, table
from roadledger.llm.collection_bwt import build, repeated_windows
from roadledger.llm.repeats import SHAPE, anchor_runs, remove_repeats


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_transform_and_common_prefixes(tmp_path, block):
    pick = random.Random(1)
    for case in range(40):
        letters = bytes(pick.sample(range(240), pick.randint(1, 5)))
        strings = [bytes(pick.choice(letters) for _ in range(pick.randint(0, 25))) for _ in range(pick.randint(1, 12))]
        strings += [strings[0][3:] + strings[-1]] * (case % 2)
        (tmp_path / str(case)).mkdir()
        files, place = build(strings, str(tmp_path / str(case)), block)
        suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        assert files.whole("lcp").tolist() == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
        before = Counter((text, strings[k][i - 1] + 1 if i else 0) for text, k, i in suffixes)
        assert Counter(zip((s[0] for s in suffixes), files.whole("bwt").tolist())) == before
        for size in (1, 3, 6):
            windows = np.array([max(0, len(s) - size + 1) for s in strings])
            counts = Counter(s[i:i + size] for s in strings for i in range(len(s) - size + 1))
            for s, flags in zip(strings, repeated_windows(strings, windows, size, block)):
                assert flags.tolist() == [counts[s[i:i + size]] > 1 for i in range(len(s) - size + 1)]


def test_small_collections_write_no_files_and_large_ones_give_the_same(monkeypatch):
    pick = random.Random(2)
    strings = [bytes(pick.choice(b"ab") for _ in range(30)) for _ in range(20)]
    windows = np.array([26] * 20)
    on_disk = repeated_windows(strings, windows, 5, held=0)
    monkeypatch.setattr(tempfile, "TemporaryDirectory", None)  # cannot be called
    assert [f.tolist() for f in repeated_windows(strings, windows, 5)] == [f.tolist() for f in on_disk]
    with pytest.raises(TypeError):
        repeated_windows(strings, windows, 5, held=0)


def test_anchor_runs_cover_every_window_once():
    pick = random.Random(3)
    for _ in range(100):
        window = pick.randint(6, 30)
        anchor = pick.randint(2, window - 1)
        letters = pick.choice([b"ab", b"abcdefgh", b"a"])
        text = np.frombuffer(bytes(pick.choice(letters) for _ in range(pick.randint(0, 200))), np.uint8)
        keys, first, shape = anchor_runs(text, window, anchor)
        n, place = shape // SHAPE, shape % SHAPE
        assert n.sum() == max(0, len(text) - window + 1) and (np.cumsum(n) - n == first).all()
        seen = {}
        for key, f, c, p in zip(keys.tolist(), first.tolist(), n.tolist(), place.tolist()):
            assert p + anchor <= window
            for s in range(f, f + c):  # equal windows have equal anchors at equal places
                assert seen.setdefault(text[s:s + window].tobytes(), (key, f + p - s)) == (key, f + p - s)


def by_hand(rows, size):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    counts = Counter(t[i:i + size] for _, t in raw for i in range(len(t) - size + 1))
    out = []
    for ident, text in raw:
        spans = []
        for i in range(len(text) - size + 1):
            if counts[text[i:i + size]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + size
                else:
                    spans.append([i, i + size])
        kept = b"".join(text[a:b] for a, b in zip([0] + [s[1] for s in spans], [s[0] for s in spans] + [len(text)]))
        out.append((ident, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(table(spark, rows), **options).collect()),
                  key=repr)


def passages(seed=6):
    """Texts that share passages of many lengths, whole and cut, some with periods."""
    pick = random.Random(seed)
    draw = lambda n, letters="abcdé \n": "".join(pick.choice(letters) for _ in range(n))
    shared = [draw(n) for n in (15, 20, 21, 30, 60, 90)] + ["xyz" * 12, "q" * 45]
    rows = []
    for i in range(120):
        text = draw(pick.randint(0, 50), "abcdefgh")
        for _ in range(pick.randint(0, 3)):
            piece = pick.choice(shared)
            a = pick.randint(0, len(piece) // 3) if pick.random() < 0.5 else 0
            text += piece[a:len(piece) - pick.randint(0, 4)] + draw(pick.randint(0, 30), "abcdefgh")
        rows.append((i, text) + (None,) * 6)
    return rows + rows[:5] + awkward_rows()


@pytest.mark.parametrize("options", [{"crowd": 1000, "collection": 50}, {"crowd": 3, "collection": 7}])
def test_repeats(spark, options):
    rows = passages()
    assert found(spark, rows, window=20, anchor=6, **options) == by_hand(rows, 20)


def test_repeats_at_the_production_size(spark):
    rows = awkward_rows()
    assert found(spark, rows) == by_hand(rows, 200)
    assert found(spark, []) == []
