"""Suffix-array dedup: remove every byte covered by a 200-byte string that also starts anywhere else.

The transform of a whole corpus needs as many rounds as its longest document has bytes, each rewriting all of it. Here
it is built, column by column, for bounded collections that together see every pair of equal windows:

* Documents equal as a whole are one document (all of whose windows are repeated) from the start.
* Of each 200-byte window the least hash of its 64-byte strings is the anchor, the leftmost if several are least. Equal
  windows have equal anchors at equal places, and neighbouring windows share theirs: the windows of one anchor
  occurrence are one string, its context. Anchors that occur once are done.
* Contexts that occur twice are repeated as a whole. The rest, with one of each repeated context, meet the contexts of
  the same anchor in a task. Each is cut to what it has in common, to the left and to the right of the anchor, with any
  other; a window that reaches beyond is in no other. Strings that are then equal are repeated as a whole. Where
  several strings of an anchor are left, they join a collection, whose Burrows-Wheeler transform and common prefixes
  are built by inserting one symbol of every string each round, in sequential files of the task's scratch folder; a
  window whose neighbour in suffix order shares 200 bytes is repeated. A task holds about ``COLLECTION`` contexts.
* Anchors with more than ``CROWD`` different contexts, which no one task should hold, are resolved window by window,
  by digests counted before they are shuffled. That way is exact as well.

Defined results: null text is empty; a text shorter than the window loses nothing; windows are judged on the input,
overlapping ones and those of the same document included; repeated rows count as documents; a null id stays null; an
empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadledger.llm.collection_bwt import repeated_windows
from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, dropped, narrow_join, settings, text_of
from roadledger.llm.shingles import mixed, slices
from roadledger.session import written

WINDOW, ANCHOR = 200, 64
#: Strings of a collection, and contexts of one anchor from which it is resolved by windows.
COLLECTION, CROWD = 4000, 1000
#: Rows with whole texts that are sent to Python at a time.
BATCH_ROWS = 1000
#: A run's windows and the place of its anchor are kept as one number: windows * SHAPE + place.
SHAPE = 256
#: Window starts worked on at a time.
STARTS = 1 << 21
_FACTOR = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, factor in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 1 << 64))):
            steps = np.full(n, factor, np.uint64)
            steps[:1] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def anchor_runs(text: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows and the anchor's place in the first as one number) of the runs of windows
    that share an anchor occurrence."""
    count = len(text) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _powers(len(text))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up)])
    hashes = mixed((running[anchor:] - running[:-anchor]) * down[:len(text) - anchor + 1])
    # 40 bits of the hash, then the place: the least is the leftmost least.
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, width = window - anchor + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:count], least[span - width:span - width + count])
    place = (least[:count] & low).astype(np.int64)
    first = np.nonzero(np.concatenate([[True], place[1:] != place[:-1]]))[0]
    return hashes[place[first]].view(np.int64), first, np.diff(np.append(first, count)) * SHAPE + place[first] - first


def _anchored(window: int, anchor: int):
    """(address, anchor, first window, windows) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            for text, file, row in zip(part.column("text"), part.column(FILE).to_pylist(), part.column(ROW).to_pylist()):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                yield from _text_runs(raw, file, row)

    def _text_runs(raw: np.ndarray, file: int, row: int) -> Iterator[tuple]:
        for start in range(0, max(1, len(raw) - window + 1), STARTS):
            key, first, n = anchor_runs(raw[start:start + STARTS + window - 1], window, anchor)
            yield file, row, key, first + start, n

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in run(batches):
            held.append(found)
            size += len(found[2])
            if size >= 100_000:
                yield _run_rows(held)
                held, size = [], 0
        if held:
            yield _run_rows(held)

    return batched


def _run_rows(held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(h[2]) for h in held]
    columns = [np.repeat(np.array([h[k] for h in held], np.int64), sizes) for k in (0, 1)]
    columns += [np.concatenate([h[k] for h in held]) for k in (2, 3, 4)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[FILE, ROW, "anchor", "start", "shape"])


_RUNS = f"{FILE} bigint, {ROW} bigint, anchor bigint, start bigint, shape bigint"


def _contexts(window: int, with_bytes: bool):
    """One row per run of a text (its list ``runs``) with a digest of the bytes it covers, or with the bytes."""
    name, kind = ("context", pa.binary()) if with_bytes else ("same", pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            for text, file, row, runs in zip(part.column("text"), part.column(FILE).to_pylist(), part.column(ROW).to_pylist(),
                                             part.column("runs")):
                fields = runs.values
                start, shape, anchor = (fields.field(c).to_numpy() for c in ("start", "shape", "anchor"))
                raw = text.as_py()
                for low in range(0, len(start), 20_000):  # rows with bytes are sent on in parts
                    s, n, a = start[low:low + 20_000], shape[low:low + 20_000], anchor[low:low + 20_000]
                    pieces = [raw[i:i + k + window - 1] for i, k in zip(s.tolist(), (n // SHAPE).tolist())]
                    if not with_bytes:
                        pieces = [blake2b(p, digest_size=16).digest() for p in pieces]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), file)), pa.array(np.full(len(s), row)), pa.array(a), pa.array(s), pa.array(n),
                         pa.array(pieces, kind)], names=[FILE, ROW, "anchor", "start", "shape", name])

    return run


_SPANS = f"{FILE} bigint, {ROW} bigint, low bigint, high bigint"


def _runs_of(flags: np.ndarray, start: int, window: int) -> list[tuple[int, int]]:
    """Byte spans covered by the flagged windows from ``start`` on."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(start + a, start + b - 1 + window) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _shared(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _most_shared(parts: list[bytes]) -> list[int]:
    """For each string the longest prefix that it has in common with any other of them."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    steps = [0, *(_shared(parts[a], parts[b]) for a, b in zip(order, order[1:])), 0]
    out = [0] * len(parts)
    for place, k in enumerate(order):
        out[k] = max(steps[place], steps[place + 1])
    return out


def _trimmed(contexts: list[bytes], places: list[int], anchor: int) -> list[tuple[int, bytes]]:
    """(bytes cut off in front, rest) of the contexts of one anchor, cut to what others have around the anchor too."""
    left = _most_shared([c[:p][::-1] for c, p in zip(contexts, places)])
    right = _most_shared([c[p + anchor:] for c, p in zip(contexts, places)])
    return [(p - a, c[p - a:p + anchor + b]) for c, p, a, b in zip(contexts, places, left, right)]


def _collected(window: int, anchor: int):
    """Repeated spans of the contexts of one task that occur once; all contexts of an anchor are there."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("anchor")
        files, rows, starts, shapes, once, contexts, anchors = (
            table.column(c).to_pylist() for c in (FILE, ROW, "start", "shape", "once", "context", "anchor"))
        out: list[tuple[int, int, int, int]] = []
        collection: list[bytes] = []
        owners: list[tuple[int, int] | None] = []  # of the strings that are in question: row of the table, bytes cut off
        first = 0
        for last in range(1, len(anchors) + 1):
            if last < len(anchors) and anchors[last] == anchors[first]:
                continue
            strings: dict[bytes, list[tuple[int, int]]] = {}
            found = _trimmed(contexts[first:last], [s % SHAPE for s in shapes[first:last]], anchor)
            for k, (cut, text) in zip(range(first, last), found):
                if len(text) >= window:
                    strings.setdefault(text, []).append((k, cut))
            for text, members in strings.items():
                repeated = len(members) > 1 or not once[members[0][0]]
                if repeated:
                    out += [(files[k], rows[k], starts[k] + cut, starts[k] + cut + len(text)) for k, cut in members if once[k]]
                if len(strings) > 1:
                    collection.append(text)
                    owners.append(None if repeated else members[0])
            first = last
        if any(owners):
            windows = np.array([len(text) - window + 1 for text in collection])
            for owner, flag in zip(owners, repeated_windows(collection, windows, window)):
                if owner and flag.any():
                    k, cut = owner
                    out += [(files[k], rows[k], *span) for span in _runs_of(flag, starts[k] + cut, window)]
        columns = np.array(out, np.int64).reshape(-1, 4)
        return pa.Table.from_arrays([pa.array(np.ascontiguousarray(columns[:, k])) for k in range(4)], names=[FILE, ROW, "low", "high"])

    return run


def _windows(window: int):
    """A digest of every window of the contexts, with its place; equal windows of a batch are combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "context", 1 << 18):
            rows: list[tuple] = []
            for file, row, start, once, text in zip(*(part.column(c).to_pylist() for c in (FILE, ROW, "start", "once", "context"))):
                rows += [(file, row, start + k, 1 if once else 2, blake2b(text[k:k + window], digest_size=16).digest())
                         for k in range(len(text) - window + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                list(zip(*rows)) or [[]] * 5, [pa.int64()] * 4 + [pa.binary()])], names=[FILE, ROW, "low", "times", "same"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for part in slices(batches, "text"):
        rows = []
        for text, file, row, spans in zip(part.column("text"), part.column(FILE).to_pylist(), part.column(ROW).to_pylist(),
                                          part.column("spans")):
            raw, fields = text.as_py(), spans.values
            order = np.argsort(fields.field("low").to_numpy(), kind="stable")
            low, high = fields.field("low").to_numpy()[order], np.maximum.accumulate(fields.field("high").to_numpy()[order])
            first = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
            low, high = low[first], high[np.append(first[1:], len(high)) - 1]
            kept = b"".join(raw[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(raw)]))
            rows.append((file, row, int((high - low).sum()), len(low), sha256(kept).hexdigest(), kept))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, kinds)],
                                         names=[FILE, ROW, "removed", "n_spans", "kept_sha256", "kept"])


def _with_lists(texts: DataFrame, rows: DataFrame, item: list[str], name: str) -> DataFrame:
    """Texts of the documents in ``rows``, each with the list of its own rows; other texts aren't shuffled where those
    documents are few enough to be sent out."""
    lists = written(rows.groupBy(*ADDRESS).agg(F.collect_list(F.struct(*item)).alias(name)), name)
    some = narrow_join(texts, lists.select(*ADDRESS), ADDRESS, "left_semi")
    return some.join(lists, ADDRESS)


def repeated_spans(docs: DataFrame, texts: DataFrame, window: int, anchor: int, collection: int, crowd: int) -> DataFrame:
    """(address, low, high): byte spans covered by repeated windows of ``texts``, overlapping ones included."""
    spark = docs.sparkSession
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        runs = written(texts.mapInArrow(_anchored(window, anchor), _RUNS), "anchors")
    # Counts are stored before they are joined: only then can AQE split an anchor that very many runs share.
    often = written(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "often")
    candidates = written(narrow_join(runs, often, ["anchor"], "inner"), "anchor-runs")
    dropped(spark, runs, often)
    with_runs = _with_lists(texts, candidates, ["start", "shape", "anchor"], "runs")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        contexts = written(with_runs.mapInArrow(_contexts(window, False), _RUNS + ", same binary"), "contexts")
    # One row per distinct context, with the place of one of its occurrences.
    kinds = written(contexts.groupBy("anchor", "same").agg(
        F.count("*").alias("n"), F.min(F.struct(FILE, ROW, "start", "shape")).alias("first")), "context-kinds")
    whole = contexts.join(kinds.where("n > 1").select("anchor", "same"), ["anchor", "same"]).select(
        *ADDRESS, F.col("start").alias("low"), (F.col("start") + F.floor(F.col("shape") / SHAPE) - 1 + window).alias("high"))
    anchors = written(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
                      .where("kinds > 1 AND least = 1").select("anchor", "kinds"), "open-anchors")
    open_ = written(kinds.join(anchors, "anchor").select("first.*", "anchor", (F.col("n") == 1).alias("once"), "kinds"), "open-kinds")
    with_open = _with_lists(texts, open_, ["start", "shape", "anchor"], "runs")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        strings = written(with_open.mapInArrow(_contexts(window, True), _RUNS + ", context binary")
                          .join(open_.select(*ADDRESS, "start", "once", "kinds"), [*ADDRESS, "start"]), "strings")
    few = strings.where(F.col("kinds") <= crowd)
    groups = max(1, -(-few.count() // collection))
    found = few.withColumn("collection", F.pmod(F.xxhash64("anchor"), F.lit(groups))).groupBy("collection").applyInArrow(
        _collected(window, anchor), _SPANS)
    digests = strings.where(F.col("kinds") > crowd).mapInArrow(
        _windows(window), f"{FILE} bigint, {ROW} bigint, low bigint, times bigint, same binary")
    digests = written(digests, "windows")
    twice = digests.groupBy("same").agg(F.sum("times").alias("times")).where("times > 1").select("same")
    crowded = digests.where("times = 1").join(twice, "same").select(*ADDRESS, "low", (F.col("low") + window).alias("high"))
    spans = written(whole.unionByName(found).unionByName(crowded), "spans")
    dropped(spark, candidates, contexts, kinds, anchors, open_, strings, digests)
    return spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                   collection: int = COLLECTION, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: id, address, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``.

    ``kept`` are the remaining bytes where some but not all were removed; it is null where the text stays as it is and
    empty where nothing is left.
    """
    rows = addressed(docs, "documents")
    raw = text_of(rows, text_col)
    facts = written(rows.select(rows[id_col].cast("bigint").alias("id"), *ADDRESS, F.octet_length(raw).cast("bigint").alias("n_bytes"),
                                F.sha2(raw, 256).alias("sha")), "facts")
    same = facts.where(F.col("n_bytes") >= window).groupBy("sha").agg(
        F.count("*").alias("copies"), F.min(F.struct(*ADDRESS)).alias("stands")).where("copies > 1")
    copies = written(facts.join(same, "sha").select(*ADDRESS, (F.struct(*ADDRESS) == F.col("stands")).alias("stands")), "whole-copies")
    texts = rows.select(*ADDRESS, raw.cast("binary").alias("text")).where(F.octet_length("text") >= window)
    # One of each group of equal documents stands for them.
    texts = narrow_join(texts, copies.where("NOT stands").select(*ADDRESS), ADDRESS, "left_anti")
    spans = repeated_spans(docs, texts, window, anchor, collection, crowd)
    own = written(spans.join(copies.select(*ADDRESS), ADDRESS, "left_anti"), "own-spans")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        cut = written(_with_lists(texts, own, ["low", "high"], "spans").mapInArrow(
            _cut, f"{FILE} bigint, {ROW} bigint, removed bigint, n_spans bigint, kept_sha256 string, kept binary"), "cut")
    dropped(docs.sparkSession, spans, own)
    out = facts.join(copies.select(*ADDRESS, F.lit(True).alias("copied")), ADDRESS, "left").join(cut, ADDRESS, "left")
    copied = F.coalesce("copied", F.lit(False))
    return out.select(
        F.col("id").alias(id_col), *ADDRESS, "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copied, F.lit(sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
