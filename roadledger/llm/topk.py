"""Exact top-k inner-product search over norm buckets.

Vectors become whole numbers, floor(256 * x) of every component. Sorted by length they are cut into buckets of at most
``BUCKET`` vectors, one stored row each; queries are packed in blocks of ``QUERIES``. The bucket of the longest vectors
gives every query a first threshold: its k-th score there. A bucket is left to a query block only if its longest vector
times some query's length reaches that query's threshold. Inside a bucket each query's local cosine threshold (threshold
over both lengths) chooses the pruning: from ``COORDINATE_FROM`` on by coordinates, which keeps vectors whose
normalised values on the query's largest coordinates lie in the interval that cosine leaves possible; below by length,
which keeps the longest vectors down to what the threshold needs. Products of what is left are verified exactly, k rows
per query and bucket are returned, and ranked per query. Bounds have slack for rounding, so no result is lost.

Defined results: a vector that is null or holds a null or non-finite component takes no part, as does a row without id;
shorter vectors, empty ones too, count as filled with zeros; of equal scores the smaller id comes first, then the lower
address; a query is never its own candidate, but rows that repeat it are; with fewer than k candidates all are
returned; scores beyond 64 bits are held at its limits; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, dropped, settings
from roadledger.session import written

SCALE, K = 256, 5
BUCKET, QUERIES = 4096, 256
#: Local cosine threshold from which a query prunes by coordinates, and how many coordinates it looks at.
COORDINATE_FROM, COORDINATES = 0.5, 4
#: Rows with a whole bucket that are sent to Python at a time.
BATCH_ROWS = 4
SLACK = 1e-9
_ROWS = f"id bigint, {FILE} bigint, {ROW} bigint, norm double, v binary"
_PACKED = "high double, n int, dims int, ids binary, files binary, places binary, vectors binary"
_FOUND = "query bigint, qfile bigint, qrow bigint, vec_id bigint, vfile bigint, vrow bigint, score bigint"


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole-number vectors (as doubles, exact) and their lengths, without rows that take no part."""
    for batch in batches:
        lists = batch.column("v")
        keep, norms, vectors = [], [], []
        for k, (row, ident) in enumerate(zip(lists, batch.column("id"))):
            if not row.is_valid or not ident.is_valid or row.values.null_count:
                continue
            v = np.floor(row.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            if np.isfinite(v).all():
                keep.append(k)
                norms.append(float(np.sqrt(np.dot(v, v))))
                vectors.append(v.tobytes())
        picked = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([picked.column("id"), picked.column(FILE), picked.column(ROW), pa.array(norms, pa.float64()),
                                          pa.array(vectors, pa.binary())], names=["id", FILE, ROW, "norm", "v"])


def _pack(size: int):
    """Rows of a partition, in order, as rows of at most ``size`` vectors."""

    def row(rows: list[dict]) -> pa.RecordBatch:
        vectors = [np.frombuffer(r["v"]) for r in rows]
        dims = max(map(len, vectors))
        matrix = np.zeros((len(rows), dims))
        for line, v in zip(matrix, vectors):
            line[:len(v)] = v
        ids, files, places = (np.array([r[c] for r in rows], np.int64).tobytes() for c in ("id", FILE, ROW))
        if np.abs(matrix).max(initial=0) < 1 << 24:  # exact in half the space
            matrix = matrix.astype(np.float32)
        values = [max(r["norm"] for r in rows), len(rows), dims, ids, files, places, matrix.tobytes()]
        kinds = [pa.float64(), pa.int32(), pa.int32()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)],
                                          names=["high", "n", "dims", "ids", "files", "places", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= size:
                yield row(held[:size])
                held = held[size:]
        if held:
            yield row(held)

    return run


def _matrix(row: dict, side: str, dims: int) -> np.ndarray:
    n, wide, raw = row[side + "n"], row[side + "dims"], row[side + "vectors"]
    kind = np.float32 if len(raw) == 4 * n * wide else np.float64
    out = np.zeros((n, dims))
    out[:, :wide] = np.frombuffer(raw, kind).reshape(n, wide)
    return out


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit numbers; Python's integers where doubles could round."""
    if not q.size or not v.size or float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2**53:
        return (q @ v.T).astype(np.int64)
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in v] for x in q]
    return np.clip(np.array(exact, dtype=object), -2**63, 2**63 - 1).astype(np.int64).reshape(len(q), len(v))


def _possible(q: np.ndarray, qnorm: float, unit: np.ndarray, local: float) -> np.ndarray:
    """Vectors whose largest-query coordinates allow a cosine of ``local`` (places in the bucket)."""
    direction = q / qnorm
    keep = np.arange(len(unit))
    for c in np.argsort(-np.abs(direction), kind="stable")[:COORDINATES]:
        d = direction[c]
        reach = np.sqrt(max(0.0, (1 - d**2) * (1 - local**2)))
        low = -1.0 if d <= -local else d * local - reach
        high = 1.0 if d >= local else d * local + reach
        values = unit[keep, c]
        keep = keep[(values >= low - SLACK) & (values <= high + SLACK)]
    return keep


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = [np.zeros((0, 7), np.int64)]
            for row in batch.to_pylist():
                dims = max(row["qdims"], row["dims"])
                q, v = _matrix(row, "q", dims), _matrix(row, "", dims)
                qids, qfiles, qplaces = (np.frombuffer(row["q" + c], np.int64) for c in ("ids", "files", "places"))
                ids, files, places = (np.frombuffer(row[c], np.int64) for c in ("ids", "files", "places"))
                floor = np.frombuffer(row["floors"], np.float64) if row["floors"] else np.full(len(q), -np.inf)
                qnorm, norm = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
                high = norm.max()
                with np.errstate(divide="ignore", invalid="ignore"):
                    local = np.where((floor > 0) & (qnorm * high > 0), floor / (qnorm * high), 0.0) * (1 - SLACK)
                    unit = np.where(norm[:, None] > 0, v / norm[:, None], 0.0) if (local >= COORDINATE_FROM).any() else v
                by_length = np.nonzero(local < COORDINATE_FROM)[0]
                if len(by_length):
                    # Vectors come longest first: what the least threshold of these queries needs is a prefix.
                    need = np.min(local[by_length]) * high * (1 - SLACK)
                    last = int(np.searchsorted(-norm, -need, side="right")) if (np.diff(norm) <= 0).all() else len(v)
                    scores = _products(q[by_length], v[:last])
                    places_of = [(i, np.arange(last), scores[j]) for j, i in enumerate(by_length)]
                else:
                    places_of = []
                for i in np.nonzero((local >= COORDINATE_FROM) & (local <= 1))[0]:
                    kept = _possible(q[i], qnorm[i], unit, local[i])
                    places_of.append((i, kept, _products(q[i:i + 1], v[kept])[0]))
                for i, kept, scores in places_of:
                    good = (scores >= floor[i]) & ~((files[kept] == qfiles[i]) & (places[kept] == qplaces[i]))
                    kept, scores = kept[good], scores[good]
                    if len(kept) > 4 * k:  # the k-th score bounds what is sorted
                        least = np.partition(scores, len(scores) - k)[len(scores) - k]
                        kept, scores = kept[scores >= least], scores[scores >= least]
                    best = np.lexsort((places[kept], files[kept], ids[kept], -scores))[:k]
                    own = np.array([qids[i], qfiles[i], qplaces[i]])
                    found.append(np.column_stack([np.tile(own, (len(best), 1)), ids[kept[best]], files[kept[best]],
                                                  places[kept[best]], scores[best]]).astype(np.int64))
            out = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[:, c])) for c in range(7)],
                                             names=["query", "qfile", "qrow", "vec_id", "vfile", "vrow", "score"])

    return run


def _with_floors(k: int):
    """Query blocks with every query's threshold and the least length of a vector that any query still needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, needs = [], []
            for row in batch.to_pylist():
                q = _matrix(row, "q", row["qdims"])
                places = {place: i for i, place in enumerate(zip(np.frombuffer(row["qfiles"], np.int64).tolist(),
                                                                 np.frombuffer(row["qplaces"], np.int64).tolist()))}
                floor = np.full(len(q), -np.inf)
                for found in row["seen"] or []:
                    if len(found["scores"]) >= k:
                        floor[places[found["qfile"], found["qrow"]]] = min(found["scores"])
                norm = np.sqrt((q * q).sum(1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where((floor > 0) & (norm > 0), floor / norm, -np.inf)
                floors.append(floor.tobytes())
                needs.append(float(need.min()) * (1 - SLACK))
            columns = [batch.column(c) for c in batch.schema.names if c != "seen"]
            names = [c for c in batch.schema.names if c != "seen"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(floors, pa.binary()), pa.array(needs, pa.float64())],
                                             names=[*names, "floors", "need"])

    return run


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          bucket: int = BUCKET, queries: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best candidates of every row where ``is_query`` holds.

    ``is_query`` is an expression over the column ``id``.
    """
    spark = vectors.sparkSession
    rows = addressed(vectors, "vectors")
    rows = rows.select(rows[id_col].cast("bigint").alias("id"), *ADDRESS, rows[vector_col].cast("array<double>").alias("v"))
    rows = written(rows.mapInArrow(_quantised, _ROWS), "quantised")
    count, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    order = [F.col("norm").desc(), F.col(FILE), F.col(ROW)]  # ties in length are dealt out by address
    packed = (rows.repartitionByRange(max(1, -(-count // bucket)), *order).sortWithinPartitions(*order)
              .mapInArrow(_pack(bucket), _PACKED).withColumn("bucket", F.monotonically_increasing_id()))
    buckets = written(packed, "buckets")
    blocks = rows.where(is_query).repartition(max(1, -(-asked // queries)), *ADDRESS).mapInArrow(_pack(queries), _PACKED)
    names = ["n", "dims", "ids", "files", "places", "vectors"]
    blocks = written(blocks.select(F.monotonically_increasing_id().alias("block"), *[F.col(c).alias("q" + c) for c in names]),
                     "query-blocks")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        first_of = buckets.select("high", "bucket").orderBy(F.desc("high"), "bucket").limit(1).select("bucket")
        longest = buckets.join(F.broadcast(first_of), "bucket")
        # One bucket, of a bounded number of vectors, is sent to all query blocks.
        seen = blocks.withColumn("floors", F.lit(None).cast("binary")).join(F.broadcast(longest))
        first = written(seen.select("block", "floors", *["q" + c for c in names], *names).mapInArrow(_searched(k), _FOUND), "first")
        by_query = first.groupBy("qfile", "qrow").agg(F.collect_list("score").alias("scores"))  # k at most
        asked_by = written(_members(blocks), "askers")
        by_block = asked_by.join(by_query, ["qfile", "qrow"]).groupBy("block").agg(
            F.collect_list(F.struct("qfile", "qrow", "scores")).alias("seen"))  # one block's queries at most
        layout = "block bigint, qn int, qdims int, qids binary, qfiles binary, qplaces binary, qvectors binary, floors binary, need double"
        ready = written(blocks.join(by_block, "block", "left").select("block", *["q" + c for c in names], "seen")
                        .mapInArrow(_with_floors(k), layout), "ready-blocks")
        # Block numbers first: a pair that the lengths rule out never meets its vectors.
        pairs = ready.select("block", "need").join(buckets.select("bucket", "high"), F.col("high") >= F.col("need")).select(
            "block", "bucket")
        found = written(pairs.join(ready, "block").join(buckets, "bucket").select("floors", *["q" + c for c in names], *names)
                        .mapInArrow(_searched(k), _FOUND), "found")
    dropped(spark, rows, buckets, blocks, first, asked_by, ready)
    best = Window.partitionBy("query", "qfile", "qrow").orderBy(F.desc("score"), "vec_id", "vfile", "vrow")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", "vec_id", "score")


def _members(blocks: DataFrame) -> DataFrame:
    """(block, qfile, qrow) of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, places = np.frombuffer(row["qfiles"], np.int64), np.frombuffer(row["qplaces"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(files), row["block"])), pa.array(files), pa.array(places)],
                                                 names=["block", "qfile", "qrow"])

    return blocks.select("block", "qfiles", "qplaces").mapInArrow(run, "block bigint, qfile bigint, qrow bigint")
