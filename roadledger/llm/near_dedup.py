"""MinHash near-dedup: universal hash minima, banding, signature and full-set verification, star components.

A text's set holds its distinct 5-word shingles (64-bit hashes; A-Z lowered, words cut at ASCII white space).
Two texts are linked when 100 * intersection >= 75 * union; a group is what links connect.

* Equal word sequences are one node (128-bit digest of the words), so a large group of copies is one row early.
* 256 universal hash functions give minima; 51 bands of 5 minima put texts into buckets. A pair at similarity 0.75
  shares no band with probability below 1e-6, less above. The parity bits of the minima are a 256-bit signature.
* First pass: every member of a bucket is held against the bucket's least node only. Second pass: where members
  of a bucket then lie in different components, those outside the first node's component are held against all
  members of other components, in chunks of a fixed size, so no pair sharing a bucket goes unseen and pairs inside
  a component are never made. Their sets are compared there and then, chunk by chunk; only one link of a text to each
  component leaves the task, so a crowd of texts just below the threshold makes no rows of pairs.
* A pair whose signatures agree in fewer than 192 of 256 bits is left (6 standard deviations below what 0.75
  gives), as is one whose sizes rule the link out; links of the rest are confirmed on full sets.

Defined results: a text without words has an empty set, no links and its own id as component; fewer than five words
make one shingle; null text counts as empty; repeated rows are one node; null ids are passed over when the least
id is taken; an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, dropped, narrow_join, settings
from roadledger.llm.components import components
from roadledger.llm.shingles import give_back, mixed, shingle_sets, slices, word_lists
from roadledger.session import written

BANDS, BAND_ROWS, BITS = 51, 5, 256
SEED = 20240601
#: Least agreement of two 256-bit signatures for a pair to be confirmed on its sets.
AGREEMENT = 192
#: Rows with whole texts that are sent to Python at a time.
TEXT_ROWS = 1000
#: Members of a bucket that one row of the second pass holds on either side, and rows sent to Python at a time there
#: and where pairs are held with both their sets.
CHUNK, BATCH_ROWS = 128, 250
#: The same where members carry their sets; cells of a table of sets and shingles that is made for a pair of chunks.
SET_CHUNK, SET_ROWS, DENSE = 64, 16, 1 << 24
SIGNATURE = ["s0", "s1", "s2", "s3"]
_SKETCHED = (f"{FILE} bigint, {ROW} bigint, id bigint, same binary, n bigint, s0 bigint, s1 bigint, s2 bigint, "
             "s3 bigint, bands array<bigint>")


def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    a, b = (random.integers(0, 2**64, BITS, dtype=np.uint64) for _ in range(2))
    return a | np.uint64(1), b


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 256) -> np.ndarray:
    """Least value of every function (a*x + b mod 2^64) >> 32 over the folded shingles."""
    folded = (shingles >> np.uint64(32)) ^ (shingles & np.uint64(0xFFFFFFFF))
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(folded), block):
        values = np.multiply.outer(a, folded[start:start + block])
        values += b[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return low >> np.uint64(32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _functions()
    weights = mixed(np.arange(1, BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    numbers = mixed(np.arange(1000, 1000 + BANDS, dtype=np.uint64))
    for part in slices(batches, "text"):
        words, counts = word_lists(part.column("text"))
        same, sizes, bits, bands, ends = [], [], [], [], [0]
        start, whole = 0, words.to_pylist()
        for count, shingles in zip(counts.tolist(), shingle_sets(words, counts)):
            same.append(blake2b(" ".join(whole[start:start + count]).encode("utf-8", "surrogatepass"), digest_size=16).digest())
            start += count
            sizes.append(len(shingles))
            low = minima(shingles, a, b)
            bits.append(np.packbits((low & np.uint64(1)).astype(np.uint8)).view(np.int64))
            if len(shingles):
                keys = low[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS) * weights
                bands.append(mixed(keys.sum(axis=1, dtype=np.uint64) + numbers).view(np.int64))
            ends.append(ends[-1] + (BANDS if len(shingles) else 0))
        bits = np.array(bits, dtype=np.int64).reshape(-1, 4)
        flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column(FILE), part.column(ROW), part.column("id"), pa.array(same, pa.binary()), pa.array(sizes, pa.int64()),
             *[pa.array(bits[:, k]) for k in range(4)],
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
            names=[FILE, ROW, "id", "same", "n", *SIGNATURE, "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        found = [s.tobytes() for s in shingle_sets(*word_lists(part.column("text")))]
        yield pa.RecordBatch.from_arrays([part.column("uid"), pa.array(found, pa.binary())], names=["uid", "shingles"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets reach 100 * intersection >= 75 * union."""
    for part in slices(batches, "x"):
        keep = []
        for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _plausible_pairs(left: dict, right: dict, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components that signatures and sizes allow, by place, but for those with ``head``."""
    agree = np.full((len(left["uid"]), len(right["uid"])), BITS, np.int64)
    for name in SIGNATURE:
        agree -= np.bitwise_count((left[name][:, None] ^ right[name][None, :]).view(np.uint64))
    small, large = np.minimum.outer(left["n"], right["n"]), np.maximum.outer(left["n"], right["n"])
    return np.nonzero((agree >= AGREEMENT) & (100 * small >= 75 * large) & (right["uid"] != head)[None, :]
                      & (left["component"][:, None] != right["component"][None, :]))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[dict, dict, int]]:
    """(others, members, head) of every row, as arrays."""
    sides = [_members(batch.column(side)) for side in ("others", "members")]
    for k, head in enumerate(batch.column("head").to_pylist()):
        yield *({name: values[offsets[k]:offsets[k + 1]] for name, values in fields.items()} for offsets, fields in sides), head


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a batch that have plausible pairs."""
    for batch in batches:
        uids = [np.zeros(0, np.int64)]
        for left, right, head in _chunks(batch):
            i, j = _plausible_pairs(left, right, head)
            uids += [left["uid"][i], right["uid"][j]]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(uids)))], names=["uid"])
        give_back()


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one side with all of the other."""
    words, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    if len(words) * (len(left) + len(right)) <= DENSE:
        held = np.zeros((len(left) + len(right), len(words)), np.float32)
        held[owner, code] = 1
        return (held[:len(left)] @ held[len(left):].T).astype(np.int64)
    return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])


def _links_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text's links, confirmed on full sets, one for every other component of a chunk."""
    for batch in batches:
        found = [np.zeros((0, 2), np.int64)]
        for left, right, head in _chunks(batch):
            i, j = _plausible_pairs(left, right, head)
            if not len(i):
                continue
            rows, columns = np.unique(i), np.unique(j)
            sets = [[np.frombuffer(side["shingles"][k], np.uint64) for k in places] for side, places in ((left, rows), (right, columns))]
            both = _common(*sets)[np.searchsorted(rows, i), np.searchsorted(columns, j)]
            good = 100 * both >= 75 * (left["n"][i] + right["n"][j] - both)
            i, j = i[good], j[good]
            _, first = np.unique(np.stack([i, right["component"][j]], axis=1), axis=0, return_index=True)
            found.append(np.stack([left["uid"][i[first]], right["uid"][j[first]]], axis=1))
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        del found, pairs
        give_back()


def _members(lists: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of lists of structs, without a copy into Python."""
    offsets = np.asarray(lists.offsets)
    flat = lists.values
    return offsets, {flat.type.field(k).name: flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)}


def _stored_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full sets of the texts in ``wanted`` (uid and address)."""
    with settings(texts.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(TEXT_ROWS)):
        return written(narrow_join(texts, wanted, ADDRESS, "inner").select("uid", "text")
                       .mapInArrow(_sets, "uid bigint, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """The written links among ``pairs`` (a, b: bigint)."""
    spark = pairs.sparkSession
    places = sketches.select("uid", *ADDRESS)
    nodes = pairs.select(F.col("a").alias("uid")).unionByName(pairs.select(F.col("b").alias("uid"))).distinct()
    wanted = written(places.join(nodes, "uid"), "wanted")
    sets = _stored_sets(texts, wanted)
    both = (pairs.join(sets.select(F.col("uid").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("uid").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y"))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        links = written(both.mapInArrow(_linked, "a bigint, b bigint"), "links")
    dropped(spark, wanted, sets)
    return links


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sizes and signatures allow the similarity."""
    facts = sketches.select("uid", "n", *SIGNATURE)
    for end in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("uid").alias(end), *[F.col(c).alias(end + c) for c in ("n", *SIGNATURE)]), end)
    apart = sum((F.bit_count(F.col("a" + s).bitwiseXOR(F.col("b" + s))) for s in SIGNATURE), F.lit(0))
    return pairs.where((apart <= BITS - AGREEMENT)
                       & (100 * F.least("an", "bn") >= 75 * F.greatest("an", "bn"))).select("a", "b")


def _chunk_pairs(placed: DataFrame, member: list[str], size: int) -> DataFrame:
    """Rows of (head, others, members): every chunk of a bucket's others, those outside the component of its first
    node, with every chunk of its members."""
    chunk = F.pmod(F.xxhash64("uid"), F.ceil(F.col("size") / size)).alias("chunk")

    def chunks(rows: DataFrame, name: str) -> DataFrame:
        # A chunk holds about ``size`` members whatever the size of its bucket.
        return rows.groupBy("band", "head", chunk).agg(F.collect_list(F.struct(*member)).alias(name)).drop("chunk")

    return chunks(placed.where("component <> first"), "others").join(chunks(placed, "members"), ["band", "head"]).select(
        "head", "others", "members")


def _second_pass(members: DataFrame, groups: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """Links between components that share a bucket: for every text at least one to each component it is linked to
    there. So merging them gives the groups that all links give."""
    spark = members.sparkSession
    placed = members.where("size > 2").join(groups.select(F.col("node").alias("uid"), "component"), "uid", "left").withColumn(
        "component", F.coalesce("component", "uid"))
    heads = placed.where("uid = head").select("band", F.col("component").alias("first"))
    several = written(placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                      .where("low < high").select("band").join(heads, "band"), "mixed-buckets")
    placed = written(placed.join(several, "band").join(sketches.select("uid", "n", *SIGNATURE), "uid"), "mixed-members")
    member = ["uid", "component", "n", *SIGNATURE]
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        partners = written(_chunk_pairs(placed, member, CHUNK).mapInArrow(_partners, "uid bigint").distinct(), "partners")
    wanted = written(sketches.select("uid", *ADDRESS).join(partners, "uid"), "wanted")
    sets = _stored_sets(texts, wanted)
    # Buckets of texts with plausible pairs meet again, now with their sets.
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(SET_ROWS)):
        links = written(_chunk_pairs(placed.join(sets, "uid"), [*member, "shingles"], SET_CHUNK)
                        .mapInArrow(_links_across, "a bigint, b bigint").distinct(), "links-across")
    dropped(spark, several, placed, partners, wanted, sets)
    return links


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, stays and the address.

    ``kept`` compares ids as the name says; ``stays`` is true for exactly one row of a group, also where ids repeat.
    """
    spark = docs.sparkSession
    rows = addressed(docs, "documents")
    texts = rows.select(FILE, ROW, rows[id_col].cast("bigint").alias("id"), rows[text_col].cast("string").alias("text"))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(TEXT_ROWS)):
        sketches = written(texts.mapInArrow(_sketch, _SKETCHED).withColumn("uid", F.monotonically_increasing_id()), "sketches")
    # What a key has is stored before it is joined back: only then can AQE split a key with very many rows.
    classes = written(sketches.where("n > 0").groupBy("same").agg(F.min("uid").alias("node"), F.count("*").alias("copies"))
                      .where("copies > 1"), "classes")
    copies = written(sketches.select("uid", "same").join(classes, "same").where("uid <> node").select("uid", "node"), "copies")
    bands = narrow_join(sketches.select("uid", "bands"), copies, ["uid"], "left_anti").select(
        "uid", F.explode("bands").alias("band"))
    heads = written(bands.groupBy("band").agg(F.min("uid").alias("head"), F.count("*").alias("size")).where("size > 1"), "heads")
    members = written(bands.join(heads, "band"), "members")
    pairs = members.where("uid <> head").select(F.col("head").alias("a"), F.col("uid").alias("b")).distinct()
    pairs = written(_plausible(pairs, sketches), "pairs")
    links = _confirmed(pairs, texts, sketches)
    groups = written(components(links), "groups")
    across = _second_pass(members, groups, texts, sketches)
    groups = written(components(links.unionByName(across)), "groups")
    dropped(spark, classes, heads, members, pairs)
    placed = (sketches.select("uid", "id", "n", *ADDRESS).join(copies, "uid", "left")
              .withColumn("node", F.coalesce("node", "uid")).join(groups, "node", "left"))
    placed = written(placed.select("id", "n", *ADDRESS, F.coalesce("component", "node").alias("root")), "placed")
    best = F.min(F.struct(F.col("id").isNull().alias("noid"), F.col("id").alias("least"), F.col(FILE).alias("file"),
                          F.col(ROW).alias("row"))).alias("best")
    out = placed.join(written(placed.groupBy("root").agg(best), "best"), "root")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("best.least").alias("component_id"),
        F.col("id").eqNullSafe(F.col("best.least")).alias("kept"),
        ((F.col(FILE) == F.col("best.file")) & (F.col(ROW) == F.col("best.row"))).alias("stays"), *ADDRESS)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    rows = addressed(docs, "documents")
    gone = written(near_groups(rows, id_col, text_col).where(~F.col("stays")).select(*ADDRESS), "near-copies")
    return narrow_join(rows, gone, ADDRESS, "left_anti").select(*docs.columns)
