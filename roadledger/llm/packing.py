"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents.

Each text becomes token ids and one end id; ids are cut every ``LENGTH`` tokens. Full pieces are sequences of their
own, the rest of each document is an item. Documents are dealt by a hash of their address to groups of about
``GROUP_BYTES`` of text, so a group is bounded at any input size and evenly filled whatever its ids or sources; each
group is packed by one task. Only token ids are shuffled.

Words are tokenised once per batch and looked up after that. This equals tokenising the whole text for tokenizers that
lower the case, drop white space, never merge across it, part letters from stops, and mark the last token of a word
(``word_bpe_49k.json`` is one): texts are lowered (A-Z), punctuation is set off from the letters before it, and what is
then between spaces or line feeds is one chunk. New chunks of Latin letters alone are tokenised many at a time and
told apart by the mark.

Defined results: null or empty text is the end id alone; equal lengths are placed in address order; repeated rows are
packed one by one; a null id stays null; an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, text_of
from roadledger.llm.shingles import slices

LENGTH = 2048
END_ID = 1
GROUP_BYTES = 4 << 20
#: Chunks a Python worker remembers anew before it forgets those it has not met since the last time.
REMEMBERED = 200_000
#: Text bytes tokenised at a time: more is faster, less takes less memory.
SLICE_BYTES = 3 << 20
#: Words of Latin letters that are tokenised as one text.
JOINED = 256
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: A letter before ASCII punctuation that cannot start a contraction or a special token; and the same for texts that may
#: name special tokens, whose own letters and signs stay together.
SET_OFF = r"([a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])([!-&(-/:;=-@\[-`{-~])"
STOPS = "([a-z])([.,])"
#: Sequence numbers of a group start at its number times this.
GROUP_STEP = 1 << 32
_KNOWN: dict[str, Words] = {}


class Words:
    """A tokenizer and the chunks it has met, once per Python worker."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[code for token, code in vocabulary.items() if token.endswith("</w>")]] = True
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, as bytes."""
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        new = []
        for chunk in chunks:
            if chunk not in recent:
                known = older.get(chunk)
                if known is None:
                    new.append(chunk)
                else:
                    recent[chunk] = known
        latin = [c for c in new if LATIN.fullmatch(c)]
        self._learn_words(latin)
        self._learn([c for c in new if c not in recent])
        return [recent[c] for c in chunks]

    def _learn(self, chunks: list[str]) -> None:
        for chunk, found in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)):
            self.recent[chunk] = np.array(found.ids, self.kind).tobytes()

    def _learn_words(self, words: list[str]) -> None:
        lines = [words[k:k + JOINED] for k in range(0, len(words), JOINED)]
        for line, found in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(found.ids, self.kind)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(line) or not len(stops) or stops[-1] != len(ids):
                continue  # not one marked end a word: each is tokenised alone
            raw, size = ids.tobytes(), ids.itemsize
            self.recent.update((word, raw[a * size:b * size]) for word, a, b in zip(line, [0, *stops[:-1].tolist()], stops.tolist()))


def _tokenizer(path: str) -> Words:
    if path not in _KNOWN:
        _KNOWN[path] = Words(path)
    return _KNOWN[path]


def _plain(texts: pa.Array) -> pa.Array:
    """Texts as chunks between single spaces; texts that may name special tokens keep their case."""
    special = pc.match_substring(texts, "<|")
    texts = pc.replace_substring(pc.if_else(special, texts, pc.ascii_lower(texts)), "\n", " ")
    parted = pc.replace_substring_regex(texts, SET_OFF, r"\1 \2")
    return pc.if_else(special, pc.replace_substring_regex(texts, STOPS, r"\1 \2"), parted) if pc.any(special).as_py() else parted


def token_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of each text, without the end id."""
    words = _tokenizer(path)
    lists = pc.split_pattern(_plain(texts.cast(pa.large_string())), " ")
    chunks, of = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    coded = chunks.dictionary_encode()
    each = words.ids(coded.dictionary.to_pylist())
    flat = np.frombuffer(b"".join(each), words.kind)
    size = np.fromiter(map(len, each), np.int64, len(each)) // flat.itemsize
    first = np.cumsum(size) - size
    code = coded.indices.to_numpy() if len(chunks) else np.zeros(0, np.int64)
    length = size[code]
    done = np.cumsum(length)
    ids = flat[np.repeat(first[code] - (done - length), length) + np.arange(done[-1] if len(done) else 0)]
    per_text = np.bincount(of, weights=length, minlength=len(texts)).astype(np.int64)
    return np.split(ids, np.cumsum(per_text)[:-1]) if len(texts) else []


class BinTree:
    """First bin that still takes an item, found by descending a tournament tree of remaining capacities."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of every item, bins numbered from 0 in the order they are opened."""
    tree, bins = BinTree(len(sizes), capacity), [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bins[item] = tree.place(sizes[item])
    return bins


_TOKENS = f"id bigint, {FILE} bigint, {ROW} bigint, group int, ids binary"
_PIECES = (f"id bigint, {FILE} bigint, {ROW} bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
           "offset bigint, ids binary")


def _tokenised(path: str, end_id: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _tokenizer(path).kind
        end = np.array([end_id], kind).tobytes()
        for part in slices(batches, "text", slice_bytes):
            ids = [i.tobytes() + end for i in token_ids(part.column("text"), path)]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("id", FILE, ROW, "group")] + [pa.array(ids, pa.binary())],
                                             names=["id", FILE, ROW, "group", "ids"])

    return run


def _packed(path: str, length: int):
    def run(table: pa.Table) -> pa.Table:
        kind = _tokenizer(path).kind
        table = table.sort_by([(FILE, "ascending"), (ROW, "ascending")])
        docs = [np.frombuffer(x, kind) for x in table.column("ids").to_pylist()]
        first = table.column("group")[0].as_py() * GROUP_STEP
        row, start, size, sequence = [], [], [], []
        for k, ids in enumerate(docs):
            for cut in range(0, len(ids) - length + 1, length):
                row.append(k), start.append(cut), size.append(length), sequence.append(first)
                first += 1
        full = len(row)
        offset = [0] * full
        items = [k for k, ids in enumerate(docs) if len(ids) % length]
        sizes = [len(docs[k]) % length for k in items]
        filled: dict[int, int] = {}
        for k, n, place in zip(items, sizes, first_fit_decreasing(sizes, length)):
            row.append(k), start.append(len(docs[k]) - n), size.append(n), sequence.append(first + place)
            offset.append(filled.get(place, 0))
            filled[place] = offset[-1] + n
        pieces = [docs[k][s:s + n].astype("<u4").tobytes() for k, s, n in zip(row, start, size)]
        picked = table.select(["id", FILE, ROW]).take(pa.array(row, pa.int64()))
        columns = {"start": start, "length": size, "doc_tokens": [len(docs[k]) for k in row], "sequence_id": sequence, "offset": offset}
        for name, values in columns.items():
            picked = picked.append_column(name, pa.array(values, pa.int64()))
        return picked.append_column("ids", pa.array(pieces, pa.binary()))

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         end_id: int = END_ID, group_bytes: int = GROUP_BYTES, seed: int = 7, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece: id, address, start, length, doc_tokens, sequence_id, offset and its ids (little-endian uint32).

    ``tokenizer`` is the path of a tokenizer file that every executor can open.
    """
    rows = addressed(docs, "documents")
    total = rows.agg(F.sum(F.octet_length(text_of(rows, text_col)))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    dealt = rows.select(rows[id_col].cast("bigint").alias("id"), *ADDRESS, text_of(rows, text_col).alias("text"),
                        F.pmod(F.xxhash64(FILE, ROW, F.lit(seed)), F.lit(groups)).cast("int").alias("group"))
    tokens = dealt.mapInArrow(_tokenised(tokenizer, end_id, slice_bytes), _TOKENS)
    return tokens.groupBy("group").applyInArrow(_packed(tokenizer, length), _PIECES).withColumnRenamed("id", id_col)
