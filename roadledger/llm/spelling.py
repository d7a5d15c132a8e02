"""Spelling variants: PartEnum signatures over letter multisets, equi-joined and verified, then forms and roots.

A word is the binary vector of its letters, each with its number of occurrence ((e, 1), (e, 2), ...). One inserted,
deleted or replaced code point moves it by a Hamming distance of at most two. The dimensions are dealt into PARTS parts
(whole letters, evenly by how often each occurs), so two such words differ in at most two parts, and for some choice of
PARTS - 2 parts their projections are equal. All those choices are enumerated: a signature is the choice and the
projection. The projection is written in the order the letters have in the word. That is finer than the multiset
and loses no pair, because an edit of letters outside the choice leaves the order of the others as it was.
Pairs with an equal signature are verified by their edit distance in the join itself; only verified pairs become rows.

Words are counted per task before their shuffle. A form always has at least twice the word's count, so chains of forms
are short; pointer jumping follows them in a few joins. Spark plans a table of signatures by the files of the words, some
fiftieth of what it holds in memory, and would broadcast it; so all joins here are shuffled by name, whatever size is planned.

Defined results: null texts have no words; a null id is empty text in the checksum of the noise; ties of counts go to
the word first in code-point order; an empty table, or one without words, gives no rows; other columns are neither read
nor returned.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from roadledger.llm.common import dropped, settings
from roadledger.llm.shingles import slices
from roadledger.session import written

RUN = re.compile("[a-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT = 5, 3
PARTS = 8
#: A word's form has at least so many times its count.
DOMINANCE = 2
#: Different words that a task counts before it passes them on, and rows with texts sent to Python at a time.
COUNTED, TEXT_ROWS = 200_000, 1000
#: A join of sorted shuffled sides, which AQE does not turn into a broadcast either.
SHUFFLED = "merge"


def _counter(every: int | None):
    """Counts runs of letters; with ``every``, a run whose checksum it divides loses a code point (see ``word_counts``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for part in slices(batches, "text"):
            texts = pc.ascii_lower(part.column("text")).to_pylist()
            for ident, text in zip(part.column("id").to_pylist(), texts):
                words = Counter(RUN.findall(text))
                if every:
                    start = zlib.crc32(f"{'' if ident is None else ident}:".encode())
                    for word in [w for w in words if not zlib.crc32(w.encode(), start) % every]:
                        cut = zlib.crc32(word.encode(), start) % len(word)
                        # Collected apart: the shorter word may be one of this text's own.
                        held[word[:cut] + word[cut + 1:]] += words.pop(word)
                held.update(words)
            if len(held) >= COUNTED:
                yield passed_on()
        yield passed_on()

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = None,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words with enough code points and occurrences; written.

    With ``every``, noise comes first: let h be the CRC-32 of ``<id>:<run>``; where ``every`` divides h, the run loses
    its code point h % length.
    """
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(TEXT_ROWS)):
        counted = rows.mapInArrow(_counter(every), "word string, n bigint")
        return written(counted.groupBy("word").agg(F.sum("n").alias("n")).where(
            (F.col("n") >= min_count) & (F.char_length("word") >= min_length)), "words")


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters of every part: each letter, the most frequent first, goes to the part with the fewest letters so far.

    One row per letter reaches the driver; an alphabet does not grow with the input.
    """
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''")
    counts = letters.groupBy("letter").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "letter").collect()
    held, load = [""] * parts, [0] * parts
    for letter, n in counts:
        least = load.index(min(load))
        held[least] += letter
        load[least] += n
    return held


def signatures(word: Column, parts: list[str]) -> Column:
    """array<struct<choice, kept>>: the word without the letters of two parts, for every two parts."""
    return F.array(*[F.struct(F.lit(number).alias("choice"), F.translate(word, one + other, "").alias("kept"))
                     for number, (one, other) in enumerate(combinations(parts, 2))])


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """Verified pairs (a, a_n, b, b_n), a before b, of words one edit apart; written."""
    signed = words.select("word", "n", F.inline(signatures(F.col("word"), letter_parts(words, parts))))
    ends = [signed.select("choice", "kept", F.col("word").alias(end), F.col("n").alias(f"{end}_n")) for end in ("a", "b")]
    one_edit = F.levenshtein("a", "b", 1) == 1
    close = F.abs(F.char_length("a") - F.char_length("b")) <= 1
    return written(ends[0].join(ends[1].hint(SHUFFLED), ["choice", "kept"]).where((F.col("a") < F.col("b")) & close & one_edit)
                   .select("a", "a_n", "b", "b_n").distinct(), "near-words")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form, by pointer jumping; written."""
    spark, before = forms.sparkSession, None
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = written(at.join(onward.hint(SHUFFLED), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        dropped(spark, at)
        at = ahead
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def spelling_groups(words: DataFrame, dominance: int = DOMINANCE, parts: int = PARTS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of the stored table ``words`` (word, n; words distinct)."""
    pairs = near_words(words, parts)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("low"), "other")).alias("best"))
    held = written(words.join(near.hint(SHUFFLED), "word", "left").withColumn(
        "chosen", -F.col("best.low") >= dominance * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("chosen"), F.col("best.other")).alias("form"), F.when(F.col("chosen"), -F.col("best.low")).alias("form_n")),
        "forms")
    roots = _roots(held.where("form IS NOT NULL"))
    return held.join(roots.hint(SHUFFLED), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                   "form_n")
