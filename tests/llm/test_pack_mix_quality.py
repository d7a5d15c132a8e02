"""Packing, mixing and the quality classifier on awkward rows and against plain recomputation."""

import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cases import LAYOUT, awkward_rows, prose, table
from roadledger.llm.mixing import KEEP_SHARE, ROUNDS, TEMPER, margin_report, mixed_cells, mixed_sample, mixture
from roadledger.llm.packing import first_fit_decreasing, pack
from roadledger.llm.quality import accepted, fit_quality, quality_scores
from roadledger.llm.statistics import NAMES, statistics
from roadledger.llm.trees import fit_forest

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = [c.split()[0] for c in LAYOUT.split(", ")]


def test_first_fit_decreasing():
    pick = random.Random(4)
    for _ in range(60):
        sizes = [pick.randint(1, 30) for _ in range(pick.randint(0, 50))]
        room, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            room += [30] * (k == len(room))
            room[k] -= sizes[i]
            want[i] = k
        assert first_fit_decreasing(sizes, 30) == want


def odd_texts():
    pieces = ["don't", "ЁЖ", "é", "́x", "<|endoftext|>", "a<|startoftext|>b", "\x1c", "\x0b", " ", " z",
              "ΣΑΣ", "İI", "12 345", "!!??", "\r\n", "\t", "日本語", "ﬁ", "the", "The.", "", "x" * 40, "‍", "😀😀"]
    pick = random.Random(8)
    return ["".join(pick.choice(pieces) + pick.choice([" ", "\n", "", "  "]) for _ in range(30)) for _ in range(200)]


def test_pack(spark):
    from tokenizers import Tokenizer

    rows = awkward_rows() + [(1000 + i, t) + (None,) * 6 for i, t in enumerate(odd_texts())]
    rows = [r for r in rows if r[0] is not None]
    plain = Tokenizer.from_file(PATH)
    want = {r[0]: plain.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    out = pack(table(spark, rows), PATH, length=64, group_bytes=20_000).collect()
    documents, sequences = {}, {}
    for p in out:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and p.doc_tokens == len(want[p.doc_id])
        assert want[p.doc_id][p.start:p.start + p.length] == ids.tolist()
        documents.setdefault((p.doc_id, p["__row_file"], p["__row_index"]), []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert len(documents) == len(rows)
    for (doc, *_), cuts in documents.items():
        assert sum(n for _, n in cuts) == len(want[doc]) and len({s for s, _ in cuts}) == len(cuts)
    for cuts in sequences.values():
        at = 0
        for offset, n in sorted(cuts):
            assert offset == at
            at += n
        assert at <= 64
    assert pack(table(spark, []), PATH).count() == 0


def test_the_pipeline_keeps_the_ids(spark):
    from tokenizers import Tokenizer

    import corpus_pipeline

    texts = [prose(i, 40) for i in range(20)]
    rows = [(i, t) + (None,) * 6 for i, t in enumerate(texts)]
    plain, got = Tokenizer.from_file(PATH), {}
    for p in corpus_pipeline.packing(spark, table(spark, rows), "").orderBy("doc_id", "start").collect():
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert got == {i: plain.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}


def test_mixing(spark):
    rows = awkward_rows()
    out = mixture(table(spark, rows), topic=F.lit(None)).collect()
    assert len(out) == len(rows) and all(0 <= r["__mix_probability"] <= 1 for r in out)
    assert mixed_sample(table(spark, rows)).columns == COLUMNS
    assert mixed_sample(table(spark, [])).count() == 0


def test_raking_meets_the_targets(spark):
    pick = random.Random(3)
    rows = [(s, t, pick.randint(1, 500)) for s in "abc" for t in "xyz" for _ in range(20)]
    df = spark.createDataFrame(rows, "source string, topic string, tokens bigint")
    goals = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "topic": {"x": 0.2, "y": 0.2, "z": 0.6}}
    cells = mixed_cells(df, goals, keep_share=0.1, rounds=25)
    kept = df.groupBy("source", "topic").agg(F.sum("tokens").alias("n")).join(cells.drop("tokens"), ["source", "topic"]).collect()
    total = sum(r.n for r in df.groupBy().agg(F.sum("tokens").alias("n")).collect())
    for margin, goal in goals.items():
        for value, share in goal.items():
            got = sum(r.n * r.probability for r in kept if r[margin] == value) / (0.1 * total)
            assert got == pytest.approx(share, abs=1e-6)


def test_raking_with_cells_that_give_all_they_have(spark):
    """At the parameters of the query: full cells are made up for by the others, unreachable goals are all there is."""
    pick = random.Random(6)
    sizes = {"big": 4000, "mid": 500, "rare": 12}
    rows = [(s, t, v, pick.randint(1, n)) for s, n in sizes.items() for t in "xyz" for v in ("en", "fr") for _ in range(5)]
    df = spark.createDataFrame(rows, "source string, topic string, lang string, tokens bigint")
    cells = mixed_cells(df, {"source": TEMPER, "topic": TEMPER, "lang": TEMPER}, KEEP_SHARE, ROUNDS)
    total = sum(r[3] for r in rows)
    assert any(r.probability == 1 for r in cells.collect())
    for margin in ("source", "topic", "lang"):
        for r in margin_report(cells, margin).collect():
            assert r.got == pytest.approx(r.goal, rel=0.01) and r.got <= r.most * (1 + 1e-9)
            kept = sum(c.tokens * c.probability for c in cells.where(F.col(margin) == r.value).collect())
            assert kept == pytest.approx(r.got * KEEP_SHARE * total)
    unmet = {r.value: r for r in margin_report(cells, "source").collect()}["rare"]
    assert unmet.goal == pytest.approx(unmet.most) and unmet.got == pytest.approx(unmet.most, rel=0.01)


def test_mixing_takes_any_names(spark):
    names = ["probability", "__mix_tokens", "__mix_kept", "tokens", "weight", "cap", "a.b"]
    rows = [(k, prose(k, 30), "en", "s", *([k] * len(names))) for k in range(40)]
    layout = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names)
    df = spark.createDataFrame(rows, layout)
    out = mixed_sample(df)
    assert out.columns == df.columns and 0 < out.count() < 40
    assert {tuple(r) for r in out.collect()} < set(rows)


def test_pipeline_on_awkward_and_empty_tables(spark, tmp_path):
    """Every stage takes nulls, empty texts, repeated rows and clashing names; ids of kept rows are what was packed."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    rows = awkward_rows() + [(1000 + i, prose(900 + i, 60 + i)) + (None,) * 6 for i in range(40)]
    labels = [(r[0], int(bool(r[1]) and len(r[1]) > 40), 0) for r in rows if r[0] is not None] + [(1, None, None), (None, 1, 1)]
    for name, some in (("full", rows), ("none", [])):
        folder = str(tmp_path / name)
        table(spark, some).withColumnRenamed("uid", "probability").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).orderBy("doc_id", "start").collect()
        plain, texts = Tokenizer.from_file(PATH), {r[0]: r[1] or "" for r in some}
        got = {}
        for p in out:
            got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
        assert all(ids == plain.encode(texts[doc], add_special_tokens=False).ids + [1] for doc, ids in got.items())
        assert len({re.sub(r"[\x20\x09-\x0D]", "", texts[doc]) for doc in got}) == len(got)
    assert not got


def test_statistics_do_not_depend_on_the_neighbours():
    import pyarrow as pa

    texts = [r[1] for r in awkward_rows()] + ["a a a a b\n" * 5, "UP!! DOWN!!\nx | y | z"]
    whole = statistics(pa.array(texts, pa.string()))
    one = np.concatenate([statistics(pa.array([t], pa.string())) for t in texts])
    assert whole.shape == (len(texts), len(NAMES)) and np.array_equal(whole, one)
    assert not whole[texts.index("")].any() and np.isfinite(whole).all()
    assert statistics(pa.array([], pa.string())).shape == (0, len(NAMES))


def test_parts_of_a_batch_read_like_single_texts():
    """Every helper over Arrow columns gives the same for a part of a batch as for a text alone."""
    import pyarrow as pa

    from roadledger.llm.packing import token_ids
    from roadledger.llm.shingles import shingle_sets, slices, word_lists

    texts = [t or "" for t in (r[1] for r in awkward_rows())] + odd_texts()[:50] + ["ÄÖÜ Straße É. x", "Ünï, ÇA."]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], names=["text", "n"])
    parts = list(slices([batch], "text", 500))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(len(texts))) and len(parts) > 20
    for run in (lambda a: list(statistics(a)), lambda a: list(shingle_sets(*word_lists(a))), lambda a: token_ids(a, PATH)):
        together = [x for p in parts for x in run(p.column("text"))]
        alone = [run(pa.array([t]))[0] for t in texts]
        assert all(np.array_equal(x, y) for x, y in zip(together, alone, strict=True))


def test_trees():
    random = np.random.default_rng(5)
    x = random.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > -0.2)).astype(float)
    forest = fit_forest(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    assert np.allclose(fit_forest(x[:5], np.ones(5)).score(x), 0.999)
    assert np.allclose(fit_forest(x[:0], y[:0]).score(x[:3]), 0.5)

    def walk(row):
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x[:50]), [walk(r) for r in x[:50]])


def test_quality_cases(spark):
    junk = [(500 + i, " ".join(w + "###" for w in prose(i, 60).split())) + (None,) * 6 for i in range(40)]
    good = [(600 + i, prose(i, 60)) + (None,) * 6 for i in range(40)]
    docs = table(spark, awkward_rows() + junk + good)
    labels = spark.createDataFrame([(r[0], 0, 0) for r in junk] + [(r[0], 1, 0) for r in good] + [(500, 0, 1), (None, 1, 0),
                                   (601, None, 0)], "doc_id bigint, quality int, toxic int")
    out = quality_scores(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id >= 500:
            assert r.predicted == int(r.doc_id >= 600)
    assert accepted(docs, labels).columns == COLUMNS
    assert accepted(table(spark, []), labels).count() == 0
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert len(fit_quality(docs, labels, fit_rows=10).feature) <= 60


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables are not here")
def test_quality_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    out = quality_scores(docs, labels).where("held_out").join(labels, "doc_id").groupBy("quality").agg(
        F.avg("predicted").alias("kept")).collect()
    kept = {r.quality: r.kept for r in out}
    assert kept[1] > 0.99 and kept[0] < 0.1
