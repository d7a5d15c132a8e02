"""Spelling variants against all pairs; signatures; noise."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from cases import awkward_rows, table
from roadledger.llm import spelling
from roadledger.llm.spelling import letter_parts, near_words, signatures, spelling_groups, word_counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counted(rows, every=97):
    held = Counter()
    for ident, text in ((r[0], r[1]) for r in rows):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            held[run if every is None or h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in held.items() if n >= 3 and len(w) >= 5}


def by_hand(words):
    out = []
    for word, n in words.items():
        near = [other for other in words if one_edit(word, other)]
        form = min(near, key=lambda other: (-words[other], other), default=None)
        form = form if form and words[form] >= 2 * n else None
        out.append([word, form, n, len(near), words[form] if form else None])
    forms = {row[0]: row[1] for row in out}
    rows = []
    for word, form, n, n_near, form_n in out:
        root = word
        while forms[root]:
            root = forms[root]
        rows.append((word, form, root, n, n_near, form_n))
    return sorted(rows)


def variants(seed):
    pick = random.Random(seed)
    base = ["harbour", "engine", "überall", "straße", "ÉTUDE", "éééée", "aaaaa", "aaaaaaaa"]
    words = []
    for word in base * 12:
        for _ in range(pick.randrange(4)):
            k = pick.randrange(len(word))
            words += [word[:k] + word[k + 1:], word[:k] + pick.choice("aeéß") + word[k:], word[:k] + pick.choice("nrÀ") + word[k + 1:]] * pick.randrange(1, 4)
        words += [word] * pick.randrange(6)
    pick.shuffle(words)
    return [(k, " ".join(words[k::40]) + pick.choice([".", "7", "\n", "×", "ÿ"]), None, None, None, None, None, None) for k in range(40)]


def test_groups(spark):
    rows = awkward_rows() + variants(5)
    for every in (97, 3):
        words = word_counts(table(spark, rows).repartition(3), every=every)
        assert {r.word: r.n for r in words.collect()} == counted(rows, every)
        found = spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n").collect()
        assert sorted(map(tuple, found)) == by_hand(counted(rows, every))
        assert any(r.form != r.root for r in found if r.form)
    assert spelling_groups(word_counts(table(spark, []))).count() == 0
    assert spelling_groups(word_counts(table(spark, [(1, None) + (None,) * 6]))).count() == 0


def test_no_pair_is_lost_whatever_the_parts(spark):
    words = counted(variants(8), None)
    rows = spark.createDataFrame(list(words.items()), "word string, n bigint")
    pairs = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for parts in (3, 5, 8):
        assert {(r.a, r.b) for r in near_words(rows, parts).collect()} == pairs
    held = letter_parts(rows, 8)
    assert sorted("".join(held)) == sorted(set("".join(words)))
    assert rows.select(F.size(signatures(F.col("word"), held))).first()[0] == 28


def test_nothing_is_broadcast_by_its_planned_size(spark, monkeypatch):
    words, plans, write = counted(variants(8), None), [], spelling.written

    def kept(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    rows = write(spark.createDataFrame(list(words.items()), "word string, n bigint"), "words")
    monkeypatch.setattr(spelling, "written", kept)
    found = spelling_groups(rows)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, found.select("word", "form", "root", "n", "n_near", "form_n").collect())) == by_hand(words)
    assert sum("SortMergeJoin" in plan for plan in plans) >= 4 and not any("Broadcast" in plan for plan in plans)
