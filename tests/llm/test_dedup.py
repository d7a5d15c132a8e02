"""Exact and near dedup against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cases import LAYOUT, awkward_rows, prose, table
from roadledger.llm.components import components
from roadledger.llm.exact_dedup import exact_classes, exact_dedup
from roadledger.llm.near_dedup import near_dedup, near_groups


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(plain(row[1]), []).append(row)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(m[0], best[0], len(members), hashlib.sha256(text.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [None, lambda text: F.pmod(F.crc32(text.cast("binary")), F.lit(3)).cast("string")])
def test_exact_classes(spark, digest):
    rows = awkward_rows()
    found = exact_classes(table(spark, rows), **({"digest": digest} if digest else {})).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr) == by_hand(rows)
    assert sum(r.kept for r in found) == len({plain(r[1]) for r in rows})


def test_exact_state_goes_on_over_batches(spark, tmp_path):
    rows = awkward_rows()
    table(spark, rows).repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = exact_classes(docs, maxFilesPerTrigger="1").collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr) == by_hand(rows)


def test_exact_dedup_returns_the_columns(spark):
    rows = awkward_rows()
    out = exact_dedup(table(spark, rows))
    assert out.columns == [c.split()[0] for c in LAYOUT.split(", ")]
    assert len(out.collect()) == len({plain(r[1]) for r in rows})
    assert exact_dedup(table(spark, [])).count() == 0


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_by_hand(rows):
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted([(r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)], key=repr)


def chains(n):
    """Texts that drift apart, so that groups hold texts no bucket brings together."""
    words = prose(9, 200).split()
    out = []
    for i in range(n):
        words = words[:]
        words[(i * 17) % 200] = f"edit{i}"
        words[(i * 31 + 5) % 200] = f"more{i}"
        out.append((100 + i, " ".join(words)) + (None,) * 6)
    return out


def test_near_groups(spark):
    rows = awkward_rows() + chains(60)
    out = near_groups(table(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=repr) == near_by_hand(rows)
    groups = {r.component_id if r.n_shingles else ("empty", r.doc_id, i) for i, r in enumerate(out)}
    assert sum(r.stays for r in out) == len(groups)


def crowd(n, seed=4):
    """Edits of one text, most of them too many to be linked to the others."""
    pick, base, out = random.Random(seed), prose(20, 100).split(), []
    for i in range(n):
        words = base[:]
        for place in pick.sample(range(100), pick.randint(0, 8)):
            words[place] = f"w{i}x{place}" if pick.random() < 0.9 else f"shared{pick.randint(0, 3)}"
        out.append((1000 + i, " ".join(words)) + (None,) * 6)
    return out


def test_near_groups_in_a_crowd(spark):
    rows = crowd(260)
    out = near_groups(table(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=repr) == near_by_hand(rows)
    assert 20 < len({r.component_id for r in out}) < 200


def test_near_dedup_edges(spark):
    out = near_dedup(table(spark, awkward_rows()))
    assert out.columns == [c.split()[0] for c in LAYOUT.split(", ")]
    assert near_dedup(table(spark, [])).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 3), (3, 7), (5, 5), (200, 201)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
