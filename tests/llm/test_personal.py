"""Personal data: base spans against plain patterns, the search for unseen identifiers, linear scans."""

import re
import time

import pytest

from cases import awkward_rows, prose, table
from roadledger.llm.common import addressed
from roadledger.llm.personal import KINDS, bootstrapped, mentions, personal_spans, values_of

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_by_hand(text):
    return [(kind, m.start(), m.end()) for kind in KINDS for m in re.finditer(PLAIN[kind], text or "") if holds(kind, m.group())]


HARD = ["a@b.c_d@e.f", "x@y x@y.z. a.b@c-d.e-f..g@h.i", "@@a@a.b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0.0.0.0000255",
        "4111 1111 1111 1111 4111111111111111, 4111-1111-1111-1111 4111  1111 1111 1111", "+1 (743) 555-3824) +1-2 +49 30 123456789012345",
        "++12345678 +1.2.3.4.5.6.7.8", "é@é.com mail é+12 345 678é \U0001F600a@b.cd 10.0.0.1\U0001F600", "0" * 16, "9" * 400,
        "12345678abc@x.com (12345678abc@x.com", "a" * 300 + "@" + "b." * 300, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8"]


def test_base_spans(spark):
    rows = awkward_rows() + [(100 + k, text, None, None, None, None, None, None) for k, text in enumerate(HARD)]
    found = personal_spans(table(spark, rows)).collect()
    assert sorted([(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.base]) for r in found], key=repr) == sorted(
        [(r[0], base_by_hand(r[1])) for r in rows], key=repr)
    assert personal_spans(table(spark, [])).count() == 0


def numbered(k):
    return f"+1 (2{k:02d}) 555-01{k:02d}"


def test_contexts_lead_to_unseen_identifiers(spark):
    seeds = [f"{prose(k, 5)} reach me by phone {numbered(k)} thanks {prose(k, 5)}" for k in range(10, 22)]
    unseen = ["Reach me BY PHONE (343) 555-0199 thanks", "they said by phone 20 7946 0018 20, thanks"]
    # The value of a seed, written as no rule takes it, in a context that says nothing.
    again = ["odd place 1 (210) 555-0110 here"]
    clean = ["record 20240115 was kept", "by phone she heard", "order 99 123 456 789 of today", "by letter 555 0101 222 thanks"]
    rows = [(k, text, None, None, None, None, None, None) for k, text in enumerate(seeds + unseen + again + clean)]
    found = {r.doc_id: r for r in personal_spans(table(spark, rows)).collect()}
    for k, text in enumerate(seeds):
        assert [s.base for s in found[k].spans] == [True]
    for k in range(len(seeds), len(seeds) + 3):
        (span,) = found[k].spans
        assert (span.kind, span.base) == ("phone", False) and re.fullmatch(r"[(0-9][0-9() -]+[0-9]", rows[k][1][span.start:span.end])
    assert not any(found[k].spans for k in range(len(seeds) + 3, len(rows)))


def test_later_rounds_go_further(spark):
    """Values that only a found value's context leads to."""
    first = [f"call my desk at {numbered(k)} soon" for k in range(10, 70)]
    middle = [f"my desk at 555 01 {k} and my cell is x" for k in range(30, 42)] + [f"so my cell is 555 01 {k} ok" for k in range(30, 42)]
    last = ["so my cell is 777 88 99 ok"]
    rows = [(k, text, None, None, None, None, None, None) for k, text in enumerate(first + middle + last)]
    slots = values_of(mentions(addressed(table(spark, rows))).where("name = 'num'"))
    slots.write.parquet(path := str(spark.conf.get("spark.checkpoint.dir")) + "/later-rounds")
    slots = spark.read.parquet(path)
    assert "num 7778899" not in {r.value for r in bootstrapped(slots, 1).collect()}
    assert "num 7778899" in {r.value for r in bootstrapped(slots, 3).collect()}


@pytest.mark.parametrize("piece", ["x", "1", "1.", "1 ", "a@", "a.", "+1", "(", "[at]", "a@b."])
def test_long_runs_are_scanned_in_time(spark, piece):
    """No pattern goes back over a long run, and none recurses into it."""
    start = time.time()
    (row,) = personal_spans(table(spark, [(1, piece * (400_000 // len(piece)) + " me@here.org", None, None, None, None, None, None)])).collect()
    assert time.time() - start < 60
    assert ("email", True) in [(s.kind, s.base) for s in row.spans]
