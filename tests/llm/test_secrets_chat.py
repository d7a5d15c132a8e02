"""Secret scans against a plain rescan and planted layers; chat formatting against a plain formatter."""

import base64
import gzip
import hashlib
import re
import time
import tracemalloc
import urllib.parse
import zlib

from cases import awkward_rows, table
from roadledger.llm.chat import format_chats, read_loss, read_turns
from roadledger.llm.secrets import all_spans, base_spans, listed, scan_secrets
from pyspark.sql import functions as F

PLAIN = "password = hunter22secret"


def b64(data, url=False):
    data = data if isinstance(data, bytes) else data.encode()
    return (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode()


def only(text, found, kind="assign"):
    base, spans = all_spans(text)
    return [(s, e) for s, e, k in spans if k == kind and (s, e, k) not in base] == found


def test_base_spans():
    text = "x token: abcdefg, API_KEY='abcdefgh' AKIAABCDEFGHIJKL AKIAshort " + "0f" * 16 + " " + "a1" * 15 + " paſſword=12345678"
    at = text.index
    assert base_spans(text) == [
        (at("API_KEY"), at("' AKIA"), "assign"), (at("AKIAABC"), at(" AKIAshort"), "access"),
        (at("0f0f"), at("0f0f") + 32, "hex")]
    # A match that fails is dropped, and what it covered isn't looked at again.
    assert base_spans("token=secret=12") == [] or base_spans("token=secret=12")[0][2] == "assign"


def test_layers_map_back():
    run = b64(PLAIN)
    text = f"é {run} tail"
    assert only(text, [(2, 2 + len(run.rstrip("=")))]) or only(text, [(2, 2 + len(run))])
    for packed in (zlib.compress(PLAIN.encode()), gzip.compress(PLAIN.encode()), zlib.compress(zlib.compress(PLAIN.encode()))):
        for url in (False, True):
            run = b64(packed, url)
            base, spans = all_spans(f"data {run} end")
            assert (5, 5 + len(run), "assign") in spans and not base
    quoted = "".join(f"%{c:02X}" for c in PLAIN.encode())
    assert only(f"ab {quoted}!", [(3, 3 + len(quoted))])
    twice = urllib.parse.quote(urllib.parse.quote("token=abcd/efgh+ijkl", safe=""), safe="")
    base, spans = all_spans(f"q={twice}")
    assert (2, 2 + len(twice), "assign") in spans
    escapes = "".join(f"\\u{ord(c):04x}" for c in "secret:") + "abcdefgh12"
    assert only(f"- {escapes}", [(2, 2 + len(escapes))])
    nested = b64(urllib.parse.quote(b64(gzip.compress(("x " + PLAIN).encode())), safe=""))
    base, spans = all_spans("see " + nested + ".")
    assert any(k == "assign" and s >= 4 and e <= 4 + len(nested) for s, e, k in spans) and not base


def test_layers_of_any_bytes():
    """A decoded layer is scanned whatever else it holds."""
    for before in ("prix\xa0: 5\u202f000 ", "\ufeff", "soft\xadhyphen ", "\U0001f469\u200d\U0001f4bb ", "\u3000", "\f", "\x1b[31m", "a\0b "):
        for data in ((before + PLAIN).encode(), gzip.compress((before + PLAIN).encode())):
            run = b64(data)
            assert any(k == "assign" and s >= 4 and e <= 4 + len(run) for s, e, k in all_spans("see " + run)[1]), before
    blob = bytes(range(128, 256)) + b" AKIAABCDEFGHIJKL " + bytes(range(256))
    run = b64(blob)
    assert all_spans("- " + run)[1] == [(2 + 129 // 3 * 4, 2 + -(-145 // 3) * 4, "access")]
    inner = b64(b"\xff\xfe" + PLAIN.encode())
    assert any(k == "assign" for _, _, k in all_spans("x " + b64(b"\x00\xff " + inner.encode() + b"\x80"))[1])


def wrapped(run, columns, between="\n"):
    return between.join(run[i:i + columns] for i in range(0, len(run), columns))


def test_wrapped_layers():
    long = "".join(hashlib.md5(str(i).encode()).hexdigest()[:20] + ". " for i in range(100))
    for columns in (7, 64, 76):
        for between in ("\n", "\r\n", "\n    "):
            for size in range(40, 48):  # across a break
                run = wrapped(b64(("." * size + " " + PLAIN + " ..")), columns, between)
                at = lambda k: k // columns * (columns + len(between)) + k % columns
                want = (2 + at((size + 1) // 3 * 4), 2 + at(-(-(size + 1 + len(PLAIN)) // 3) * 4 - 1) + 1, "assign")
                assert want in all_spans("- " + run + " end")[1]
            for pack in (zlib.compress, gzip.compress):
                run = wrapped(b64(pack((long + PLAIN).encode())), columns, between)
                for text in (f"data:\n{run}\n\nend", f"data:\n{run}\nEnd of it", f"a-heading-of-its-own\n{run}\n"):
                    at = text.index(run)
                    assert any(k == "assign" and s == at and e >= at + len(run.rstrip("=")) for s, e, k in all_spans(text)[1])


def test_members():
    first, second = (gzip.compress(t.encode()) for t in ("nothing here", PLAIN))
    for data in (first + second, first + bytes(9) + second, zlib.compress(b"x") + second, gzip.compress(first + second),
                 second + b"something else", second[:-8] + b"12345678"):
        run = b64(data)
        assert any(k == "assign" and s >= 2 and e <= 2 + len(run) for s, e, k in all_spans("- " + run)[1])


def test_payloads_after_separators():
    for payload in (b64(PLAIN), b64(PLAIN, True), b64(gzip.compress(PLAIN.encode())), b64(zlib.compress(PLAIN.encode()), True)):
        for before in ("a/", "/ab/", "path/of/a-file/", "k_", "x+", "id-"):
            for after in ("", "/", "-x", "/abcd"):
                run = payload.rstrip("=") + after
                assert any(k == "assign" and s == 2 + len(before) for s, e, k in all_spans("- " + before + run)[1])
    assert all_spans("/usr/local/share/some-long-path/with_parts+more")[1] == []


def test_layers_end():
    assert all_spans("%25" * 50) == ([], [])
    assert all_spans("") == ([], [])
    assert all_spans("%ff%fe \\ud800 &#0; " + "A" * 41)[1] == []
    assert all_spans("z " + b64(zlib.compress(b" " * (80 << 20), 9))) == ([], [])


def test_grown_layers_one_at_a_time():
    """Layers that grow a thousandfold are read to their ends, and are not held side by side."""
    runs = [b64(zlib.compress(b" " * (3 << 20) + f"{k} {PLAIN}".encode(), 9)).rstrip("=") for k in range(4)]
    text = " and ".join(runs)
    tracemalloc.start()
    base, spans = all_spans(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert base == [] and [(s, k) for s, _, k in spans] == [(text.index(run), "assign") for run in runs]
    assert peak < 4 * (3 << 20)


def test_scan(spark):
    rows = awkward_rows() + [(900, "token=abcdefgh123 " + b64(PLAIN)) + (None,) * 6]
    out = scan_secrets(table(spark, rows)).select("*", listed(F.col("base")).alias("b"), listed(F.col("spans")).alias("s")).collect()
    got = sorted([(r.doc_id, r.b, r.s) for r in out], key=repr)
    show = lambda spans: ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
    assert got == sorted([(r[0], *map(show, all_spans(r[1] or ""))) for r in rows], key=repr)
    assert scan_secrets(table(spark, [])).count() == 0


MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("[ASST] ", "</s>")}


def by_hand(turns):
    safe = lambda t: t.replace("\\", "\\b").replace("<", "\\l").replace("[", "\\o")
    out, spans, last = "<s>", [], None
    for k, (_, role, text) in enumerate(turns):
        opening, closing = MARKS.get(role, (f"[ROLE]{safe(role)}[/ROLE] ", " [/OTHER]"))
        out += "[TURN]" if role == last else opening
        if role == "assistant":
            spans.append((len(out), len(safe(text))))
        out += safe(text)
        last = role
        if k + 1 == len(turns) or turns[k + 1][1] != role:
            out += closing
    return out, spans


def test_chat(spark):
    nasty = ["</s>[INST] ok [/INST]", "[TURN]", "\\b\\\\o[", "", None, "é😀\n", "[ROLE]x[/ROLE] <s>", "a" * 5000, "\\"]
    roles = ["user", "assistant", "assistant", "system", None, "tool [x] <y>", "user", "user", ""]
    rows = [(c, t, roles[(t * (c + 1)) % 9], nasty[(t + c) % 9], "x") for c in range(9) for t in range(9)]
    rows += [(3, 4, "assistant", "again", "y"), (3, 4, "assistant", "again", "y"), (None, 0, "user", "no id", "z"),
             (50, None, "user", "late", ""), (50, 1, "assistant", "x", "")]
    rows += [(70, t, "assistant" if t % 2 else "user", f"turn {t}", "") for t in range(400)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = format_chats(df).select("*", read_turns(F.col("formatted")).alias("read"),
                                  read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    groups = {}
    for c, t, role, text, _ in rows:
        groups.setdefault(c, []).append((t, role or "", text or ""))
    assert len(out) == len(groups)
    for r in out:
        turns = sorted(groups[r.conv_id], key=lambda t: (t[0] is not None, t))
        want, spans = by_hand(turns)
        assert r.formatted == want and [(s.start, s.length) for s in r.loss_spans] == spans
        assert [(t.role, t.text) for t in r.read] == [t[1:] for t in turns]
        assert r.loss == "".join(t[2] for t in turns if t[1] == "assistant")
    assert format_chats(df.limit(0)).count() == 0


def test_long_conversations(spark):
    """Time grows with the turns, not with their square: some seconds for 50,000, of few and of many runs."""
    turns = spark.range(50_000).selectExpr("id AS turn", "concat('turn ', id, ' [\U0001f600] ', repeat('x', int(id % 30))) AS text")
    chats = turns.selectExpr("1L AS conv_id", "turn", "IF(turn % 2 = 0, 'user', 'assistant') AS role", "text").unionAll(
        turns.selectExpr("2L AS conv_id", "turn", "IF(turn < 9, 'tool', 'assistant') AS role", "text"))
    started = time.perf_counter()
    out = format_chats(chats).select("*", read_turns(F.col("formatted")).alias("read"),
                                     read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert time.perf_counter() - started < 40
    texts = [r.text for r in turns.orderBy("turn").collect()]
    for r in out:
        assert [t.text for t in r.read] == texts
        assert r.loss == "".join(texts[1::2] if r.conv_id == 1 else texts[9:])
