"""One query per operator over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadledger.llm.chat import (MARKS, OTHER_CLOSE, OTHER_MID, OTHER_OPEN, START, TURN, format_chats, read_loss,
                                 read_turns)
from roadledger.llm.common import ADDRESS, documents
from roadledger.llm.conversation_repair import damaged, repair_conversations, repaired_digests
from roadledger.llm.exact_dedup import exact_classes
from roadledger.llm.html_extract import main_text
from roadledger.llm.mixing import KEEP_SHARE, ROUNDS, SEED, TEMPER, mixture
from roadledger.llm.near_dedup import near_groups
from roadledger.llm.packing import pack
from roadledger.llm.personal import (ACCEPT_PATTERN, ACCEPT_VALUE, CARD_DIGITS, KINDS, PHONE_DIGITS, REACH, ROUNDS as BOOT_ROUNDS,
                                     SEED_SCORE, SLOT_DIGITS, SUPPORT, listed as spans_listed, personal_spans)
from roadledger.llm.quality import quality_scores
from roadledger.llm.repeats import remove_repeats
from roadledger.llm.secrets import listed, scan_secrets
from roadledger.llm.spelling import spelling_groups, word_counts
from roadledger.llm.topk import top_k

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op1_exact_dedup", r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS normal FROM documents),
s AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size
  FROM d WINDOW w AS (PARTITION BY normal ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256 FROM s""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(documents(spark, sf_dir)).drop(*ADDRESS)


@query("op6_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).drop("stays", *ADDRESS)


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def _mix_sql() -> str:
    margins = ["source", "lang", "topic"]
    steps, last = [], "c0"
    for number in range(ROUNDS):
        for m in margins:
            new = f"c{number}_{m}"
            steps.append(f"""{new} AS (SELECT * EXCLUDE (weight, held, filled), least(cap, weight * CASE WHEN held <= 0 THEN 0
    WHEN goal_{m} <= held THEN goal_{m} / held WHEN weight >= cap OR held - filled <= 0 THEN 1
    ELSE (goal_{m} - filled) / (held - filled) END) AS weight
  FROM (SELECT *, sum(weight) OVER (PARTITION BY {m}) AS held,
    sum(CASE WHEN weight >= cap THEN weight ELSE 0 END) OVER (PARTITION BY {m}) AS filled FROM {last}))""")
            last = new
    goals = [f"""r_{m} AS (SELECT {m}, least(pow(sum(weight), {TEMPER}) / sum(pow(sum(weight), {TEMPER})) OVER (), sum(cap)) AS goal
  FROM cc GROUP BY {m})""" for m in margins]
    total = "least(" + ", ".join(f"(SELECT sum(goal) FROM r_{m})" for m in margins) + ")"
    joined = " ".join(f"JOIN (SELECT {m}, goal * {total} / (SELECT sum(goal) FROM r_{m}) AS goal_{m} FROM r_{m}) USING ({m})" for m in margins)
    return f"""WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, 'icensed under ') OR contains(t, 'eleased under ') THEN 'licensed'
    WHEN regexp_matches(t, '[0-9]{{8}}') THEN 'record' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '{SEED}'), 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cc AS (SELECT *, weight / {KEEP_SHARE} AS cap FROM (SELECT source, lang, topic, sum(tokens) AS tokens,
  sum(tokens) / sum(sum(tokens)) OVER () AS weight FROM d GROUP BY ALL)),
{", ".join(goals)}, c0 AS MATERIALIZED (SELECT * FROM cc {joined}), {", ".join(steps)},
p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0, weight / cap) ELSE {KEEP_SHARE} END AS p FROM {last})
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability, u < p AS kept
FROM d JOIN p USING (source, lang, topic)"""


@query("op2_mixing", _mix_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(documents(spark, sf_dir)).select(
        "__mix_row.doc_id", *[F.col(f"__mix_{c}").alias(c) for c in ("source", "lang", "topic", "tokens")],
        F.round("__mix_probability", 6).alias("probability"), F.col("__mix_kept").alias("kept"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


_ROLE_MARKS = "CASE role " + " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in MARKS.items()) + (
    f" ELSE {len(OTHER_OPEN) + len(OTHER_MID) + len(OTHER_CLOSE)} + length(role) END")


@query("op7_chat_format", rf"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST({len(START)} + sum(length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g'))
    + CASE WHEN role IS DISTINCT FROM before THEN {_ROLE_MARKS} ELSE {len(TURN)} END) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql("""SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'),
        (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    turns = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    chats = format_chats(turns).select("*", read_turns(F.col("formatted")).alias("read"),
                                       read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id", F.size("read").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query("op9_html_extract")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(documents(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op8_topk", """WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(documents(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query("op5_repeats")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: CRC-32 of a list of byte values, and the UTF-8 bytes of a string, in DuckDB.
_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([CAST(k AS BIGINT) FOR k IN range(8)],
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT)) AS c FROM range(256) r(i)))"""


def _crc(text: str) -> str:
    """CRC-32 of a string expression; ``crc_table`` must be in scope."""
    octets = f"[CAST('0x' || hex(encode({text}))[2 * k + 1:2 * k + 2] AS BIGINT) FOR k IN range(strlen({text}))]"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _repair_sql() -> str:
    """States: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a; each has its best audit behind nine digits of cost."""
    def more(column: str, cost: int | str, edit: str) -> str:
        return f"printf('%09d', CAST({column}[1:9] AS INT) + {cost}) || {column}[10:] || '{edit}'"

    insert_u = f"least(s2, {more('s0', 2, 'I')}, {more('s1', 2, 'I')}, {more('s3', 2, 'I')})"
    insert_a = f"least(s3, {more('s2', 2, 'I')})"
    cut = "(fault = 3)::INT"
    keep = f"fault IN (0, 3) AND initial = "
    rerole = "fault IN (0, 3) AND initial <> "
    behind_u = ", ".join(f"CASE WHEN {keep}'u' THEN {more(s, cut, 'K')} WHEN {rerole}'u' THEN {more(s, '2 + ' + cut, 'R')} END"
                         for s in ("s0", "s1", "s3"))
    behind_a = f"CASE WHEN {keep}'a' THEN {more('s2', cut, 'K')} WHEN {rerole}'a' THEN {more('s2', '2 + ' + cut, 'R')} END"
    inserted = f"""(SELECT * REPLACE ({insert_a} AS s3) FROM (SELECT * REPLACE ({insert_u} AS s2) FROM
      (SELECT * REPLACE ({insert_a} AS s3) FROM (SELECT * REPLACE ({insert_u} AS s2) FROM ROWS))))"""
    return f"""WITH RECURSIVE {_CRC_TABLE},
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
k AS (SELECT o.*, {_crc('name')} % 20 AS kind FROM o, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN ''
  WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k WHERE kind <> 0),
n AS (SELECT *, row_number() OVER w AS i, role[1:1] AS initial, lag(role[1:1]) OVER w AS before FROM (SELECT *, sha256(length(role) || ':' || role || text) AS same FROM d)
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, same)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM n),
r AS (SELECT conv_id, 0 AS i, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3
    FROM f GROUP BY conv_id
  UNION ALL SELECT conv_id, CAST(i AS INT), {more('s0', 3, 'D')}, least({more('s1', 3, 'D')}, CASE WHEN {keep}'s' THEN {more('s0', cut, 'K')} END),
    least({more('s2', 3, 'D')}, {behind_u}), least({more('s3', 3, 'D')}, {behind_a})
    FROM (SELECT x.* EXCLUDE (i), f.i, f.fault, f.initial FROM {inserted.replace('ROWS', 'r')} x JOIN f ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = x.i + 1)),
e AS (SELECT conv_id, least(s0, s3) AS best FROM {inserted.replace('ROWS', '(SELECT * FROM r QUALIFY i = max(i) OVER (PARTITION BY conv_id))')}),
a AS (SELECT conv_id, best[10:] AS audit, CAST(best[1:9] AS BIGINT) AS cost FROM e),
u AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS p, audit FROM a),
v AS (SELECT conv_id, p, audit[p] AS edit, CAST(sum((audit[p] <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS BIGINT) AS i FROM u),
w AS (SELECT v.conv_id, p, edit, f.role, f.text, row_number() OVER z AS q,
  first_value(CASE WHEN edit = 'K' THEN f.initial END) OVER z AS opening
  FROM v LEFT JOIN f ON v.conv_id IS NOT DISTINCT FROM f.conv_id AND v.i = f.i AND edit <> 'I' WHERE edit <> 'D'
  WINDOW z AS (PARTITION BY v.conv_id ORDER BY p)),
g AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (q + (opening IS NOT DISTINCT FROM 's')::INT) % 2 = 1 THEN 'user'
  ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS lines FROM w GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
  count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) s LEFT JOIN c ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN a ON s.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN g ON s.conv_id IS NOT DISTINCT FROM g.conv_id"""


@query("op13_conversation_repair", _repair_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = documents(spark, sf_dir, "conversations")
    repaired, reports = repair_conversations(damaged(turns))
    digests = repaired_digests(repaired)
    named = turns.select("conv_id").distinct()
    found = named.join(reports, named["conv_id"].eqNullSafe(reports["conv"]), "left").drop("conv")
    found = found.join(digests, found["conv_id"].eqNullSafe(digests["conv"]), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select("conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_spelling_variants", rf"""WITH RECURSIVE {_CRC_TABLE},
o AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
r AS (SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM o),
c AS (SELECT doc || ':' || run AS name, run, count(*) AS n FROM r GROUP BY doc, run),
h AS (SELECT run, n, {_crc('name')} AS h FROM c, crc_table),
w AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w GROUP BY word HAVING sum(n) >= 3 AND length(word) >= 5),
s AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT a.word, b.word AS other, b.n AS other_n FROM s a JOIN s b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    AND length(a.word) = length(b.word)
  UNION SELECT v.word, s.word, s.n FROM v JOIN s ON s.rest = v.word
  UNION SELECT s.word, v.word, v.n FROM v JOIN s ON s.rest = v.word),
b AS (SELECT word, count(*) AS n_near, max(other_n) AS top, arg_min(other, (-other_n, other)) AS other FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * v.n THEN other END AS form,
  CASE WHEN top >= 2 * v.n THEN top END AS form_n FROM v LEFT JOIN b USING (word)),
t AS (SELECT word, word AS tip, 0 AS far FROM f UNION ALL SELECT t.word, f.form, far + 1 FROM t JOIN f ON f.word = t.tip WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(tip, far) AS root FROM t GROUP BY word) USING (word)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(documents(spark, sf_dir), every=97))


def _personal_sql() -> str:
    """The same rules, graph and rounds; patterns without the devices that keep them linear in Spark."""
    local, label = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
    plain = {"email": rf"{local}+@{label}+(\.{label}+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
             "at": rf"{local}+(?:@|\x20?[\[(]at[\])]\x20?){label}+(?:\.{label}+)*",
             "num": r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9])+"}
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    luhn = (f"list_sum([CASE WHEN k % 2 = 1 THEN CAST(reverse({digits})[k] AS INT) ELSE (2 * CAST(reverse({digits})[k] AS INT)) // 10 "
            f"+ (2 * CAST(reverse({digits})[k] AS INT)) % 10 END FOR k IN range(1, length({digits}) + 1)]) % 10 = 0")
    part = "regexp_replace(p, '^0+', '')"
    tests = {"email": "true", "card": f"length({digits}) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND {luhn}",
             "phone": f"length({digits}) BETWEEN {PHONE_DIGITS[0]} AND {PHONE_DIGITS[1]}",
             "ip": f"len([p FOR p IN string_split(hit, '.') IF length({part}) > 3 OR coalesce(TRY_CAST({part} AS INT), 0) > 255]) = 0"}
    scans = " UNION ALL ".join(f"SELECT doc_id, '{name}' AS name, string_split_regex(t, '{pattern}') AS gaps, "
                               f"regexp_extract_all(t, '{pattern}') AS hits FROM d" for name, pattern in plain.items())
    base = " ".join(f"WHEN name = '{kind}' THEN CASE WHEN {tests[kind]} THEN '{kind}' ELSE '' END" for kind in KINDS)
    slot = " ".join(f"WHEN name = '{'at' if kind == 'email' else 'num'}' AND regexp_full_match(hit, '{plain[kind]}') AND {tests[kind]} THEN '{kind}'"
                    for kind in KINDS)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "[w FOR w IN string_split_regex(" + lower + ", '[\\x20\\x09-\\x0D]+') IF w <> '']"
    names = ", ".join(f"'{kind}'" for kind in KINDS)
    steps, last = [], "seeds"
    for k in range(BOOT_ROUNDS):
        steps.append(f"""p{k} AS (SELECT pattern, kind, CAST(floor(-1000 * ln((1000 - c) / 1000)) AS BIGINT) AS evidence FROM (
    SELECT pattern, kind, count(*) AS support, floor(sum(score) / (any_value(held) + 1)) AS c
    FROM g JOIN {last} USING (value) JOIN (SELECT pattern, count(*) AS held FROM g GROUP BY pattern) USING (pattern) GROUP BY pattern, kind)
  WHERE support >= {SUPPORT} AND c >= {ACCEPT_PATTERN}),
v{k} AS (SELECT * FROM seeds UNION ALL SELECT value, s.kind, s.score FROM (SELECT value, max({{'score': score, 'kind': kind}}) AS s FROM (
    SELECT value, kind, CAST(floor(1000 - 1000 * exp(-sum(evidence) / 1000)) AS BIGINT) AS score FROM g JOIN p{k} USING (pattern) GROUP BY value, kind)
  WHERE score >= {ACCEPT_VALUE} AND value NOT IN (SELECT value FROM seeds) GROUP BY value))""")
        last = f"v{k}"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({scans}),
x AS (SELECT doc_id, name, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM s WHERE len(hits) > 0),
y AS (SELECT doc_id, name, hits[i] AS hit, right(gaps[i], {REACH}) AS l, left(gaps[i + 1], {REACH}) AS r,
  CAST(sum(length(gaps[i]) + length(hits[i])) OVER (PARTITION BY doc_id, name ORDER BY i) AS BIGINT) AS stop FROM x),
m AS (SELECT *, stop - length(hit) AS start, CASE {base} {slot} END AS kind FROM y),
b AS (SELECT * FROM m WHERE name IN ({names}) AND kind <> ''),
z AS (SELECT *, EXISTS (SELECT 1 FROM b WHERE b.doc_id = m.doc_id AND b.start < m.stop AND b.stop > m.start) AS covered,
    name || ' ' || CASE WHEN name = 'num' THEN regexp_replace(hit, '[^0-9.]', '', 'g') ELSE {lower.format('hit')} END AS value,
    {words.format('l')} AS lw, {words.format('r')} AS rw
  FROM m WHERE name = 'at' OR name = 'num' AND length({digits}) >= {SLOT_DIGITS}),
g AS (SELECT DISTINCT pattern, value FROM (
    SELECT name || ' ' || lw[-2] || ' ' || lw[-1] || ' _' AS pattern, value FROM z WHERE kind IS NOT NULL OR NOT covered
    UNION ALL SELECT name || ' ' || lw[-1] || ' _ ' || rw[1], value FROM z WHERE kind IS NOT NULL OR NOT covered) WHERE pattern IS NOT NULL),
seeds AS (SELECT value, min(kind) AS kind, CAST({SEED_SCORE} AS BIGINT) AS score FROM z WHERE kind IS NOT NULL GROUP BY value),
{", ".join(steps)},
a AS (SELECT doc_id, kind, start, stop, true AS base FROM b
  UNION ALL SELECT z.doc_id, k.kind, start, stop, false FROM z JOIN {last} k USING (value) WHERE z.kind IS NULL AND NOT covered),
e AS (SELECT doc_id, {", ".join(f"count(*) FILTER (base AND kind = '{kind}') AS n_{kind}" for kind in KINDS)},
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY list_position([{names}], kind), start, stop, base) FILTER (base) AS bases,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY list_position([{names}], kind), start, stop, base) AS spans FROM a GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in KINDS)}, sha256(coalesce(bases, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN e USING (doc_id)"""


@query("op11_personal_data", _personal_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(documents(spark, sf_dir)).withColumn("base", F.filter("spans", lambda s: s["base"]))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(kind) for kind in KINDS], F.sha2(spans_listed(F.col("base")), 256).alias("base_sha256"),
                        spans_listed(F.col("spans")).alias("spans"))
