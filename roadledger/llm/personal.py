"""Personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Rules with checks find the base spans. They are the seeds of a search for identifiers the rules do not know. Slots are
stretches that look like an address (``at``) or a number (``num``); a slot that passes a rule as a whole is a seed of
that kind. Words around slots make lexical patterns: the two words before one, or the word on either side, with the
slot's type. Patterns and slot values form a graph. Rounds of scoring go over it: a pattern's confidence is the score
of its values over their number plus one, a value's score joins the confidence of its accepted patterns (noisy or),
seeds keep theirs. Scores are whole thousandths, so sums do not depend on their order. What values of the last round
reach ``ACCEPT_VALUE`` adds spans of the pattern's kind, wherever it stands and no base span does; so does a seed's
value that is written in a way the rules do not take. Support counts different values, so copies of a text gain nothing.

Texts are scanned by ``split`` and ``regexp_extract_all``; a running sum of lengths gives the places. The patterns for
Spark start a run of characters at its first one only and give nothing back, so they are linear on any text, and they
find what the plain patterns find. Contexts reach ``REACH`` code points.

Defined results: null text is empty; rows that share an id are rows of their own; an empty table gives no rows; other
columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, dropped, text_of
from roadledger.session import written

KINDS = ["email", "ip", "card", "phone"]
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_AT = r"(?:@|\x20?[\[(]at[\])]\x20?)"
#: (pattern for Spark, what a text must have to be scanned). ``\G`` is the end of the match before.
SCANS = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9](?:[\x20-]?+[0-9]){15}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "at": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++{_AT}[{_LABEL}]++(?:\.[{_LABEL}]++)*+", r"@|[\[(]at[\])]"),
    "num": (r"[+(]?+[0-9](?:[\x20()./-]{0,2}+[0-9])++", r"[0-9](?:[\x20()./-]{0,2}+[0-9]){5}"),
}
#: Digits of a card and of a phone number, and the fewest of a number slot.
CARD_DIGITS, PHONE_DIGITS, SLOT_DIGITS = (16, 19), (8, 15), 6
#: Code points of context on either side.
REACH = 64
#: Rounds of scoring; different values a pattern needs; thousandths from which a pattern and a value are taken.
ROUNDS, SUPPORT, ACCEPT_PATTERN, ACCEPT_VALUE = 3, 3, 700, 750
SEED_SCORE = 1000


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(place: Column) -> Column:
        digit = F.substr(digits, -place, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(place % 2 == 0, double - F.when(double > 9, 9).otherwise(0)).otherwise(digit)

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda total, x: total + x) % 10 == 0


def passes(kind: str, hit: Column) -> Column:
    """Whether a match of the kind's pattern holds what the kind asks for."""
    if kind == "ip":
        parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    count = F.char_length(_digits(hit))
    if kind == "card":
        return F.when(count.between(*CARD_DIGITS), _luhn(_digits(hit))).otherwise(False)
    return count.between(*PHONE_DIGITS) if kind == "phone" else F.lit(True)


def _slot_kind(name: Column, hit: Column) -> Column:
    """The kind a slot belongs to as a whole, if any."""
    rules = [F.when((name == ("at" if kind == "email" else "num")) & F.regexp_like(hit, F.lit(rf"\A(?:{SCANS[kind][0]})\z"))
                    & passes(kind, hit), kind) for kind in KINDS]
    return F.coalesce(*rules)


def _words(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def mentions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every base span and slot of an addressed table: (address, name, start, end, hit, left, right, kind, covered).

    ``kind`` is that of a base span or seed slot, else null; ``covered`` says that a base span overlaps. Written.
    """
    text = text_of(docs, text_col)
    scans = [F.struct(F.lit(name).alias("name"), F.when(F.regexp_like(text, F.lit(asked)), F.split(text, pattern, -1)).alias("gaps"),
                      F.when(F.regexp_like(text, F.lit(asked)), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("hits"))
             for name, (pattern, asked) in SCANS.items()]
    scanned = docs.select(*ADDRESS, F.inline(F.array(*scans))).where(F.size("hits") > 0)

    def mention(hit: Column, i: Column) -> Column:
        before, after = F.get("gaps", i), F.get("gaps", i + 1)
        size = F.char_length(before)
        return F.struct(size.cast("bigint").alias("gap"), hit.alias("hit"),
                        F.substr(before, F.greatest(size - REACH + 1, F.lit(1)), F.lit(REACH)).alias("left"),
                        F.substring(after, 1, REACH).alias("right"))

    each = scanned.select(*ADDRESS, "name", F.posexplode(F.transform("hits", mention)).alias("pos", "m")).select(
        *ADDRESS, "name", "pos", "m.*")
    # All rows of a text are together for both windows; neither holds them in memory.
    so_far = Window.partitionBy(*ADDRESS, "name").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("hit")
    placed = each.repartition(*ADDRESS).withColumn("end", F.sum(F.col("gap") + size).over(so_far)).withColumn(
        "start", F.col("end") - size)
    base = F.col("name").isin(KINDS)
    valid = F.coalesce(*[F.when(F.col("name") == kind, F.when(passes(kind, F.col("hit")), kind).otherwise("")) for kind in KINDS],
                       _slot_kind(F.col("name"), F.col("hit")))
    placed = placed.withColumn("kind", valid).where("kind IS NULL OR kind <> ''")
    enough = (F.col("name") != "num") | (F.char_length(_digits(F.col("hit"))) >= SLOT_DIGITS)
    # A base span overlaps a slot if, of those that start before the slot's end, one ends behind the slot's start.
    event = Window.partitionBy(*ADDRESS).orderBy(F.when(base, F.col("start")).otherwise(F.col("end")), base)
    reached = F.max(F.when(base, F.col("end"))).over(event.rowsBetween(Window.unboundedPreceding, -1))
    return written(placed.where(base | enough).withColumn("covered", ~base & F.coalesce(reached > F.col("start"), F.lit(False)))
                   .drop("pos", "gap"), "mentions")


def _graph(slots: DataFrame) -> DataFrame:
    """Distinct (pattern, value) of all slots, written."""
    left, right = _words(F.col("left")), _words(F.col("right"))
    words = slots.select("name", "value", left.alias("l"), right.alias("r"))
    one, two, onward = F.get("l", F.size("l") - 1), F.get("l", F.size("l") - 2), F.get("r", F.lit(0))
    patterns = F.array(F.concat_ws(" ", F.col("name"), two, one, F.lit("_")), F.concat_ws(" ", F.col("name"), one, F.lit("_"), onward))
    whole = F.array(two.isNotNull(), one.isNotNull() & onward.isNotNull())
    return written(words.select(F.explode(F.filter(F.transform(patterns, lambda p, i: F.when(F.get(whole, i), p)),
                                                   lambda p: p.isNotNull())).alias("pattern"), "value").distinct(), "pattern-values")


def values_of(slots: DataFrame) -> DataFrame:
    """``slots`` with ``value``: the slot's type, and its digits and points or its lower-cased text."""
    lowered = F.translate("hit", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return slots.withColumn("value", F.concat("name", F.lit(" "), F.when(
        F.col("name") == "num", F.regexp_replace("hit", "[^0-9.]", "")).otherwise(lowered)))


def bootstrapped(slots: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind) of seeds and of what their patterns lead to; ``slots`` is a stored table with ``value``."""
    spark = slots.sparkSession
    graph = _graph(slots.where("kind IS NOT NULL OR NOT covered"))
    seeds = written(slots.where("kind IS NOT NULL").groupBy("value").agg(F.min("kind").alias("kind")), "seeds")
    sizes = written(graph.groupBy("pattern").agg(F.count("*").alias("held")), "pattern-sizes")
    scored = seeds.withColumn("score", F.lit(SEED_SCORE).cast("bigint"))
    found = None
    for _ in range(rounds):
        # Sums are stored before they are joined back, so AQE can split a pattern or value with very many edges.
        sums = written(graph.join(scored, "value").groupBy("pattern", "kind").agg(
            F.count("*").alias("support"), F.sum("score").alias("total")).where(F.col("support") >= SUPPORT), "pattern-sums")
        sure = sums.join(sizes, "pattern").withColumn("confidence", F.floor(F.col("total") / (F.col("held") + 1))).where(
            F.col("confidence") >= ACCEPT_PATTERN)
        doubt = (F.lit(1000) - F.col("confidence")) / F.lit(1000)
        sure = written(sure.select("pattern", "kind", F.floor(-1000 * F.ln(doubt)).alias("evidence")), "sure-patterns")
        evidence = graph.join(sure, "pattern").groupBy("value", "kind").agg(F.sum("evidence").alias("evidence"))
        score = F.floor(1000 - 1000 * F.exp(-F.col("evidence") / F.lit(1000)))
        best = evidence.select("value", F.struct(score.alias("score"), "kind").alias("s")).where(
            F.col("s.score") >= ACCEPT_VALUE).groupBy("value").agg(F.max("s").alias("s"))
        last, found = found, written(best.join(seeds.select("value"), "value", "left_anti").select("value", "s.kind", "s.score"),
                                     "found-values")
        dropped(spark, sums, sure, *([last] if last is not None else []))
        scored = seeds.withColumn("score", F.lit(SEED_SCORE).cast("bigint")).unionByName(found)
    dropped(spark, graph, sizes)
    return written(scored.select("value", "kind"), "known-values")


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: id, ``spans`` (array of kind, start, end, base; in order) and the address."""
    rows = addressed(docs, "documents")
    found = mentions(rows, text_col)
    slots = written(values_of(found.where(~F.col("name").isin(KINDS))), "slots")
    known = bootstrapped(slots, rounds)
    new = slots.where("kind IS NULL AND NOT covered").drop("kind").join(known, "value").select(
        *ADDRESS, "kind", "start", "end", F.lit(False).alias("base"))
    base = found.where(F.col("name").isin(KINDS)).select(*ADDRESS, "kind", "start", "end", F.lit(True).alias("base"))
    order = F.array_position(F.array(*[F.lit(kind) for kind in KINDS]), F.col("kind"))
    spans = base.unionByName(new).groupBy(*ADDRESS).agg(
        F.array_sort(F.collect_list(F.struct(order.alias("order"), "start", "end", "base", "kind"))).alias("spans"))
    return rows.select(rows[id_col].alias(id_col), FILE, ROW).join(spans, ADDRESS, "left").select(
        id_col, F.coalesce(F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                                   s["end"].alias("end"), s["base"].alias("base"))),
                           F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")).alias("spans"), *ADDRESS)


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
