"""Operator 3, personal data: patterns, checksums and context, in native expressions only.

Regular expressions propose spans; validators confirm them (octets of an IP
address, Luhn for cards, digit counts for phones, mod-97 for IBANs); words
near a span raise or lower its score. Base spans (email, ip, card, phone)
are those of the contract and always stay, whatever their score; the IBANs
that the method adds stay from ``MIN_SCORE`` on.

Positions come without any Python: a text split at a pattern and the list of
its matches alternate, so running sums of their lengths are the offsets, in
code points. The patterns are written with possessive repeats and
look-behinds that change no match but keep every scan linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from smartmaint.llm.common import table

# Characters of an IBAN by country: the ISO 13616 registry, then countries that use IBANs without being listed there.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
for _n, _more in {25: "AO CV GW MZ", 26: "DZ IR", 27: "CF CG CM GA GQ KM MG TD", 28: "BF BJ CI MA ML NE SN TG"}.items():
    IBAN_LENGTHS[_n] += " " + _more
# Exactly as many characters as the country has, with single blanks at most, so that a following word, BIC or IBAN is never eaten.
_IBAN = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(
    r"(?:%s)[0-9]{2}(?:\x20?[A-Z0-9]){%d}+" % (c.replace(" ", "|"), n - 4) for n, c in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])"

# Kind, pattern, what a text must hold to have a match, in the order that breaks ties between equal starts.
# A local part or number can only start a match where its run of characters starts, or where the last match ended.
PATTERNS = [
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", None),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    ("iban", _IBAN, None),
]
BASE_KINDS = ("email", "ip", "card", "phone")

# Words that speak for or against a kind when they stand within CONTEXT code points of a span.
CONTEXT = 60
FOR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|host|server|address)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|t[ée]l[ée]phone|tel[ée]fono)\b",
    "iban": r"(?i)\b(?:iban|bank|account|konto|compte|cuenta|transfer)\b",
}
AGAINST = r"(?i)\b(?:isbn|serial|version|order|invoice|example)\b"
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8}
MIN_SCORE = 0.5


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn sum that 10 divides."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _mod97(match: Column) -> Column:
    """ISO 13616: country and check digits moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.translate(match, " ", "")
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    values = F.transform(F.split(moved, ""), lambda ch: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ch) - 1)
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v < 0, a).when(v > 9, (a * 100 + v) % 97).otherwise((a * 10 + v) % 97)) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255"))
    digits = _digits(match)
    if kind == "card":
        n = F.length(digits)
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    n = F.length(F.translate(match, " ", ""))
    return F.when(n.between(15, 34), _mod97(match)).otherwise(False)


def _alternating(kind: str, pattern: str, needs: str | None) -> Column:
    """Structs (kind, i, gap, match, before, tail) of the text's matches and its end.

    ``gap`` is the length of what lies between a match and the one before it,
    ``before`` its last code points, ``tail`` its first ones.
    """
    text = F.col("text")
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    rows = F.transform(pairs, lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(p["gap"]).alias("gap"), p["match"].alias("match"),
        F.right(p["gap"], F.lit(CONTEXT)).alias("before"), F.left(p["gap"], F.lit(CONTEXT)).alias("tail")))
    has = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    return F.when(has, rows).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,match:string,before:string,tail:string>>"))


def find_pii(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``spans`` of every row: array of (start, end, rank, kind, score), in order.

    Offsets are code points, ends exclusive. Each text is read whole. Null
    and empty texts have no spans. Each row is scanned on its own, so that
    repeated rows and null ids give rows like others; an empty table gives no
    rows. Other columns of ``docs``, whatever their names, do not matter.
    """
    row = [F.col(f"c{i}") for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("row", F.monotonically_increasing_id())
    found = src.select("row", *row, F.explode_outer(F.concat(*[_alternating(*p) for p in PATTERNS])).alias("m")).select("row", *row, "m.*")
    # one shuffle by row serves the running sums and the lists; a row of a text without any match is one short row
    found = found.repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    after = F.lead("tail").over(Window.partitionBy("row", "kind").orderBy("i"))
    placed = found.select("row", *row, "kind", "match", F.concat("before", F.lit(" "), F.coalesce(after, F.lit(""))).alias("near"),
                          (end - F.length("match")).alias("start"), end.alias("end"))
    ok, rank, score = F.lit(False), F.lit(None).cast("int"), F.lit(None).cast("double")
    for k, (kind, _, _) in enumerate(PATTERNS):
        here = F.col("kind") == kind
        ok = F.when(here, _confirmed(kind, F.col("match"))).otherwise(ok)
        rank = F.when(here, F.lit(k)).otherwise(rank)
        raised = F.lit(BASE_SCORE[kind]) + F.when(F.col("near").rlike(FOR[kind]), 0.2).otherwise(0.0) \
            - F.when(F.col("near").rlike(AGAINST), 0.35).otherwise(0.0)
        score = F.when(here, F.greatest(F.lit(0.0), F.least(F.lit(1.0), raised))).otherwise(score)
    scored = placed.select("row", *row, "kind", "start", "end", rank.alias("rank"),
                           F.when(F.col("match").isNotNull() & ok, score).alias("score"))
    stays = F.col("score").isNotNull() & (F.col("kind").isin(*BASE_KINDS) | (F.col("score") >= MIN_SCORE))
    span = F.when(stays, F.struct("start", "end", "rank", "kind", "score"))
    lists = scored.groupBy("row", *row).agg(F.collect_list(span).alias("spans"))
    by_start = F.transform(F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["score"]))),
                           lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"),
                                              s["kind"].alias("kind"), s["score"].alias("score")))
    return lists.select(*[c.alias(k) for c, k in zip(row, keep)], by_start.alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, all spans."""
    found = find_pii(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
