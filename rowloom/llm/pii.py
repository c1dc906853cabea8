"""Personal data: patterns propose spans, checksums confirm them, context adjusts their score.

Built-in expressions only.  Positions come from splitting a text at the same
pattern that extracts the matches: a match starts where the gaps and matches
before it end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in listed order, and the one the method adds.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]

#: Characters of an IBAN by country code: the registry, and codes in use without it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Every place where an IBAN may begin, with its text as the group; only the first letter is consumed.

    A code prescribes the length, so that what follows is never swallowed, and a place that
    fails its check hides none after it.  Other codes take as much as there is.
    """
    listed = "|".join("|".join(codes.split()) for codes in IBAN_LENGTHS.values())
    ways = [
        rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[0-9A-Z]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()
    ]
    ways.append(rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[0-9A-Z]){{11,30}}+")
    return rf"(?=[A-Z]{{2}}[0-9]{{2}})(?=({'|'.join(ways)}))[A-Z]"


# Possessive repetition and a fixed left edge keep each pattern linear in long
# runs of one character; \G is the end of the match before.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
}
#: What a text must contain for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

#: Score of a confirmed span, what a context word near it adds, and how near (characters).
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.9}
CONTEXT_BONUS = 0.15
CONTEXT_CHARS = 40
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mailto|contact|address)\b",
    "ip": r"(?i)\b(ip|host|server|address|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|credit|debit|payment)\b",
    "phone": r"(?i)\b(phone|tel|mobile|call|fax)\b",
    "iban": r"(?i)\b(iban|account|bank|transfer)\b",
}

SPAN = "struct<start: bigint, rank: int, end: bigint, kind: string, score: double>"


def digits(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0))


def luhn(text: Column) -> Column:
    """Whether the digits of ``text`` pass the Luhn check."""
    doubled = lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    values = F.transform(F.reverse(digits(text)), lambda c, i: doubled(c.cast("int"), i))
    return F.aggregate(values, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an IBAN leaves 1: its first four characters moved to the end, letters as 10 to 35."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    values = F.transform(
        F.regexp_extract_all(turned, F.lit("[0-9A-Z]"), F.lit(0)),
        lambda c: F.when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55),
    )
    step = lambda rest, v: (rest * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(values, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_PARTS)
    if kind == "card":
        return F.size(digits(match)).between(14, 19) & luhn(match)
    if kind == "phone":
        return F.size(digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def score(kind: str, text: Column, start: Column, end: Column) -> Column:
    """The prior of the kind, raised if a context word stands near the span."""
    left = F.greatest(start - CONTEXT_CHARS, F.lit(0))
    near = F.concat(
        F.substr(text, left + 1, start - left), F.lit("\n"), F.substr(text, end + 1, F.lit(CONTEXT_CHARS))
    )
    bonus = F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
    return F.least(F.lit(1.0), F.lit(PRIOR[kind]) + bonus)


def kind_spans(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind in order, none inside another.

    A match that fails its check is dropped and not retried; for IBANs every place is a match of its own.
    """
    pattern = F.lit(PATTERNS[kind])
    matches = F.regexp_extract_all(text, pattern, F.lit(1 if kind == "iban" else 0))
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap).cast("bigint"))
    pairs = F.arrays_zip(matches.alias("match"), F.slice(gaps, 1, F.size(matches)).alias("gap"))
    nothing = F.lit(None).cast(f"array<{SPAN}>")
    empty = F.coalesce(nothing, F.array().cast(f"array<{SPAN}>"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["match"])
        span = F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"),
            F.lit(kind).alias("kind"), score(kind, text, start, end).alias("score"),
        ).cast(SPAN)
        valid = confirmed(kind, pair["match"])
        if kind == "iban":
            valid = (start >= F.coalesce(F.try_element_at(state["spans"], F.lit(-1))["end"], F.lit(0))) & valid
        kept = F.when(valid, F.array_append(state["spans"], span))
        at = start + 1 if kind == "iban" else end
        return F.struct(at.cast("bigint").alias("at"), kept.otherwise(state["spans"]).alias("spans"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))
    found = F.aggregate(pairs, first, step)["spans"]
    tried = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike("[0-9]")
    return F.when(tried, found).otherwise(empty)


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: all confirmed spans by start, then kind.

    ``start`` and ``end`` count code points, ``end`` exclusive.  Null and empty
    texts have no spans.  Rows are independent of each other, so null or
    repeated ids change nothing; an empty table gives no rows.
    """
    text = F.col("text")
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select(
        "doc_id", *[kind_spans(kind, text).alias(f"_{kind}") for kind in KINDS]
    )
    return found.select("doc_id", F.sort_array(F.concat(*[f"_{kind}" for kind in KINDS])).alias("spans"))


def joined(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, all spans as text, and the highest score."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.round(F.array_max(F.transform("spans", lambda s: s["score"])), 2).alias("top_score"),
    )


def _kind_sql(kind: str, pattern: str, check: str) -> str:
    return rf"""
{kind}_raw AS (SELECT row, text, regexp_extract_all(text, '{pattern}') AS ms,
  string_split_regex(text, '{pattern}') AS gs FROM d),
{kind}_at AS (SELECT row, text, m, CAST(g + p AS BIGINT) AS a, CAST(g + p + length(m) AS BIGINT) AS z FROM (
  SELECT row, text, ms[i] AS m, coalesce(list_sum(list_transform(gs[1:i], lambda x: length(x))), 0) AS g,
    coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS p
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM {kind}_raw))),
{kind} AS (SELECT row, '{kind}' AS kind, {KINDS.index(kind)} AS rank, a, z,
  least(1.0, CAST({PRIOR[kind]} AS DOUBLE) + CASE WHEN regexp_matches(
    substr(text, greatest(a - 40, 0) + 1, a - greatest(a - 40, 0)) || chr(10) || substr(text, z + 1, 40),
    '{CONTEXT[kind]}') THEN CAST({CONTEXT_BONUS} AS DOUBLE) ELSE 0 END) AS score
  FROM {kind}_at WHERE {check}),"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_TURNED = "(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4])"
PII_SQL = (
    "WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),"
    + _kind_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true")
    + _kind_sql(
        "ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS DOUBLE))) <= 255",
    )
    + _kind_sql(
        "card", r"[0-9]([\x20-]?[0-9])+",
        f"length({_DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: "
        f"CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT) ELSE CAST(reverse({_DIGITS})[i] AS INT) * 2 "
        f"- CASE WHEN CAST(reverse({_DIGITS})[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
    )
    + _kind_sql(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15"
    )
    + _kind_sql(
        "iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]){11,30}",
        f"list_reduce(list_prepend(0, list_transform(range(1, length({_TURNED}) + 1), lambda i: CASE WHEN {_TURNED}[i] <= '9' "
        f"THEN ascii({_TURNED}[i]) - 48 ELSE ascii({_TURNED}[i]) - 55 END)), "
        "lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1",
    )
    + """
u AS (SELECT * FROM email UNION ALL SELECT * FROM ip UNION ALL SELECT * FROM card
  UNION ALL SELECT * FROM phone UNION ALL SELECT * FROM iban),
g AS (SELECT row, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
  count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) FILTER (rank < 4) AS base,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS spans, max(score) AS top FROM u GROUP BY row)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  round(top, 2) AS top_score
FROM d LEFT JOIN g USING (row)
"""
)
