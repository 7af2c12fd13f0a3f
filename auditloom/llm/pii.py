"""Personal data in text, with built-in functions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, places by country and
mod 97 for account numbers, ranges and digit counts for the rest), and words before a span raise its score. The
positions of all matches of a pattern come from the lengths of the matches and of the text between
them. The patterns are possessive where that changes no match, so that neither time nor
stack depth grows with the square of a long run.
"""

from pyspark.sql import functions as F

CONTEXT_CHARS = 48
LEAST_MATCH = 2    # characters any pattern moves on by, at least
BLOCK = 512        # array elements whose running total is formed at once

# Kinds in their order, base kinds first.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = 4
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# takes four places and captures the longest proposal from there, so that no proposal hides a later one
IBAN = r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}"
# Places of an account number by country; other countries may have any number from 15 to 34.
IBAN_PLACES = dict(part.split(":") for part in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BI:27 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DJ:27 "
    "DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FK:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HN:28 HR:21 HU:28 "
    "IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 "
    "MK:19 MN:20 MR:27 MT:31 MU:30 NI:28 NL:18 NO:15 OM:23 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 RU:33 SA:24 "
    "SC:31 SD:18 SE:24 SI:19 SK:24 SM:27 SO:23 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20 YE:30").split())
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP_VALID = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# Words that make the kind of a span likelier if they are in the CONTEXT_CHARS before it, and the
# scores without and with one. Words behind a span do not count.
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|server|host|address|login|adresse",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|anruf|appel|llama",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.7}
CONTEXT_BONUS = 0.2


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits):
    """Whether a string of digits has a valid Luhn check digit."""
    turned = F.reverse(digits)
    doubled = F.translate(turned, "0123456789", "0246813579")   # digit sums of twice the digit
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, F.substring(turned, i, F.lit(1))).otherwise(
            F.substring(doubled, i, F.lit(1))).cast("int"))
    return total % 10 == 0


def mod97(value):
    """Whether an account number without spaces leaves 1 modulo 97, its first four places moved last."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(value)), F.lit(0),
        lambda r, i: F.when(
            F.substring(moved, i, F.lit(1)).between("0", "9"),
            r * 10 + F.substring(moved, i, F.lit(1)).cast("int")).otherwise(
            r * 100 + F.ascii(F.substring(moved, i, F.lit(1))) - 55) % 97)
    return rest == 1


def _is_account(value):
    """Whether a text with single spaces has the places of its country and leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "))
    places = F.try_element_at(
        F.create_map(*[F.lit(x) for c, n in IBAN_PLACES.items() for x in (c, int(n))]), F.substring(value, 1, 2))
    fits = F.length(plain).between(15, 34) & F.coalesce(F.length(plain) == places, F.lit(True))
    return F.when(fits, mod97(plain)).otherwise(False)


def _account(proposal):
    """The longest account number that starts a proposal and ends with one of its words, or missing."""
    words = F.split(proposal, " ")
    starts = F.transform(
        F.sequence(F.size(words), F.lit(1), F.lit(-1)),
        lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    return F.get(F.filter(starts, _is_account), F.lit(0))


def _confirm(kind):
    """(match) -> the part of it that is a span, or missing."""
    if kind == "ip":
        return lambda m: F.when(m.rlike(IP_VALID), m)
    if kind == "card":
        return lambda m: F.when(
            F.when(F.length(_digits(m)).between(12, 19), luhn(_digits(m))).otherwise(False), m)
    if kind == "phone":
        return lambda m: F.when(F.length(_digits(m)).between(9, 15), m)
    if kind == "iban":
        return _account
    return lambda m: m


def _running(lengths):
    """Running totals of an array of bigint, block by block, so the cost stays near linear."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    zero = F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")

    def totals(values, start):
        return F.aggregate(
            values, F.struct(start.alias("sum"), none.alias("all")),
            lambda acc, x: F.struct(
                (acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + x)).alias("all")))["all"]

    sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x))
    ends = totals(sums, zero)
    return F.flatten(F.zip_with(
        F.zip_with(blocks, sums, lambda b, s: F.struct(b.alias("values"), s.alias("sum"))), ends,
        lambda b, end: totals(b["values"], end - b["sum"])))


_PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN)))
#: What a text must hold for a match; cheaper than the pattern.
_NEEDS = {
    "email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), "phone": lambda t: t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
}
SPAN = "array<struct<start: bigint, place: int, end: bigint, kind: string, score: double>>"


def _with_matches(rows, kind):
    """Add ``_<kind>``: an array of (text before, match) for each match of the pattern."""
    needed = _NEEDS[kind](F.col("text"))
    found = F.regexp_extract_all("text", F.lit(_PATTERNS[kind]), F.lit(1 if kind == "iban" else 0))
    between = F.split("text", _PATTERNS[kind], -1)
    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("before"), found.alias("match"))
    return F.when(needed, F.when(F.size(found) > 0, pairs))


def _taken(kind, match):
    """Characters of a match that the pattern moves on by."""
    return F.lit(4) if kind == "iban" else F.length(match)


def _context(kind, pairs, before, i):
    """The CONTEXT_CHARS of the text before match ``i``, across the matches before it.

    So many matches back always hold them, and the text is never walked from its start.
    """
    back = CONTEXT_CHARS // LEAST_MATCH
    last = lambda s: F.right(s, F.lit(CONTEXT_CHARS))
    earlier = F.transform(
        F.slice(pairs, F.greatest(i - back + 1, F.lit(1)), F.least(i, F.lit(back))),
        lambda q: F.concat(last(q["before"]), last(F.left(q["match"], _taken(kind, q["match"])))))
    return F.when(F.length(before) >= CONTEXT_CHARS, last(before)).otherwise(
        last(F.concat(F.array_join(earlier, ""), before)))


def _spans(kind):
    """The confirmed spans of a kind, from its matches and their running ends."""
    pairs, ends = F.col(f"_{kind}"), F.col(f"_{kind}_ends")
    confirm = _confirm(kind)
    found = F.zip_with(pairs, ends, lambda p, end: F.struct(
        p["before"].alias("before"), confirm(p["match"]).alias("value"),
        (end - _taken(kind, p["match"])).alias("start")))
    bonus = lambda before, i: F.when(
        F.lower(_context(kind, pairs, before, i)).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
    spans = F.transform(found, lambda p, i: F.when(p["value"].isNotNull(), F.struct(
        p["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"),
        (p["start"] + F.length(p["value"])).alias("end"), F.lit(kind).alias("kind"),
        (F.lit(SCORES[kind]) + bonus(p["before"], i)).alias("score"))))
    return F.coalesce(F.filter(spans, lambda s: s.isNotNull()), F.array().cast(SPAN))


def find_pii(docs):
    """doc_id and ``spans``, an array of (start, place, end, kind, score), for each row of (doc_id, text).

    Spans are in order of start, then kind; positions count code points, ends are exclusive. Spans
    of different kinds may overlap, and so may account numbers that are both valid. A missing or empty text has no spans; every row gives one row.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", *[_with_matches(rows, k).alias(f"_{k}") for k in KINDS])
    rows = rows.withColumns({
        f"_{k}_ends": _running(F.transform(f"_{k}", lambda p: (
            F.length(p["before"]) + _taken(k, p["match"])).cast("bigint"))) for k in KINDS})
    return rows.select("doc_id", F.array_sort(F.concat(*[_spans(k) for k in KINDS])).alias("spans"))


def written(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
