"""Personal data: regular expressions propose spans, checksums confirm them,
nearby context words adjust their score. DataFrame functions only.

Positions come without a per-character loop: ``split`` gives the stretches
between the matches of a pattern, ``regexp_extract_all`` the matches, and the
running sum of both lengths is where each match starts (code points, end
exclusive). Sums run over chunks of matches so that a text with very many
matches stays cheap.

Base kinds, all kept whatever their score:

* ``email``
* ``ip``: four parts of at most 255
* ``card``: 13 to 19 digits that pass Luhn
* ``phone``: ``+`` and 9 to 15 digits

Added kinds, kept from a score of ``MIN_SCORE``:

* ``iban``: 15 to 34 characters up to a group border that pass mod-97, of the
  country's length if such a stretch passes, else the longest
* ``ssn``: 3-2-4 digits with a possible area, which only context words confirm

Cases: NULL or empty text has no spans; repeated rows are kept; NULL ids pass
through; an empty table gives an empty result; very long texts are scanned
whole (patterns are possessive, so they neither backtrack nor recurse).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

MIN_SCORE = 0.5
CONTEXT_BONUS = 0.3
#: Code points looked at on either side of a span.
CONTEXT_SIZE = 40
#: Matches whose positions are summed in one go.
CHUNK = 256

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Local part of an address from its first character on: after a character
#: that can't belong to it, or where the match before ended.
LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
#: Groups of an account number; a group must not run on in another character.
IBAN_GROUPS = (r"^[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?![A-Za-z0-9])"
               r"(?:\x20[A-Z0-9]++(?![A-Za-z0-9]))*+")
#: Code points an account number can span (34, a space between any two), and one more.
IBAN_WINDOW = 68
#: Length of an account number -> countries.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FO FI GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Code points in a block of text (see :func:`cut`).
BLOCK = 256
BLOCKS = f"(?s).{{1,{BLOCK}}}"


@dataclass(frozen=True)
class Kind:
    name: str
    #: A text without a match of this can hold no span of the kind.
    hint: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    #: Where a span ends that starts with a match and the text after it, of
    #: ``IBAN_WINDOW`` code points in all; NULL if there is none.
    end: Callable[[Column], Column] | None = None


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    def weighed(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = n * 2 - F.when(n > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, twice).otherwise(n)

    each = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 mod 97-10 check of an IBAN without spaces."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        letter = (rest * 100 + code - 55) % 97
        return F.when(code >= 65, letter).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(value: Column) -> Column:
    return let(_digits(value), lambda d: F.length(d).between(13, 19) & luhn(d))


def _iban_end(window: Column) -> Column:
    """Where the account number at the start of ``window`` ends, or NULL: of
    the stretches up to a group border that pass mod-97, the one of its
    country's length, else the longest."""
    def confirmed(s: Column) -> Column:
        return F.length(s["account"]).between(15, 34) & mod97(s["account"])

    def longest(groups: Column) -> Column:
        def stretch(n: Column) -> Column:
            return F.struct(n.alias("n"), F.array_join(F.slice(groups, 1, n), "").alias("account"))

        def ranked(s: Column) -> Column:
            size = F.length(s["account"])
            usual = F.coalesce(size == _iban_length(F.left(s["account"], F.lit(2))), F.lit(False))
            return F.struct(usual.alias("usual"), (size + s["n"] - 1).alias("end"))

        stretches = F.transform(F.sequence(F.lit(1), F.size(groups)), stretch)
        return F.array_max(F.transform(F.filter(stretches, confirmed), ranked))["end"]

    return let(F.split(F.regexp_extract(window, IBAN_GROUPS, 0), " "), longest)


def _iban_length(country: Column) -> Column:
    found = F.lit(None).cast("int")
    for size, countries in IBAN_LENGTHS.items():
        found = F.when(country.isin(*countries.split()), size).otherwise(found)
    return found


KINDS = (
    Kind("email", "@", LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda v: F.lit(True), 0.9, r"mail|contact|write to"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), 0.6,
         r"\bip\b|address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12}", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.7,
         r"card|visa|master|credit|debit|payment"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda v: F.length(_digits(v)).between(9, 15), 0.6, r"phone|call|tel\b|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])",
         lambda v: F.lit(True), 0.8, r"iban|account|bank|transfer", base=False, end=_iban_end),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3,
         r"\bssn\b|social security", base=False),
)
SPAN = "array<struct<start:int,end:int,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """All matches of ``pattern``: ``start, end, value``."""
    def summed(steps: Column) -> Column:
        none = F.lit(None).cast(SPAN)

        def place(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])
            end = start + F.length(x["value"])
            span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
            return F.struct(F.coalesce(end, start).alias("at"),
                            F.when(x["value"].isNull(), acc["out"]).otherwise(
                                F.concat(acc["out"], F.array(span))).alias("out"))

        def start() -> Column:
            return F.struct(F.lit(0).alias("at"), F.coalesce(none, F.array()).cast(SPAN).alias("out"))

        def chunk(c: Column) -> Column:
            return F.aggregate(F.slice(steps, c * CHUNK + 1, CHUNK), start(), place)

        def joined(parts: Column) -> Column:
            ends = F.aggregate(parts, F.array(F.lit(0)), lambda acc, p: F.concat(
                acc, F.array(F.element_at(acc, -1) + p["at"])))

            def moved(first: Column) -> Column:
                return F.flatten(F.transform(parts, lambda p, i: F.transform(p["out"], lambda s: F.struct(
                    (s["start"] + F.get(first, i)).alias("start"), (s["end"] + F.get(first, i)).alias("end"),
                    s["value"].alias("value")))))

            return let(ends, moved)

        numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int"))
        return let(F.transform(numbers, chunk), joined)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("value"))
    steps = steps.cast("array<struct<gap:string,value:string>>")
    return let(steps, summed)


def cut(blocks: Column, start: Column, size: Column) -> Column:
    """``size <= BLOCK`` code points from ``start`` on of a text in blocks."""
    at = F.floor(start / BLOCK).cast("int")
    return F.substring(F.array_join(F.slice(blocks, at + 1, 2), ""), start - at * BLOCK + 1, size)


def _extended(spans: Column, blocks: Column, end: Callable[[Column], Column]) -> Column:
    """``spans`` with the ends that ``end`` finds in the text from their starts
    on; those without one, and those inside the one before, are left out."""
    def moved(s: Column) -> Column:
        return F.struct(s["start"].alias("start"),
                        (s["start"] + end(cut(blocks, s["start"], F.lit(IBAN_WINDOW)))).alias("end"),
                        s["value"].alias("value"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        return F.struct(F.when(new, s["end"]).otherwise(acc["at"]).alias("at"),
                        F.when(new, F.concat(acc["out"], F.array(s))).otherwise(acc["out"])
                        .alias("out"))

    found = F.filter(F.transform(spans, moved), lambda s: s["end"].isNotNull()).cast(SPAN)
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(found, none, step)["out"]


def kind_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind: ``kind, start, end, score, base``."""
    def spans(blocks: Column) -> Column:
        def scored(s: Column) -> Column:
            before = cut(blocks, F.greatest(s["start"] - CONTEXT_SIZE, F.lit(0)),
                         F.least(s["start"], F.lit(CONTEXT_SIZE)))
            near = F.concat_ws(" ", before, cut(blocks, s["end"], F.lit(CONTEXT_SIZE)))
            bonus = F.when(F.lower(near).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"),
                            s["end"].alias("end"),
                            F.least(F.lit(kind.score) + bonus, F.lit(1.0)).alias("score"),
                            F.lit(kind.base).alias("base"))

        confirmed = F.filter(located(text, kind.pattern), lambda s: kind.confirm(s["value"]))
        if kind.end is not None:
            confirmed = _extended(confirmed, blocks, kind.end)
        found = F.transform(confirmed, scored)
        return found if kind.base else F.filter(found, lambda s: s["score"] >= MIN_SCORE)

    # the context is taken from the text itself, other matches included
    blocks = F.regexp_extract_all(text, F.lit(BLOCKS), F.lit(0))
    return F.when(text.rlike(kind.hint), let(blocks, spans))


def find_spans(text: Column) -> Column:
    """All spans of a text, by kind as in :data:`KINDS`, then by start."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double,base:boolean>>")
    return F.concat(*(F.coalesce(kind_spans(text, k), none) for k in KINDS))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every stretch covered by spans replaced by the name of
    the kind that starts first, in brackets. Spans are taken ``CHUNK`` at a
    time, so time grows in proportion to the text and its spans."""
    def over(blocks: Column, ordered: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            first, last = (F.floor(x / BLOCK).cast("int") for x in (start, end - 1))
            inside = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.when(end > start, F.substring(inside, start - first * BLOCK + 1, end - start)).otherwise("")

        def step(acc: Column, s: Column) -> Column:
            piece = F.concat(between(acc["at"], s["start"]), F.lit("["), s["kind"], F.lit("]"))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(piece)))
                            .otherwise(acc["out"]).alias("out"))

        def chunk(number: Column) -> Column:
            return F.slice(ordered, number * CHUNK + 1, CHUNK)

        numbers = F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / CHUNK).cast("int"))
        # how far the spans before each chunk reach, and at last all of them
        reach = F.aggregate(F.transform(numbers, lambda c: F.array_max(F.transform(chunk(c), lambda s: s["end"]))),
                            F.array(F.lit(0)), lambda acc, end: F.concat(
                                acc, F.array(F.greatest(F.element_at(acc, -1), end))))

        def whole(reach: Column) -> Column:
            none = F.array().cast("array<string>")
            pieces = F.transform(numbers, lambda c: F.aggregate(
                chunk(c), F.struct(F.get(reach, c).alias("at"), none.alias("out")), step)["out"])
            rest = F.array(between(F.element_at(reach, -1), F.length(text)))
            return F.array_join(F.concat(F.flatten(pieces), rest), "")

        return let(reach, whole)

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    blocks = F.regexp_extract_all(text, F.lit(BLOCKS), F.lit(0))
    done = let(blocks, lambda b: let(ordered, lambda o: over(b, o)))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(text: Column) -> Column:
    """``text`` with all personal data found in it replaced."""
    return let(find_spans(text), lambda spans: redacted(text, spans))


def with_spans(docs: DataFrame, text_col: str = "text", name: str = "__spans") -> DataFrame:
    """``docs`` with all its columns and the spans of each text."""
    return docs.withColumn(name, find_spans(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def _is_kind(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, counts of the base kinds, the SHA-256 of the base
    spans, all spans, and their scores."""
    def listed(spans: Column, what: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(spans, what), ",")

    def place(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    found = id_text(docs).select("doc_id", find_spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s["base"])
    counts = [F.size(F.filter("found", _is_kind(k.name))).cast("long")
              .alias(f"n_{k.name}") for k in KINDS if k.base]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base, place).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found"), place).alias("spans"),
        listed(F.col("found"), lambda s: F.format_number(s["score"], 2)).alias("scores"))
