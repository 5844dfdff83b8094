"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans of each kind; a validator confirms them (Luhn
for card numbers, modulo 97 for account numbers, value or digit counts for the
rest); words near a span move its score up or down. A span stays if its score
reaches ``ACCEPT``.

The four base kinds (email, ip, card, phone) stay whenever their validator
holds: their context can only raise the score. The further kinds need more:
an account number (iban) must pass modulo 97, a national id (3-2-4 digits) and
a short card number (13 to 15 digits passing Luhn) need a context word.

Positions are code points, ends exclusive. They follow from lengths: the text
split at the matches gives what lies between them, so the start of a match is
the sum of all that stands before it, added up in runs; texts with matches are
also cut into blocks, so that the words near a match are found without walking
there from the start. Time grows with the text and its matches. Each pattern is anchored so that a long
run of its characters is tried once, not once for each character, and repeats
possessively, so the engine neither backtracks nor recurses over long matches;
the leftmost matches are the same as those of the plain pattern.

Defined results: a null text is empty and has no spans; extra columns stay, and
an input column named like an output is replaced; repeated rows are kept.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

ACCEPT = 0.5
#: Characters before and after a span in which context words count.
BEFORE, AFTER = 48, 24
RAISE, LOWER = 0.3, 0.2
LOWERING = r"\b(example|sample|version|invoice|order|isbn|issn|beispiel|ejemplo|exemple)\b"
_CHUNK = 256
_BLOCK = 512

BASE = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without this string has no match.
    hint: str | None
    prior: float
    context: str
    base: bool = False


# With \G a match may also begin where the last one of its kind ended.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8,
         r"\b(e-?mail|mail|contact|write|courriel|correo|kontakt)\b", True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", ".", 0.6, r"\b(ip|host|server|address|adresse|login)\b", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, 0.8, r"\b(card|visa|mastercard|credit|karte|carte|tarjeta)\b", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, r"\b(phone|tel|call|mobile|fax|telefon|handy)\b", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None,
         0.8, r"\b(iban|account|konto|compte|cuenta)\b"),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3,
         r"\b(ssn|social security|national id|sozialversicherung)\b"),
    Kind("short_card", r"[0-9](?:[\x20-]?[0-9])++", None, 0.3, r"\b(card|visa|mastercard|credit|karte|carte|tarjeta)\b"),
)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + F.lit(1), F.lit(1)).cast("int")
        d = F.when(i % 2 == 0, d * 2).otherwise(d)
        return total + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (letters and digits) has the remainder 1."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def valid(kind: str, m: Column) -> Column:
    digits = _digits(m)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"))
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(m, " ", ""))
    if kind == "short_card":
        return F.length(digits).between(13, 15) & luhn(digits)
    return F.lit(True)


def chunked(a: Column) -> Column:
    """The array cut into runs of _CHUNK entries. (Refers to ``a`` twice, so the
    optimizer keeps a column that it names and doesn't compute it for each run.)"""
    return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / F.lit(_CHUNK)).cast("int")),
                                             lambda k: F.slice(a, k * _CHUNK + 1, F.lit(_CHUNK))))


def _before_each(a: Column, start: Column, combine) -> Column:
    """For each entry, all entries before it combined, from ``start`` on."""
    first = F.struct(start.alias("s"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(a, first, lambda acc, x: F.struct(
        combine(acc["s"], x).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")), lambda acc: acc["out"])


def running(chunks: Column, combine) -> Column:
    """For each entry of a chunked array of numbers, all entries before it combined
    (0 before the first). ``chunks`` must be a column of an earlier projection.
    Each run is walked once, and so are the runs' totals: an entry costs the
    length of a run at most, not that of the array."""
    zero = F.lit(0)
    totals = F.transform(chunks, lambda c: F.aggregate(c, zero, combine))
    return F.flatten(F.zip_with(chunks, _before_each(totals, zero, combine), lambda c, o: _before_each(c, o, combine)))


def blocks(t: Column) -> Column:
    """The text in blocks of _BLOCK code points."""
    return F.regexp_extract_all(t, F.lit("(?s).{1,%d}" % _BLOCK), F.lit(0))


def cut_out(parts: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` of a text in blocks; the cost is
    theirs and a block's, not that of the text before them."""
    first = F.floor(start / F.lit(_BLOCK)).cast("int")
    last = F.floor(end / F.lit(_BLOCK)).cast("int")
    near = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.substring(near, start - first * _BLOCK + 1, end - start)


SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def find(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``df`` with ``out``: the spans, by kind in the order of ``KINDS`` and then start."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    # Helper columns are one struct under a name that no input column has.
    names = {c.lower() for c in df.columns} | {out.lower()}
    h = next(n for i in range(len(names) + 1) if (n := f"pii_parts_{i}") not in names)

    def matches(k: Kind) -> Column:
        found = F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0))
        return (F.when(F.contains(whole, F.lit(k.hint)), found).otherwise(none) if k.hint else found).alias(f"m_{k.name}")

    # Both kinds of card number share one pattern, so one search.
    searched = [k for k in KINDS if k.name != "short_card"]
    df = df.select(*keep, whole.alias(f"{h}_t"), *[matches(k).alias(f"{h}_m_{k.name}") for k in searched])

    def lengths(k: Kind) -> Column:
        between = F.transform(F.split(F.col(f"{h}_t"), k.pattern, -1), lambda x: F.length(x))
        sizes = F.transform(F.col(f"{h}_m_{k.name}"), lambda x: F.length(x))
        return F.when(F.size(sizes) > 0, F.arrays_zip(F.slice(between, F.lit(1), F.size(sizes)).alias("gap"),
                                                      sizes.alias("len")))

    df = df.select("*", *[lengths(k).alias(f"{h}_l_{k.name}") for k in searched])

    # Each step is a projection of its own, which the next one refers to more than once.
    df = df.select("*", *[F.transform(F.col(f"{h}_l_{k.name}"), lambda x: x["gap"] + x["len"]).alias(f"{h}_a_{k.name}") for k in searched])
    df = df.select("*", *[chunked(F.col(f"{h}_a_{k.name}")).alias(f"{h}_c_{k.name}") for k in searched])

    def starts(k: Kind) -> Column:
        l, before = F.col(f"{h}_l_{k.name}"), running(F.col(f"{h}_c_{k.name}"), lambda s, x: s + x)
        return F.when(l.isNotNull(), F.zip_with(before, l, lambda s, x: s + x["gap"]))

    some = F.lit(False)
    for k in searched:
        some = some | F.col(f"{h}_l_{k.name}").isNotNull()
    df = df.select("*", *[starts(k).alias(f"{h}_s_{k.name}") for k in searched],
                   F.when(some, blocks(F.col(f"{h}_t"))).alias(f"{h}_b"))

    def spans(k: Kind) -> Column:
        via = "card" if k.name == "short_card" else k.name
        found, at, parts = F.col(f"{h}_m_{via}"), F.col(f"{h}_s_{via}"), F.col(f"{h}_b")

        def span(m: Column, i: Column) -> Column:
            start = F.get(at, i).cast("int")
            end = (start + F.length(m)).cast("int")
            first = F.greatest(start - BEFORE, F.lit(0))
            near = F.lower(F.concat(cut_out(parts, first, start), F.lit(" "), cut_out(parts, end, end + AFTER)))
            score = F.lit(k.prior) + F.when(near.rlike(k.context), F.lit(RAISE)).otherwise(F.lit(0.0))
            if not k.base:
                score = score - F.when(near.rlike(LOWERING), F.lit(LOWER)).otherwise(F.lit(0.0))
            return F.struct(F.lit(k.name).alias("kind"), start.alias("start"), end.alias("end"),
                            F.round(F.least(score, F.lit(1.0)), 2).alias("score"))

        ok = F.filter(F.transform(found, lambda m, i: F.when(valid(k.name, m), span(m, i))),
                      lambda s: s.isNotNull() & (s["score"] >= ACCEPT))
        return F.when(at.isNotNull(), ok).otherwise(F.array().cast(SPAN)).cast(SPAN)

    return df.select(*keep, F.concat(*[spans(k) for k in KINDS]).alias(out))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span in ``text`` replaced by its kind, as ``[EMAIL]``.

    Spans that touch or overlap (a number inside an address) become one, named
    after the first of them, of equal starts the longest. Texts without spans, null ones too, stay as they are.
    """
    keep = df.columns
    names = {c.lower() for c in keep}
    s = next(n for i in range(len(names) + 1) if (n := f"pii_spans_{i}") not in names)
    found = find(df, text, s)
    ordered = F.array_sort(F.transform(F.col(s), lambda x: F.struct(x["start"], (-x["end"]).alias("minus_end"), x["kind"])))
    free = iter(n for i in range(len(names) + 9) if (n := f"pii_step_{i}") not in names)
    e, c, r, b = (next(free) for _ in range(4))
    found = found.select(*keep, ordered.alias(s))
    spans, t = F.col(s), F.col(text)
    found = found.select("*", F.transform(spans, lambda x: -x["minus_end"]).alias(e), F.when(F.size(spans) > 0, blocks(t)).alias(b))
    found = found.select("*", chunked(F.col(e)).alias(c))
    # The furthest end of all spans before each one: what lies below it is gone.
    found = found.select("*", running(F.col(c), lambda m, x: F.greatest(m, x)).alias(r))
    parts = F.transform(F.arrays_zip(spans.alias("x"), F.col(r).alias("r")), lambda z, i: F.when(
        (i > 0) & (z["x"]["start"] <= z["r"]), F.lit("")).otherwise(F.concat(
            cut_out(F.col(b), z["r"], z["x"]["start"]), F.lit("["), F.upper(z["x"]["kind"]), F.lit("]"))))
    rest = F.substring(t, F.array_max(F.col(e)) + 1, F.length(t))
    new = F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(t)
    return found.select(*[new.alias(c_) if c_ == text else F.col(c_) for c_ in keep])
