"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Only DataFrame functions.  A pattern's matches come from
``regexp_extract_all`` and the text between them from ``split``; running
lengths give each match's place in code points, and the ends of the
neighbouring pieces its context.  Patterns cannot backtrack far
(possessive repeats, starts only where a run starts), so their time
stays in proportion to the text.  Running sums and maxima over the
matches of a text double their reach in each of a few steps
(``running``), and redaction cuts the text in blocks first, so the time
for n matches grows as n log n.

Base kinds, kept whenever they pass their check: ``email``; ``ip``
(parts at most 255); ``card`` (16 to 19 digits, Luhn); ``phone`` (+ and
8 to 15 digits).  Further kinds, kept at a score of ``THRESHOLD`` and
where they touch no base span: ``iban`` (its country's length, mod 97), ``card_short`` (13 to
15 digits, Luhn, needs a context word), ``phone_local`` (no +, needs a
context word) and ``ssn`` (needs a context word).

Edge cases: NULL and empty texts have no span; repeated rows each keep
their row; other columns are left behind by ``find`` and kept by
``redact``, whatever their names; ``with_spans`` replaces a column
called pii_spans; an empty input gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
#: Code points on either side that are searched for context words.
NEAR = 40


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str             # text that every match contains (a pattern), tested before
    score: float           # of a match that passes its check
    check: str             # SQL over m, the match
    context: str = ""      # pattern of words that add CONTEXT_SCORE
    base: bool = False


CONTEXT_SCORE = 0.35
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_LUHN = f"""aggregate(transform(split(reverse({_DIGITS}), ''), (c, i) -> if(i % 2 = 0, int(c), int(c) * 2 - if(int(c) > 4, 9, 0))),
    0, (a, x) -> a + x) % 10 = 0"""
_MOD97 = """aggregate(split(concat(substring(replace(m, ' ', ''), 5), substring(m, 1, 4)), ''), 0L,
    (a, c) -> if(c between '0' and '9', (a * 10 + int(c)) % 97, (a * 100 + ascii(c) - 55) % 97)) = 1"""

#: Characters of an IBAN by country; other countries' numbers run as far as they can.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = "|".join([*(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()),
                  rf"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"])

#: In the order in which spans are listed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "true",
         "e-?mail|mail|contact|kontakt|correo|courriel", True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.7,
         "forall(split(m, '[.]'), x -> length(trim(leading '0' from x)) <= 3 and int(concat('0', substring(trim(leading '0' from x), 1, 3))) <= 255)",
         "ip|host|server|address|adresse", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", 0.8, f"length({_DIGITS}) between 16 and 19 and {_LUHN}",
         "card|visa|credit|carte|karte|tarjeta", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, f"length({_DIGITS}) between 8 and 15",
         "phone|tel|call|fax|mobile|handy|telefon", True),
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.9, _MOD97, "iban|bank|account|konto|cuenta|compte"),
    Kind("card_short", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", "[0-9]", 0.3, f"length({_DIGITS}) between 13 and 15 and {_LUHN}",
         "card|visa|amex|credit|carte|karte|tarjeta"),
    Kind("phone_local", r"(?<![0-9+.])\(?[0-9]{2,5}\)?[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9.-])", "[0-9]{3}", 0.3,
         f"length({_DIGITS}) between 8 and 12", "phone|tel|call|fax|mobile|handy|telefon"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-", 0.3,
         "substring(m, 1, 3) not in ('000', '666') and substring(m, 1, 1) <> '9' and substring(m, 5, 2) <> '00' and substring(m, 8) <> '0000'",
         "ssn|social security"),
)
NO_SPAN = "array_repeat(named_struct('kind', '', 'start', 0L, 'end', 0L, 'score', 0.0D), 0)"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running(values: str, combine: str, backwards: bool = False) -> str:
    """SQL for the running ``combine`` (of x and y, associative) of an array, as far as each element.

    In step k each element takes in what the one 2**k places before it
    has gathered: as many steps as the array's length has bits.
    """
    start = f"reverse({values})" if backwards else values
    out = (f"aggregate(sequence(0, 30), {start}, (s, k) -> if(size(s) > shiftleft(1, k), transform(s, (y, i) -> if(i >= shiftleft(1, k), "
           f"transform(array(s[i - shiftleft(1, k)]), x -> {combine})[0], y)), s))")
    return f"reverse({out})" if backwards else out


def _spans(kind: Kind) -> Column:
    """Spans of one kind in column text, given its matches (column _m_<kind>) and the pieces between them (_p_<kind>)."""
    m, p = f"`_m_{kind.name}`", f"`_p_{kind.name}`"
    word = f"(?i)(?<![a-z])(?:{kind.context})" if kind.context else "(?!)"
    ends = running(f"transform({m}, (x, i) -> cast(length({p}[i]) + length(x) as bigint))", "x + y")
    places = f"""transform(array({ends}), e -> transform({m}, (x, i) -> named_struct('m', x, 's', e[i] - length(x),
      'near', concat(right({p}[i], {NEAR}), ' ', left({p}[i + 1], {NEAR})))))[0]"""
    checked = f"filter({places}, x -> exists(array(x.m), m -> {kind.check}))"
    made = f"""transform({checked}, x -> named_struct('kind', '{kind.name}', 'start', x.s, 'end', x.s + length(x.m),
      'score', cast(least(1.0, {kind.score} + if(x.near rlike {_sql(word)}, {CONTEXT_SCORE}, 0.0)) as double)))"""
    return F.expr(f"if(size({m}) > 0, filter({made}, x -> {'true' if kind.base else f'x.score >= {THRESHOLD}'}), {NO_SPAN})")


#: Of all spans (base ones first in `_base`, the others in `_more`), by start: what touches no base span.
#: Before a span, the furthest end of a base span; after it, the next start of one.
_FREE = f"""
transform(array(array_sort(concat(transform(_base, x -> named_struct('start', x.start, 'more', false, 'span', x)),
                                  transform(_more, x -> named_struct('start', x.start, 'more', true, 'span', x))))),
  a -> transform(array(named_struct(
      'far', {running("transform(a, x -> if(x.more, -1L, x.span.end))", "greatest(x, y)")},
      'near', {running("transform(a, x -> if(x.more, 9223372036854775807L, x.start))", "least(x, y)", backwards=True)})),
    r -> transform(filter(transform(a, (x, i) -> named_struct('x', x, 'free', x.more and r.far[i] <= x.start and r.near[i] >= x.span.end)),
                          y -> y.free), y -> y.x.span))[0])[0]
"""


def with_spans(docs: DataFrame) -> DataFrame:
    """Adds pii_spans: array of (kind, start, end, score), by kind as listed, then start; places in code points, end exclusive."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "pii_spans")).alias("_row")  # no helper meets a column's name
    out = docs.select(row, F.coalesce("text", F.lit("")).alias("_text"))
    has = {k.name: F.col("_text").contains("@") if k.needs == "@" else F.col("_text").rlike(k.needs) for k in KINDS}
    none = F.array().cast("array<string>")
    out = out.select("*", *(F.when(has[k.name], F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"_m_{k.name}") for k in KINDS))
    out = out.select("*", *(F.when(F.size(f"_m_{k.name}") > 0, F.split("_text", k.pattern, -1)).otherwise(none).alias(f"_p_{k.name}") for k in KINDS))
    out = out.select("_row", *(_spans(k).alias(f"_s_{k.name}") for k in KINDS))
    base = out.select("_row", F.concat(*(F.col(f"_s_{k.name}") for k in KINDS if k.base)).alias("_base"),
                      F.concat(*(F.col(f"_s_{k.name}") for k in KINDS if not k.base)).alias("_more"))
    free = base.select("_row", "_base", F.expr(f"if(size(_base) = 0 or size(_more) = 0, _more, {_FREE})").alias("_free"))
    of_kind = [F.expr(f"filter(_free, x -> x.kind = '{k.name}')") for k in KINDS if not k.base]
    return free.select("_row.*", F.when(F.size("_free") > 0, F.concat("_base", *of_kind)).otherwise(F.col("_base")).alias("pii_spans"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and pii_spans of every document."""
    return with_spans(docs.select("doc_id", "text")).drop("text")


def listed(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined."""
    chosen = f"filter({spans}, x -> x.kind in ({', '.join(map(_sql, kinds))}))" if kinds else spans
    return F.expr(f"array_join(transform({chosen}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def base_kinds() -> tuple[str, ...]:
    return tuple(k.name for k in KINDS if k.base)


#: Code points of a block in which redaction looks for a place.
_BLOCK = 1024


def _between(low: str, high: str) -> str:
    """SQL for the code points of the text from low up to high, out of its blocks c."""
    first, last = f"cast({low} div {_BLOCK}L as int)", f"cast(({high} - 1L) div {_BLOCK}L as int)"
    inside, upto = f"cast({low} % {_BLOCK}L as int) + 1", f"cast(({high} - 1L) % {_BLOCK}L as int) + 1"
    return (f"if({high} <= {low}, '', if({first} = {last}, substring(c[{first}], {inside}, cast({high} - {low} as int)), "
            f"concat(substring(c[{first}], {inside}), array_join(slice(c, {first} + 2, {last} - {first} - 1), ''), substring(c[{last}], 1, {upto}))))")


_REDACTED = f"""
if(size(_spans) = 0, _text, transform(array(regexp_extract_all(_text, '(?s).{{1,{_BLOCK}}}', 0)), c -> transform(array(array_sort(_spans,
    (a, b) -> case when a.start < b.start then -1 when a.start > b.start then 1 when a.end > b.end then -1 when a.end < b.end then 1 else 0 end)),
  a -> transform(array({running("transform(a, x -> x.end)", "greatest(x, y)")}),
    far -> concat(array_join(transform(a, (x, i) -> if(i > 0 and x.start < far[i - 1], '', concat(
                    {_between("if(i > 0, far[i - 1], 0L)", "x.start")}, '[', upper(x.kind), ']'))), ''),
                  {_between("far[size(far) - 1]", "_chars")}))[0])[0])[0])
"""


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by [KIND] in text, and n_chars (if there) set anew; overlapping spans become one."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = with_spans(docs.select(row, "text")).select(
        "row", F.col("text").alias("_text"), F.col("pii_spans").alias("_spans"), F.length("text").cast("long").alias("_chars"))
    cut = found.select("row", "_spans", F.expr(_REDACTED).alias("_new"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.col("_new")
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.size("_spans") > 0, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return cut.select(*(e.alias(c) for c, e in columns.items()))
