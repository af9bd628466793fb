"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything happens inside the row, in SQL functions: no shuffle, no Python. Each pattern is written so
that a failed attempt is never retried from the middle of the same run of characters (possessive
repeats behind a look-behind), which keeps very long texts linear.

Offsets come from ``split`` (the text between matches) beside ``regexp_extract_all`` (the matches):
a match starts where the lengths before it end. They count code points, ends exclusive. Matches are
folded in runs of RUN, so that no array grows by copies of all that came before, and only confirmed
ones are kept. Context and the text between spans are cut from pieces of PIECE code points of the
original text, since ``substring`` of a long text counts from its beginning.

Context words count on both sides of a span. They lift the score; a kind whose score without context is
under LEAST needs them.

Defined results: a null text is empty and has no spans; repeated rows are each scanned; other columns
are ignored (``detect``) or kept (``redact``). Where spans of several kinds overlap, ``redact`` puts the
label of the first and removes all that any of them covers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

#: Matches folded together, and code points of a piece of text.
RUN, PIECE = 256, 1024
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """pattern proposes; ``confirm`` (SQL over the match ``m``) decides; score + BONUS near a ``context`` word must reach LEAST."""

    name: str
    pattern: str
    confirm: str
    score: float
    context: str
    base: bool = True


def luhn(digits: str) -> str:
    doubled = f"transform(sequence(1, length({digits})), i -> int(substr({digits}, length({digits}) - i + 1, 1)) * if(i % 2 = 0, 2, 1))"
    return f"aggregate({doubled}, 0, (a, x) -> a + if(x > 9, x - 9, x)) % 10 = 0"


def mod97(code: str) -> str:
    """The first four characters go last, letters count 10 to 35, and the number leaves 1 modulo 97."""
    moved = f"concat(substr({code}, 5), substr({code}, 1, 4))"
    value = "if(c >= 'A', ascii(c) - 55, ascii(c) - 48)"
    return f"aggregate(transform(filter(split({moved}, ''), c -> c != ''), c -> {value}), 0, (a, v) -> (a * if(v > 9, 100, 10) + v) % 97) = 1"


#: Length of an IBAN by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())

#: In the order that settles equal starts. The first four are the base kinds.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 0.9, "mail|contact|write to"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", rf"m rlike '^{_BYTE}([.]{_BYTE}){{3}}$'", 0.7, "ip|host|server|address|login"),
    Kind("card", r"(?:(?<![0-9])|\G)[0-9](?:[ -]?[0-9]){13,}+", f"length(regexp_replace(m, '[ -]', '')) between 14 and 19 and {luhn("regexp_replace(m, '[ -]', '')")}", 0.8, "card|visa|master|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "length(regexp_replace(m, '[^0-9]', '')) between 10 and 15", 0.7, "phone|call|tel|mobile|fax"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Za-z0-9])", mod97("replace(m, ' ', '')"), 0.7, "iban|bank|account|konto|compte|cuenta", False),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "substr(m, 1, 3) not in ('000', '666') and substr(m, 1, 1) != '9' and substr(m, 5, 2) != '00' and substr(m, 8, 4) != '0000'", 0.4, "ssn|social security", False),
)
#: A span needs this score; context words within WINDOW code points before or after it add BONUS.
LEAST, BONUS, WINDOW = 0.5, 0.3, 40


SPAN = "struct<start: int, kind_no: int, kind: string, stop: int, score: double>"


def folded(array: str, carry: str, first: str, made: str, step: str) -> str:
    """SQL for the rows of type ``made`` that a fold over ``array`` leaves.

    ``step`` gives struct(carry, out) from the state ``a`` (a.carry, a.out) and the element ``x``. Runs of RUN
    elements are folded one by one and then joined, so arrays are copied within a run only.
    """
    runs = f"transform(sequence(0, (size({array}) - 1) div {RUN}), i -> slice({array}, i * {RUN} + 1, {RUN}))"
    one = f"aggregate(c, cast(struct(b.carry, array()) as struct<carry: {carry}, out: array<{made}>>), (a, x) -> {step})"
    start = f"cast(struct({first}, array()) as struct<carry: {carry}, out: array<array<{made}>>>)"
    return f"flatten(aggregate({runs}, {start}, (b, c) -> transform(array({one}), r -> struct(r.carry as carry, concat(b.out, array(r.out)) as out))[0], z -> z.out))"


def cut(begin: str, end: str) -> str:
    """SQL for the code points [begin, end) of the text whose pieces are ``pieces``."""
    part = f"substr(get(pieces, j), greatest({begin} - j * {PIECE}, 0) + 1, {end} - j * {PIECE} - greatest({begin} - j * {PIECE}, 0))"
    return f"if({end} <= {begin}, '', array_join(transform(sequence({begin} div {PIECE}, ({end} - 1) div {PIECE}), j -> {part}), ''))"


def _found(kind: Kind, order: int) -> str:
    """SQL for the confirmed spans of one kind in ``text``, where its pattern matches at all."""
    p = "'" + kind.pattern.replace("\\", "\\\\") + "'"
    pairs = f"zip_with(m, slice(split(text, {p}, -1), 1, size(m)), (m, gap) -> struct(length(gap) as gap, length(m) as n, {kind.confirm} as ok))"
    span = f"struct(a.carry + x.gap as start, {order} as kind_no, '{kind.name}' as kind, a.carry + x.gap + x.n as stop, {kind.score}D as score)"
    spans = folded("p", "int", "0", SPAN, f"struct(a.carry + x.gap + x.n as carry, if(x.ok, concat(a.out, array({span})), a.out) as out)")
    return f"transform(array(regexp_extract_all(text, {p}, 0)), m -> if(size(m) = 0, null, transform(array({pairs}), p -> {spans})[0]))[0]"


def _with_spans(docs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """``docs`` with ``__pieces`` of the text and its scored ``__spans``; ``text`` is not null any more."""
    every = ", ".join(f"coalesce({_found(k, i)}, cast(array() as array<{SPAN}>))" for i, k in enumerate(kinds))
    df = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("__found", F.expr(f"concat({every})"))
    df = df.withColumn("__pieces", F.expr(f"if(size(__found) = 0, null, regexp_extract_all(text, '(?s).{{1,{PIECE}}}', 0))"))
    context = " ".join(f"when {i} then '{k.context}'" for i, k in enumerate(kinds))
    around = f"concat({cut(f'greatest(s.start - {WINDOW}, 0)', 's.start')}, ' ', {cut('s.stop', f's.stop + {WINDOW}')})"
    near = f"if(lower({around}) rlike (case s.kind_no {context} end), {BONUS}D, 0D)"
    scored = f"transform(__found, s -> struct(s.start, s.kind_no, s.kind, s.stop, least(1D, s.score + {near}) as score))"
    spans = f"if(size(__found) = 0, __found, array_sort(filter({scored}, s -> s.score >= {LEAST})))"
    return df.withColumn("__spans", F.expr(spans.replace("pieces", "__pieces")))


def detect(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id and ``spans``: array of (start, kind_no, kind, stop, score), by start, then kind."""
    return _with_spans(docs.select("doc_id", "text"), kinds).select("doc_id", F.col("__spans").alias("spans"))


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with the spans that ``detect`` finds replaced by ``[KIND]``; n_chars follows where there is one. A null text stays null."""
    df = _with_spans(docs.withColumn("__null", F.col("text").isNull()), kinds)
    made = "struct<begin: int, stop: int, label: string>"
    label = "if(x.start >= a.carry, concat('[', upper(x.kind), ']'), '')"
    step = f"struct(greatest(a.carry, x.stop) as carry, concat(a.out, array(struct(a.carry as begin, x.start as stop, {label} as label))) as out)"
    kept = folded("__spans", "int", "0", made, step)
    rest = cut("array_max(transform(__spans, s -> s.stop))", "n")
    joined = f"concat(array_join(transform({kept}, o -> concat({cut('o.begin', 'o.stop')}, o.label)), ''), transform(array(length(text)), n -> {rest})[0])".replace("pieces", "__pieces")
    df = df.withColumn("text", F.expr(f"case when __null then null when size(__spans) = 0 then text else {joined} end")).select(*docs.columns)
    return df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else df


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents"))
    base = [k.name for k in KINDS if k.base]
    listed = lambda array: F.concat_ws(",", F.transform(array, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)))
    return found.select(
        "doc_id",
        *[F.expr(f"size(filter(spans, s -> s.kind = '{b}'))").cast("long").alias(f"n_{b}") for b in base],
        F.sha2(listed(F.filter("spans", lambda s: s.kind_no < len(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s.score)), F.lit(0.0)).alias("top_score"),
    )


QUERIES = {"op3_pii_spans": op3_pii_spans}
ORACLE: dict[str, str] = {}
