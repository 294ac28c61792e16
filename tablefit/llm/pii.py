"""Personal data in texts (operator 6).

Every kind has a regular expression that proposes spans, a check that
confirms them (octets, the Luhn sum, the number of digits, the mod-97 sum)
and a score, raised or lowered by context words within ``CONTEXT`` characters
on either side. The base kinds (email, ip, card, phone) stay whatever their
score; a span of the added kinds (iban, ssn, secret) stays from ``THRESHOLD``.

DataFrame functions only. Spark gives the matches of a pattern but not their
places; these follow from the lengths of the matches and of the pieces
between them. The patterns are written with possessive repeats, which match the same here and
need no deep stack on long runs.

Null texts count as empty: no spans. Rows are answered one by one, so
repeated rows and null ids need no care. Other columns are ignored
(``redact`` passes them on).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import table

THRESHOLD = 0.5
CONTEXT = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _octets(match: Column) -> Column:
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return match.rlike(f"^{octet}(?:\\.{octet}){{3}}$")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def term(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + term(i))
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)


def _mod97(match: Column) -> Column:
    compact = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, acc * 100 + code - 55).otherwise(acc * 10 + code - 48) % 97

    total = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)
    return F.when(F.length(compact).between(15, 34), total == 1).otherwise(False)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    near: str
    against: str = "example|sample|version|dummy"
    base: bool = True


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True),
         0.9, "mail|contact|write to"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, r"\bip\b|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){15,}+", _luhn, 0.8, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 0.7, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])", _mod97,
         0.7, "iban|account|bank|konto|cuenta|compte", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: ~m.rlike("^(?:000|666|9)|-00-|0000$"),
         0.3, r"ssn|social security", base=False),
    Kind("secret", r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,64}(?![A-Za-z0-9])", lambda m: F.lit(True),
         0.3, "token|secret|api.?key|password|bearer", base=False),
)

_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _starts(pieces: Column, matches: Column) -> Column:
    """Where each match starts: a running sum over pieces and matches."""
    widths = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m"))
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        widths,
        begin,
        lambda acc, w: F.struct(
            (acc["at"] + w["p"] + w["m"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"] + w["p"])).alias("starts")
        ),
        lambda acc: acc["starts"],
    )


def _spans(kind: Kind, pieces: Column, matches: Column) -> Column:
    """Confirmed spans of one kind from the matches and what lies between them.

    All arrays go through side by side: nothing is looked up by index or
    built again for each match."""
    n = F.size(matches)
    around = F.zip_with(
        F.slice(pieces, F.lit(1), n),
        F.slice(pieces, F.lit(2), n),
        lambda b, a: F.lower(F.concat(F.right(b, F.lit(CONTEXT)), F.lit(" "), F.left(a, F.lit(CONTEXT)))),
    )

    def score(text: Column) -> Column:
        raised = F.when(text.rlike(kind.near), 0.3).otherwise(0.0) - F.when(text.rlike(kind.against), 0.2).otherwise(0.0)
        return F.round(F.least(F.greatest(F.lit(kind.score) + raised, F.lit(0.0)), F.lit(1.0)), 3)

    placed = F.zip_with(_starts(pieces, matches), matches, lambda s, m: F.struct(s.alias("s"), m.alias("m")))
    placed = F.zip_with(placed, around, lambda x, c: F.struct(x["s"].alias("s"), x["m"].alias("m"), c.alias("c")))
    spans = F.transform(
        F.filter(placed, lambda x: kind.valid(x["m"])),
        lambda x: F.struct(
            F.lit(kind.name).alias("kind"), x["s"].alias("start"), (x["s"] + F.length(x["m"])).alias("end"), score(x["c"]).alias("score")
        ),
    )
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    return F.when(n > 0, spans).otherwise(F.array()).cast(_SPAN)


def find(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with a column ``pii_spans``: kind, start, end (code points, end
    exclusive) and score, by kind in the order of ``kinds``, then by start."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    cut = docs.select("*", *[F.split(whole, k.pattern, -1).alias(f"_pii_{k.name}") for k in kinds])
    names = docs.columns
    matched = cut.select(
        *[f"`{c}`" for c in names],
        *[f"_pii_{k.name}" for k in kinds],
        *[
            F.when(F.size(f"_pii_{k.name}") > 1, F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0)))
            .otherwise(F.array().cast("array<string>"))
            .alias(f"_pii_m_{k.name}")
            for k in kinds
        ],
    )
    spans = F.concat(*[_spans(k, F.col(f"_pii_{k.name}"), F.col(f"_pii_m_{k.name}")) for k in kinds])
    return matched.select(*[f"`{c}`" for c in names], spans.alias("pii_spans"))


def redact(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets."""
    found = find(docs, text, kinds)
    ordered = F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k"))))
    empty = F.array().cast("array<struct<s:int,e:int,k:string>>")

    def join(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"), last["k"].alias("k"))
        overlaps = F.when(F.size(acc) > 0, x["s"] < last["e"]).otherwise(False)
        return F.when(overlaps, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    merged = F.when(F.size(ordered) > 0, F.aggregate(ordered, empty, join)).otherwise(empty)
    names = [c for c in docs.columns]
    staged = found.select(*[f"`{c}`" for c in names], merged.alias("_pii_merged"))
    spans, whole = F.col("_pii_merged"), F.col(f"`{text}`").cast("string")

    def part(i: Column) -> Column:
        before = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["e"])
        gap = F.substr(whole, before + 1, F.get(spans, i)["s"] - before)
        return F.concat(gap, F.lit("["), F.upper(F.get(spans, i)["k"]), F.lit("]"))

    n = F.size(spans)
    masked = F.concat(
        F.array_join(F.transform(F.sequence(F.lit(0), n - 1), part), ""), F.substr(whole, F.get(spans, n - 1)["e"] + 1)
    )
    return staged.select(*[F.when(n > 0, masked).otherwise(whole).alias(c) if c == text else F.col(f"`{c}`") for c in names])


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kinds(names: list[str]) -> Column:
    return F.filter("pii_spans", lambda s: s["kind"].isin(names))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii_spans")
    base = [k.name for k in KINDS if k.base]
    return found.select(
        "doc_id",
        *[F.size(_of_kinds([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_written(_of_kinds(base)), 256).alias("base_sha256"),
        _written(F.col("pii_spans")).alias("spans"),
    )
