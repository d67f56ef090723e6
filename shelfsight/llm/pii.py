"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

DataFrame functions only. Every kind is found leftmost and non-overlapping over the whole
text. Positions come from the lengths of the pieces between the matches, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """``pattern`` runs in linear time: its loops are possessive, and it begins only where
    a run of its first class begins or where the match before ended."""

    name: str
    pattern: str
    near: str
    score: float
    base: bool = True


#: In the order in which spans that begin together are listed.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"e-?mail|contact|write|schreib|correo|courriel",
        0.9,
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"\bip\b|address|host|server|login",
        0.6,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"card|visa|master|credit|karte|tarjeta|carte",
        0.7,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"phone|tel|call|mobil|fax", 0.7),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        r"iban|account|bank|konto|cuenta|compte",
        0.8,
        base=False,
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+().-])[(]?0[0-9]{1,4}[)]?[\x20./-]?[0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![0-9.-])",
        r"phone|tel|call|mobil|fax|whatsapp",
        0.3,
        base=False,
    ),
)
NAMES = tuple(k.name for k in KINDS)
#: Spans of the kinds beyond the base ones need this score.
LEAST_SCORE = 0.6
_NEAR_BONUS = 0.4
_NEAR_CHARS = 40

_SPANS = "array<struct<start:int,kind:int,end:int,score:double>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a text of digits has a Luhn check sum of 0."""
    total = F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum")),
        lambda acc, c: F.struct(
            (acc["i"] + 1).alias("i"),
            (
                acc["sum"]
                + F.when(acc["i"] % 2 == 0, F.coalesce(c.try_cast("int"), F.lit(0))).otherwise(
                    # doubled digits above 9 lose 9
                    F.coalesce(c.try_cast("int"), F.lit(0)) * 2
                    - F.when(F.coalesce(c.try_cast("int"), F.lit(0)) > 4, 9).otherwise(0)
                )
            ).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """True if letters and digits, first four moved behind and letters read as 10 to 35, are 1 mod 97."""
    code = F.regexp_replace(iban, r"\x20", "")
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c.rlike("^[A-Z]$"), (acc * 100 + F.ascii(c) - 55) % 97)
        .when(c.rlike("^[0-9]$"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise(acc),
    )
    return rest == 1


def _confirmed(kind: Kind, match: Column) -> Column:
    if kind.name == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind.name == "card":
        digits = _digits(match)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.name == "iban":
        return F.length(F.regexp_replace(match, r"\x20", "")).between(15, 34) & mod97(match)
    return F.lit(True)


def _possible(kind: Kind, text: Column) -> Column:
    """What every match of the kind's pattern implies, and cheaper to look for."""
    signs = {"email": "@", "phone": "+", "local_phone": "0"}
    if kind.name in signs:
        return text.contains(signs[kind.name])
    parts = {"ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "iban": "[A-Z]{2}[0-9]{2}"}
    return text.rlike(parts[kind.name])


def _spans(number: int, kind: Kind, text: Column) -> Column:
    """All confirmed spans of one kind, in order of their start."""
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    walked = F.aggregate(
        F.arrays_zip(
            F.slice(pieces, F.lit(1), F.size(matches)).alias("piece"), matches.alias("match")
        ),
        F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<start:int,match:string>>").alias("found"),
        ),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["piece"]) + F.length(x["match"])).alias("at"),
            F.concat(
                acc["found"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(x["piece"])).alias("start"), x["match"].alias("match")
                    )
                ),
            ).alias("found"),
        ),
        lambda acc: acc["found"],
    )

    def scored(span: Column) -> Column:
        begin = F.greatest(span["start"] - _NEAR_CHARS, F.lit(0))
        around = F.lower(F.substring(text, begin + 1, span["start"] - begin))
        near = F.when(around.rlike(kind.near), _NEAR_BONUS).otherwise(0.0)
        return F.struct(
            span["start"].alias("start"),
            F.lit(number).alias("kind"),
            (span["start"] + F.length(span["match"])).alias("end"),
            F.least(F.lit(1.0), F.lit(kind.score) + near).alias("score"),
        )

    found = F.transform(F.filter(walked, lambda s: _confirmed(kind, s["match"])), scored)
    if not kind.base:
        found = F.filter(found, lambda s: s["score"] >= LEAST_SCORE)
    # texts that cannot hold a match are not split
    possible = _possible(kind, text)
    return F.when(possible, found).otherwise(F.array()).cast(_SPANS)


def find_personal_data(docs: DataFrame, into: str = "pii") -> DataFrame:
    """Adds the column ``into``: every span (start, kind, end, score), by start, then kind as in KINDS.

    Starts count code points from 0, ends are exclusive, spans of different kinds may
    overlap. Base kinds are exactly their confirmed matches: a match that fails its check is
    dropped and nothing else is tried there. The other kinds need a score of LEAST_SCORE,
    which nearby words can lift them to. Null and empty texts have no spans; rows, doubled
    ones too, and further columns stay as they are; a column named ``into`` is replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    each = docs.withColumns({f"__{k.name}": _spans(i, k, text) for i, k in enumerate(KINDS)})
    kept = [c for c in docs.columns if c != into]
    return each.select(*kept, F.array_sort(F.concat(*(f"__{n}" for n in NAMES))).alias(into))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(n) for n in NAMES))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(found: DataFrame, spans: str = "pii") -> DataFrame:
    """Replace what the spans in a column cover by the kind in brackets; drops the column.

    Spans that overlap become one, named after the first. A null text stays null.
    """
    names = F.array(*(F.lit(f"[{n.upper()}]") for n in NAMES))
    text = F.col("text")
    walked = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.array(
                        F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                        F.get(names, s["kind"]),
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(
            F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))
        ),
    )
    redacted = F.when(F.size(spans) > 0, walked).otherwise(text)
    return found.select(
        *(redacted.alias("text") if c == "text" else F.col(c) for c in found.columns if c != spans)
    )
