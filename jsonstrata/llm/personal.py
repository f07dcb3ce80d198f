"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is SQL functions within a row: nothing is shuffled, so no key can be hot, and the work
grows with the length of the texts. Patterns start at the edge of a run of their characters (or
where the last match ended) and don't step back, so that a long run is read once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters before and after a span, up to its neighbour of the same kind, in which words count as near.
NEAR = 48
#: What a word nearby adds to a score, of 100.
NEARBY = 35
#: Matches whose lengths are summed one by one; longer lists are summed in blocks of so many.
BLOCK = 128

#: Fixed value: an address part of at most 255, with any number of zeros before it.
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """A pattern whose leftmost non-overlapping matches count where ``valid`` holds.

    ``score`` (of 100) is that of a valid match, ``words`` near it raise it. ``apart``: a letter or
    digit directly before or after the match makes it invalid.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: int
    words: tuple[str, ...]
    apart: bool = False


def _digits(match: Column, others: str) -> Column:
    return F.translate(match, others, "")


def _card(match: Column) -> Column:
    digits = _digits(match, " -")
    return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)


def _mod_97(match: Column) -> Column:
    """The check of an account number: its first four characters last, letters as 10 to 35, leave 1."""
    compact = _digits(match, " ")
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))
    code = lambda c: F.ascii(c)
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda total, c: F.when(code(c) < 65, (total * 10 + code(c) - 48) % 97).otherwise((total * 100 + code(c) - 55) % 97),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


#: Fixed patterns. The first four are the base; the others are added to them.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        60,
        ("mail", "email", "contact", "write"),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
        40,
        ("ip", "address", "host", "server", "login"),
    ),
    Kind(
        # A shorter run holds no card; it is passed over at no more than 16 places of 16 steps.
        "card",
        r"[0-9](?:[\x20-]?[0-9]){15,}+",
        _card,
        50,
        ("card", "credit", "visa", "payment"),
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(_digits(m, "+ ().-")).between(8, 15),
        50,
        ("phone", "tel", "call", "mobile", "fax"),
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,}+|(?:\x20[A-Z0-9]{4})++(?:\x20[A-Z0-9]{1,3})?)",
        _mod_97,
        60,
        ("iban", "account", "bank"),
        apart=True,
    ),
    Kind(
        # Below the usual least score: it takes a word nearby.
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda m: ~m.rlike(r"^(?:000|666|9)|-00-|-0000$"),
        20,
        ("ssn", "social", "security"),
        apart=True,
    ),
)
BASE = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ends(lengths: Column) -> Column:
    """Running sums of a bound list: by blocks, so that a list of n lengths costs about n times half a block."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    number = (F.size(lengths) - 1) / F.lit(BLOCK)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(number).cast("int")), lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    )
    return _let(
        blocks,
        lambda sums: _let(
            F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b))),
            lambda before: F.transform(
                lengths,
                lambda _, i: F.get(before, F.floor(i / F.lit(BLOCK)).cast("int"))
                + total(F.slice(lengths, F.floor(i / F.lit(BLOCK)).cast("int") * BLOCK + 1, i % BLOCK + 1)),
            ),
        ),
    )


def near_pattern(kind: Kind) -> str:
    """What the words near a span are found by, once A to Z are in lower case."""
    return f"(?:^|[^a-z])(?:{'|'.join(kind.words)})(?:[^a-z]|$)"


def _spans(text: Column, kind: Kind) -> Column:
    def judged(match: Column, before: Column, after: Column) -> Column:
        lower = lambda x: F.translate(x, UPPER, UPPER.lower())
        near = lower(F.right(before, F.lit(NEAR))).rlike(near_pattern(kind)) | lower(F.left(after, F.lit(NEAR))).rlike(near_pattern(kind))
        valid = kind.valid(match)
        if kind.apart:
            valid = valid & ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")
        return F.when(valid, F.lit(kind.score) + F.when(near, NEARBY).otherwise(0))

    def found(match: Column) -> Column:
        return _let(
            F.split(text, kind.pattern, -1),
            lambda gaps: _let(
                _let(F.transform(match, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long")), _ends),
                lambda ends: F.transform(
                    match,
                    lambda m, i: F.struct(
                        F.lit(kind.name).alias("kind"),
                        (F.get(ends, i) - F.length(m)).alias("start"),
                        F.get(ends, i).alias("end"),
                        judged(m, F.get(gaps, i), F.get(gaps, i + 1)).cast("int").alias("score"),
                    ),
                ),
            ),
        )

    every = _let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), found)
    return F.when(text.rlike(kind.pattern), every).otherwise(F.array().cast(SPANS))


def find_personal(
    docs: DataFrame,
    kinds: tuple[Kind, ...] = KINDS,
    least: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The personal data of every document: (doc_id, spans), one row for each row of ``docs``.

    ``spans`` are structs of kind, start and end in code points (end exclusive) and a score of up to
    100, in the order of ``kinds`` and then of their start. A span is a match of its kind's pattern
    that its validator confirms (Luhn's checksum, mod 97, ranges of numbers) and whose score is at
    least ``least``; words of its kind within ``NEAR`` characters raise the score. A match that
    fails is not tried again from within. A null or empty text has no spans; ids may be null or
    repeated; an empty table gives no rows; other columns may have any name.
    """
    text = F.coalesce(col(text_column), F.lit(""))
    every = F.concat(*(_spans(F.col("_text"), kind) for kind in kinds))
    return (
        docs.select(col(id_column).alias("doc_id"), text.alias("_text"))
        .select("doc_id", F.filter(every, lambda s: s["score"] >= least).alias("spans"))
    )
