"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

All of it is expressions on one row, so nothing moves between tasks. A pattern cuts a text into
matches and the gaps between them; their lengths, summed up, are the positions. Patterns use
possessive forms and begin only where a run begins, so that a text of one long run takes linear
time and no deep stack; they match what their plain forms match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _begin(chars: str) -> str:
    return rf"(?:\G|(?<!{chars}))"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether a code of digits and capitals, its first four moved to the end, leaves 1 by 97."""
    turned = F.concat(F.substring(code, 5, 99), F.substring(code, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _ip_valid(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


def _card_valid(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(14, 19) & luhn(digits)


@dataclass(frozen=True)
class Kind:
    """How one kind is proposed and confirmed; ``least`` is the score below which it is left out."""

    name: str
    pattern: str
    #: A cheap pattern without which the full one cannot match.
    guard: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    least: float = 0.0


_ALWAYS = lambda m: F.lit(True)

#: The first four are the base kinds, in the order that breaks ties of their starts.
KINDS = (
    Kind(
        "email",
        _begin("[A-Za-z0-9._%+-]") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        _ALWAYS,
        0.9,
        "mail|contact|write|@",
    ),
    Kind("ip", _begin("[0-9]") + r"[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _ip_valid, 0.6, "ip|host|server|addr"),
    Kind(
        "card",
        _begin("[0-9]") + r"[0-9](?:[\x20-]?+[0-9])++",
        "[0-9]{2}|[0-9][ -][0-9]",
        _card_valid,
        0.7,
        "card|visa|master|amex|credit|pay",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        lambda m: F.length(_digits(m)).between(10, 15),
        0.6,
        "phone|tel|call|fax|mobile",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}[A-Z0-9]",
        mod97,
        0.8,
        "iban|bank|account|konto|cuenta|compte",
    ),
    # No checksum: only words nearby make a hexadecimal string a secret.
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])",
        "[0-9a-f]{32}",
        _ALWAYS,
        0.2,
        "token|secret|key|password|passwd",
        0.5,
    ),
)
BASE = 4
#: A text without these, or so long a secret of letters only, has no spans.
_SIGNS = "@0123456789"
_LETTERS_ONLY = "[a-f]{32}"
#: Characters on either side of a match in which context words count, and what they add.
CONTEXT_CHARS = 30
CONTEXT_GAIN = 0.3


def in_blocks(values: Column) -> Column:
    """A filled array cut into arrays of about the square root of its size.

    Slicing and appending copy their whole array, so n steps over blocks cost n ** 1.5 and not n ** 2.
    """
    size = F.ceil(F.sqrt(F.size(values))).cast("int")
    starts = F.sequence(F.lit(1), F.size(values), size)
    return F.transform(starts, lambda start: F.slice(values, start, size))


def running_total(values: Column) -> Column:
    """For each value of a filled array, the sum of those before it; ``values`` should be a plain column."""

    def sums(terms: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(terms, F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + of(t))))

    inner = F.transform(in_blocks(values), lambda block: sums(block, lambda v: v))
    before = sums(inner, lambda part: F.element_at(part, -1))
    moved = F.zip_with(
        inner,
        F.slice(before, F.lit(1), F.size(inner)),
        lambda part, base: F.transform(F.slice(part, F.lit(1), F.size(part) - 1), lambda x: x + base),
    )
    return F.flatten(moved)


def _spans(kind: Kind, order: int, matches: Column, gaps: Column, before: Column) -> Column:
    """All confirmed spans of a kind, with position, score and order; gaps lie around the matches."""
    near = rf"(?i){kind.context}"

    def span(match: Column, i: Column) -> Column:
        left = F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS))
        right = F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS))
        told = left.rlike(near) | right.rlike(near)
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(told, CONTEXT_GAIN).otherwise(0.0))
        return F.struct(match.alias("match"), F.char_length(F.get(gaps, i)).alias("gap"), score.alias("score"))

    found = F.arrays_zip(F.transform(matches, span).alias("m"), before.alias("before"))
    placed = F.transform(
        found,
        lambda f: F.struct(
            (f["before"] + f["m"]["gap"]).alias("start"),
            F.lit(order).alias("order"),
            (f["before"] + f["m"]["gap"] + F.char_length(f["m"]["match"])).alias("end"),
            F.lit(kind.name).alias("kind"),
            f["m"]["score"].alias("score"),
            f["m"]["match"].alias("value"),
        ),
    )
    return F.filter(placed, lambda s: kind.valid(s["value"]) & (s["score"] >= kind.least))


_SPAN = "array<struct<start:int,order:int,end:int,kind:string,score:double,value:string>>"


def _free(names: list[str], taken: list[str]) -> list[str]:
    """Column names that are not taken, whatever the case of those that are."""
    taken, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def find(docs: DataFrame, text_column: str = "text", output: str = "pii") -> DataFrame:
    """``docs`` with ``output``: an array of spans (start, order, end, kind, score, value).

    Positions count code points, ends are exclusive, spans are ordered by start, then as KINDS lists
    them. Within a kind, matches are leftmost and do not overlap; those that fail their check are left
    out and not tried again. Null and empty texts have no spans. All columns are kept; one named
    ``pii`` is replaced. Rows are independent of each other.
    """
    parts = [(k, f"_{k.name}_match", f"_{k.name}_gap", f"_{k.name}_size", f"_{k.name}_before") for k in KINDS]
    names = iter(_free([name for _, *four in parts for name in four], docs.columns))
    parts = [(k, *(next(names) for _ in range(4))) for k in KINDS]
    text = F.coalesce(F.col(text_column), F.lit(""))
    # Each step is a projection of its own and its columns are read more than once by the next, so the
    # optimiser keeps them apart: inside a lambda an expression is evaluated anew for every element.
    signs = reduce(or_, (text.contains(sign) for sign in _SIGNS)) | text.rlike(_LETTERS_ONLY)
    (signed,) = _free(["_signed"], [*docs.columns, *(name for _, *four in parts for name in four)])
    found = docs.withColumn(signed, signs).withColumns(
        {
            match: F.when(F.col(signed) & text.rlike(k.guard), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)))
            for k, match, *_ in parts
        }
    )
    found = found.withColumns({gap: F.when(F.size(m) > 0, F.split(text, k.pattern, -1)) for k, m, gap, *_ in parts})
    # Before match i: i whole pairs of gap and match, and gap i.
    found = found.withColumns(
        {
            size: F.zip_with(
                F.transform(m, F.char_length), F.transform(gap, F.char_length), lambda a, b: F.coalesce(a, F.lit(0)) + b
            )
            for _, m, gap, size, _ in parts
        }
    )
    found = found.withColumns({before: running_total(F.col(size)) for *_, size, before in parts})
    none = F.array().cast(_SPAN)
    spans = [
        F.when(
            F.size(m) > 0, _spans(k, i, F.col(m), F.col(gap), F.slice(before, F.lit(1), F.size(m))).cast(_SPAN)
        ).otherwise(none)
        for i, (k, m, gap, _, before) in enumerate(parts)
    ]
    helpers = [signed, *(name for _, *four in parts for name in four)]
    return found.withColumn(output, F.array_sort(F.concat(*spans))).drop(*helpers)


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; same columns.

    Of spans that overlap, the first names the kind, and all of their characters go. A null text stays null;
    texts without spans, repeated rows and very long texts are treated like any other.
    """
    text = F.col(text_column)
    none = F.array().cast("array<string>")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(acc["piece"], acc["at"] - acc["base"] + 1, s["start"] - acc["at"])
        part = F.when(s["start"] >= acc["at"], F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            acc["done"].alias("done"),
            acc["base"].alias("base"),
            acc["piece"].alias("piece"),
            F.concat(acc["parts"], F.array(part)).alias("parts"),
        )

    def block(acc: Column, spans: Column) -> Column:
        # A place in a text is found by walking up to it, so each block walks through its own piece only.
        stop = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.aggregate(
            spans,
            F.struct(
                acc["at"].alias("at"),
                acc["done"].alias("done"),
                acc["at"].alias("base"),
                F.substring(text, acc["at"] + 1, stop - acc["at"]).alias("piece"),
                none.alias("parts"),
            ),
            step,
            lambda a: F.struct(
                a["at"].alias("at"), F.concat(a["done"], F.array(F.array_join(a["parts"], ""))).alias("done")
            ),
        )

    (spans,) = _free(["pii"], docs.columns)
    done = F.aggregate(
        in_blocks(F.col(spans)),
        F.struct(F.lit(0).alias("at"), none.alias("done")),
        block,
        lambda acc: F.concat(F.array_join(acc["done"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    marked = find(docs, text_column, spans)
    return marked.withColumn(text_column, F.when(F.size(spans) > 0, done).otherwise(text)).drop(spans)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
