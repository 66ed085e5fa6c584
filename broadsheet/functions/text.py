"""Text and date expressions of the article tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blank characters of the word split (no vertical tab), the blank characters
# of a Unicode-aware strip, and the default pieces of the chunker and of the search analyzer.
BLANKS = r"[ \t\n\f\r]+"
NON_BLANK = r"[^ \t\n\f\r]"
UNICODE_BLANKS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)
CHUNK_TOKEN = r"[ \t\n\f\r]*[^ \t\n\f\r]+"
WORD = r"[\p{L}\p{N}]+"


def days_between(published: Column, modified: Column) -> Column:
    """Calendar-day boundaries crossed from ``published`` to ``modified``."""
    return F.datediff(modified, published)


def paragraph_count(content: Column) -> Column:
    return F.array_size(content).cast("bigint")


def word_count(content: Column) -> Column:
    """Blank-separated pieces summed over the paragraphs; an empty paragraph has one piece."""
    pieces = F.aggregate(
        content,
        F.lit(0).cast("bigint"),
        lambda total, p: total + F.when(p.isNull(), F.lit(0)).otherwise(F.size(F.split(p, BLANKS))),
    )
    return F.coalesce(pieces, F.lit(0).cast("bigint"))


def year_month(stamp: Column) -> dict[str, Column]:
    """The ``year`` and ``month`` columns of a stamp."""
    return {"year": F.year(stamp), "month": F.month(stamp)}


def row_id(*keys: Column) -> Column:
    """Surrogate key from the row's own key, so that a rebuild gives the same one."""
    texts = [F.coalesce(k.cast("string"), F.lit("\u0002")) for k in keys]
    return F.sha2(F.concat_ws("\u0001", *texts), 256)


def fingerprint(columns: list[str]) -> Column:
    """Hash that identifies a whole row; reads every value, so use it only where needed."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256)


def tie_break(columns: list[str]) -> Column:
    """Cheap hash for a stable choice among rows that are equal in what decides."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def merge_paragraphs(content: Column) -> Column:
    return F.array_join(content, " ")


def is_blank(text: Column) -> Column:
    """True when nothing is left of ``text`` after a Unicode-aware strip."""
    return ~text.rlike(f"[^{UNICODE_BLANKS}]")


def tokenize(text: Column) -> Column:
    """Tokens that keep their leading blanks, so joining them gives the text back."""
    return F.regexp_extract_all(text, F.lit(CHUNK_TOKEN), F.lit(0))


def analyze(text: Column) -> Column:
    """Search terms: lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


_ZONE = r"(Z|UTC|[+-]\d\d(?::?\d\d)?)$"


def iso_text(stamp: Column) -> Column:
    """A stamp text in the form Spark casts: seconds before a zone, no blank before it."""
    with_seconds = F.regexp_replace(F.trim(stamp), r"([T ]\d\d:\d\d) ?" + _ZONE, "$1:00$2")
    return F.regexp_replace(with_seconds, r"(:\d\d(?:\.\d+)?) +" + _ZONE, "$1$2")


def as_utc_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
