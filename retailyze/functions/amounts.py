"""Money text to numbers, by a grammar with the decimal mark voted per column.

    amount   = ["("] [sign] {symbol | letters} [sign] number {symbol | letters} ["-"] [")"]
    number   = digits and marks [exponent]       (blanks and apostrophes count as nothing)

Most numbers tell their decimal mark: ``1.234,50``, ``12,5``, ``1,234,567``, ``0.125``.
``1.234`` doesn't; one aggregate counts per column the numbers that tell, and the
mark that more of them use (a tie: the point) decides for the rest. What is no
amount of this grammar is NULL, never another number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import with_stats

# The grammar as patterns.
_UNIT = r"(?:\p{Sc}|[A-Za-z]+\.?)*"
AMOUNT = rf"^\(?[+\-]?{_UNIT}[+\-]?((?:\d[\d.,]*|[.,]\d+)(?:[eE][+\-]?\d{{1,2}})?){_UNIT}-?\)?$"
NOTHING = "[\\s  '’]"


def _certain(mark: str, other: str) -> str:
    """Mantissas whose decimal mark is ``mark`` (both given as patterns)."""
    return (rf"^(?:\d{{1,3}}(?:{other}\d{{3}})+{mark}\d*|\d{{1,3}}(?:{other}\d{{3}}){{2,}}"
            rf"|\d*{mark}(?:\d{{1,2}}|\d{{4,}})|\d+{mark}|(?:\d{{4,}}|0\d*|){mark}\d{{3}})$")


POINT, COMMA = _certain(r"\.", ","), _certain(",", r"\.")
OPEN = r"^[1-9]\d{0,2}[.,]\d{3}$"


#: Numbers as programs write them, a sign of money in front at most, need no grammar:
#: their point is no thousands mark.
SIGNS = "$€£¥"
SIMPLE = rf"^-?[{SIGNS}]?\d+(?:\.(?:\d{{1,2}}|\d{{4,}}))?$"


def _split(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``_s<i>``: the text without blanks, ``_p<i>``: mantissa and exponent of each
    column that is no simple number, and ``_kinds``: what kinds of numbers they are (_kind).
    Each step is a projection of its own, so that no pattern is matched twice. The kinds
    come from one function over all columns, not a copy of it for each: else the code that
    Spark generates for the stage gets too long for the JVM to compile, and is interpreted."""
    df = df.withColumns({f"_s{i}": F.btrim(F.col(f"`{c}`").cast("string"), F.lit(" ")) for i, c in enumerate(cols)})
    df = df.withColumns({f"_p{i}": F.col(f"_s{i}").rlike(SIMPLE) for i in range(len(cols))})
    df = df.withColumns({f"_s{i}": F.when(F.col(f"_p{i}"), F.translate(f"_s{i}", SIGNS, "")).otherwise(
        F.regexp_replace(f"_s{i}", NOTHING, "")) for i in range(len(cols))})
    df = df.withColumns({f"_p{i}": F.when(~F.col(f"_p{i}"), F.split(F.lower(F.regexp_extract(f"_s{i}", AMOUNT, 1)), "e"))
                         for i in range(len(cols))})
    return df.withColumn("_kinds", F.transform(F.array(*[F.col(f"_p{i}") for i in range(len(cols))]),
                                           lambda p: _kind(F.get(p, F.lit(0)), F.size(p) > 1)))


def _kind(m: Column, scientific: Column) -> Column:
    """A mantissa has digits alone, tells a decimal point or comma, or leaves it open;
    NULL: none of them."""
    return (F.when(m.rlike(r"^\d+$"), "digits")
             .when(m.rlike(POINT), "point").when(m.rlike(COMMA), "comma")
             .when(m.rlike(r"^\d+\.\d{3}$"), F.when(scientific, "point").when(m.rlike(OPEN), "open"))
             .when(m.rlike(r"^\d+,\d{3}$"), F.when(scientific, "comma").when(m.rlike(OPEN), "open")))


def comma_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``<i>_yes`` / ``<i>_no``, numbers of the i-th column that tell a decimal
    comma / point."""
    aggs = []
    for i in range(len(cols)):
        k = F.get("_kinds", F.lit(i))
        simple = F.col(f"_p{i}").isNull() & F.col(f"_s{i}").contains(".")
        aggs += [F.count_if(k == "comma").alias(f"{i}_yes"), F.count_if(simple | (k == "point")).alias(f"{i}_no")]
    return _split(df.select(*[F.col(f"`{c}`") for c in cols]), cols).agg(*aggs)


def comma_votes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, a boolean per column: is its decimal mark the comma?"""
    return comma_counts(df, cols).select(*[(F.col(f"{i}_yes") > F.col(f"{i}_no")).alias(c) for i, c in enumerate(cols)])


def _number(i: int, comma: Column, to: str) -> Column:
    """The split text's number without its sign, by the grammar and the column's decimal
    mark; a simple number as it stands."""
    m, k, power = F.get(F.col(f"_p{i}"), F.lit(0)), F.get("_kinds", F.lit(i)), F.get(F.col(f"_p{i}"), F.lit(1))
    by_comma = (k == "comma") | ((k == "open") & comma)
    text = F.when(by_comma, F.translate(m, ",.", ".")).when(k.isNotNull(), F.translate(m, ",", ""))
    text = F.concat(text, F.coalesce(F.concat(F.lit("E"), power), F.lit("")))
    return F.when(F.col(f"_p{i}").isNull(), F.col(f"_s{i}")).otherwise(text).try_cast(to)


def _negative(i: int) -> Column:
    s = F.col(f"_s{i}")
    # the sign of the exponent isn't the amount's
    unit = F.when(F.size(f"_p{i}") > 1, F.regexp_replace(s, r"[eE][+\-]?\d{1,2}", "")).otherwise(s)
    return F.col(f"_p{i}").isNotNull() & (s.startswith("(") | unit.contains("-"))


def parse_amounts(df: DataFrame, cols: Sequence[str], to: str = "decimal(18,2)",
                  votes_from: DataFrame | None = None, votes: DataFrame | None = None) -> DataFrame:
    """``df`` with the given text columns as numbers of type ``to``; the decimal mark
    is voted on over ``votes_from`` (default: ``df``), or the one row ``votes`` has
    been counted before."""
    if not cols:
        return df
    marks = {c: f"_comma_{i}" for i, c in enumerate(cols)}
    if votes is None:
        votes = comma_votes(votes_from if votes_from is not None else df, cols)
    votes = votes.select(*[F.col(f"`{c}`").alias(m) for c, m in marks.items()])
    out = _split(with_stats(df, votes), cols)
    out = out.withColumns({c: _number(i, F.col(m), to) for i, (c, m) in enumerate(marks.items())})
    return out.withColumns({c: F.when(_negative(i), -F.col(f"`{c}`")).otherwise(F.col(f"`{c}`")) for i, c in enumerate(cols)}).select(
        *[F.col(f"`{c}`") for c in df.columns])
