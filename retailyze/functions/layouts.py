"""Text to timestamps with layouts voted per column.

ISO, year-first, eight-digit and named-month texts say themselves how to be read.
``1/2/2016`` doesn't: one aggregate counts, per column, how many of its numeric
dates can be read month first and how many day first, and the whole column is read
in the order that reads more (a tie: month first). A date that only the other order
could read is then a bad value, as a column has one layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import with_stats

# Shapes of date texts (a time of day may follow), month names, and the two-digit
# years that belong to the 20th century.
_DAY, _MONTH = r"(0?[1-9]|[12]\d|3[01])", r"(0?[1-9]|1[0-2])"
_REST = r"((?:[ T].*)?)$"
#: How most texts look already: nothing has to be turned around.
ISO = r"^\d{4}-\d"
MONTH_FIRST = rf"^{_MONTH}[/.\-]{_DAY}[/.\-](\d{{4}}){_REST}"
DAY_FIRST = rf"^{_DAY}[/.\-]{_MONTH}[/.\-](\d{{4}}){_REST}"
SHORT_1900 = r"^(?<d>\d{1,2}[/.\-]\d{1,2}[/.\-])(?<y>69|[7-9]\d)(?!\d)"
SHORT_2000 = r"^(?<d>\d{1,2}[/.\-]\d{1,2}[/.\-])(?<y>\d{2})(?!\d)"
EIGHT_DIGITS_OR_YEAR_FIRST = rf"^(\d{{4}})(?:(\d{{2}})(\d{{2}})|[/.](\d{{1,2}})[/.](\d{{1,2}})){_REST}"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_NAME = (rf"(?i:({_MONTHS.replace(' ', '|')})(?:(?<=jan)uary|(?<=feb)ruary|(?<=mar)ch|(?<=apr)il|(?<=jun)e|(?<=jul)y|(?<=aug)ust"
         "|(?<=sep)(?:t|tember)|(?<=oct)ober|(?<=nov|dec)ember)?)")
MONTH_DAY = rf"^{_NAME}\.? +(\d{{1,2}}),? +(\d{{4}}){_REST}"
DAY_MONTH = rf"^(\d{{1,2}})[ \-]+{_NAME}\.?[ \-,]+(\d{{4}}){_REST}"


#: What votes: a numeric date in one order, its year of two or four digits.
VOTE_MONTH_FIRST = rf"^{_MONTH}[/.\-]{_DAY}[/.\-](\d{{4}}|\d{{2}}){_REST}"
VOTE_DAY_FIRST = rf"^{_DAY}[/.\-]{_MONTH}[/.\-](\d{{4}}|\d{{2}}){_REST}"


#: How numeric dates and year-first or eight-digit ones begin; a text of one of these
#: beginnings, or of neither, can only have the shapes that begin so.
NUMERIC_START, YEAR_START = r"^\d{1,2}[/.\-]\d", r"^\d{4}"


def _trimmed(c: str) -> Column:
    return F.btrim(F.col(f"`{c}`").cast("string"), F.lit(" \t\r\n"))


def day_first_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``<i>_yes`` / ``<i>_no``, texts of the i-th column that can be read day
    first / month first."""
    return df.agg(*[F.count_if(_trimmed(c).rlike(p)).alias(f"{i}_{n}") for i, c in enumerate(cols)
                    for n, p in (("yes", VOTE_DAY_FIRST), ("no", VOTE_MONTH_FIRST))])


def day_first_votes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, a boolean per column: is it read day first?"""
    return day_first_counts(df, cols).select(*[(F.col(f"{i}_yes") > F.col(f"{i}_no")).alias(c) for i, c in enumerate(cols)])


def _numeric(s: Column, day_first: Column) -> Column:
    # two whole replacements: with the pattern given as a column, Spark would compile
    # it anew wherever one row's columns differ in their order
    return (F.when(day_first, F.regexp_replace(s, DAY_FIRST, "$3-$2-$1$4"))
             .otherwise(F.regexp_replace(s, MONTH_FIRST, "$3-$1-$2$4")))


def iso_text(s: Column, day_first: Column) -> Column:
    """A trimmed text with its date as year-month-day (a named month by its first three
    letters), other texts as they are. Only shapes are matched, nothing is parsed; how
    a text begins tells which shape it can have, so one replacement is tried on it."""
    whole = F.regexp_replace(F.regexp_replace(s, SHORT_1900, "${d}19${y}"), SHORT_2000, "${d}20${y}")
    numeric = F.when(s.rlike(SHORT_2000), _numeric(whole, day_first)).otherwise(_numeric(s, day_first))
    year_first = F.regexp_replace(s, EIGHT_DIGITS_OR_YEAR_FIRST, "$1-$2$4-$3$5$6")
    named = (F.when(s < ":", F.regexp_replace(s, DAY_MONTH, "$3-$2-$1$4"))  # digits are before the colon, letters behind
              .otherwise(F.regexp_replace(s, MONTH_DAY, "$3-$1-$2$4")))
    return F.when(s.rlike(NUMERIC_START), numeric).when(s.rlike(YEAR_START), year_first).otherwise(named)


def read_iso(t: Column) -> Column:
    """An ``iso_text`` as a timestamp, NULL if it is none. Each shape has one parser, so
    good texts are parsed once and few bad ones at all."""
    month = F.instr(F.lit(_MONTHS), F.lower(F.substring(t, 6, 3)))
    numbered = F.concat(F.substring(t, 1, 5), F.floor((month + 3) / 4).cast("string"), F.substring(t, 9, 3))
    return (F.when((F.substring(t, 6, 1) >= "A") & t.rlike(r"^\d{4}-[A-Za-z]{3}-"),
                   # without a time of day the month's number is put in, as a parser of names is slow
                   F.when(t.rlike(r"^.{9}\d{1,2}\z"), F.when(month > 0, F.try_to_timestamp(numbered)))
                    .otherwise(F.try_to_timestamp(t, F.lit("yyyy-MMM-d[ H:mm[:ss]]"))))
             .when(F.right(t, F.lit(1)).isin("m", "M") & t.rlike(r"(?i)^\d{4}-.* \d+:\d+.*[ap]m$"),
                   F.try_to_timestamp(F.upper(F.regexp_replace(t, r" *([AaPp][Mm])$", " $1")), F.lit("yyyy-M-d h:mm[:ss] a")))
             .when(t.rlike(r"^[+\-]?\d{4}"), F.try_to_timestamp(t)))


def text_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, (T.StringType, T.CharType, T.VarcharType))]


def parse_dates(df: DataFrame, cols: Sequence[str], votes_from: DataFrame | None = None,
                votes: DataFrame | None = None) -> DataFrame:
    """``df`` with the given columns as timestamps. Text columns are voted on over
    ``votes_from`` (default: ``df``), or the one row ``votes`` has been counted before;
    dates and timestamps are only cast."""
    text = text_columns(df, cols)
    out = df.withColumns({c: F.col(f"`{c}`").try_cast("timestamp") for c in cols if c not in text})
    if not text:
        return out
    marks = {c: f"_day_first_{i}" for i, c in enumerate(text)}
    if votes is None:
        votes = day_first_votes(votes_from if votes_from is not None else df, text)
    votes = votes.select(*[F.col(f"`{c}`").alias(m) for c, m in marks.items()])
    out = with_stats(out, votes)
    # one function over all texts, not a copy of it for each: else the code that Spark
    # generates for the stage gets too long for the JVM to compile, and is interpreted
    day_first = F.array(*[F.col(m) for m in marks.values()])
    iso = F.transform(F.array(*[_trimmed(c) for c in text]),
                      lambda s, i: F.when((F.substring(s, 5, 1) == "-") & s.rlike(ISO), s).otherwise(iso_text(s, F.get(day_first, i))))
    out = out.withColumn("_iso_texts", iso)
    return out.withColumns({c: read_iso(F.get("_iso_texts", F.lit(i))) for i, c in enumerate(text)}).drop("_iso_texts", *marks.values())
