"""Labels and small texts of the reports, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order of the stages, and rules that give reasons of one kind one name.
STAGES = ("cheap", "temporal", "dedup", "variety")
REASON_RULES = (
    (r"^\d+ objects? found, \d+ wanted$|^0 objects found$", "too few objects found"),
    (r"^close copy of .+$", "close copy of another picture"),
    (r"^redundant frame.*$", "redundant frame of a sequence"),
    (r"^picture too small.*$", "picture too small"),
)


def reason_kind(reason: Column) -> Column:
    """The first rule's name that matches; `(no reason)` for null or empty; else the reason itself."""
    out = F.when(reason.isNull() | (reason == ""), F.lit("(no reason)"))
    for pattern, name in REASON_RULES:
        out = out.when(reason.rlike(pattern), F.lit(name))
    return out.otherwise(reason)


def criterion(stage: Column, reason: Column) -> Column:
    """`stage / kind of reason`."""
    return F.concat(F.coalesce(F.nullif(stage, F.lit("")), F.lit("(no stage)")), F.lit(" / "), reason_kind(reason))


def stage_rank(stage: Column) -> Column:
    """0 .. 3 in pipeline order, 99 for others."""
    out = None
    for i, s in enumerate(STAGES):
        out = F.when(stage == s, i) if out is None else out.when(stage == s, i)
    return out.otherwise(99)


def percent(part: Column, whole: Column) -> Column:
    """`12.3%`; `-` of nothing."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, "-").otherwise(F.format_string("%.1f%%", F.lit(100.0) * part / F.nullif(whole, F.lit(0))))


def percent_comma(part: Column, whole: Column) -> Column:
    """`12,34` with a decimal comma; `0,00` of nothing."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, "0,00").otherwise(F.replace(F.format_string("%.2f", F.lit(100.0) * part / F.nullif(whole, F.lit(0))), F.lit("."), F.lit(",")))


def decimal_comma(text: Column) -> Column:
    """DOUBLE of a number with a decimal comma, perhaps with blanks or `%`; null if it is none."""
    return F.replace(F.regexp_replace(text, r"[%\s]", ""), F.lit(","), F.lit(".")).try_cast("double")


def model_spec(text: Column) -> Column:
    """`name=weights[:class[:size]]` as a struct; class 0 and size 640 where left out."""
    name, rest = F.split_part(text, F.lit("="), F.lit(1)), F.split_part(text, F.lit("="), F.lit(2))
    part = lambda i: F.nullif(F.split_part(rest, F.lit(":"), F.lit(i)), F.lit(""))
    return F.struct(name.alias("name"), part(1).alias("weights"), F.coalesce(part(2).try_cast("int"), F.lit(0)).alias("class_id"), F.coalesce(part(3).try_cast("int"), F.lit(640)).alias("image_size"))


def manual_part(readme: Column, marker: str) -> Column:
    """What follows the end marker of the generated part; all of it if there is no marker."""
    return F.when(F.contains(readme, F.lit(marker)), F.substring_index(readme, marker, -1)).otherwise(readme)


def three_places(x: Column) -> Column:
    """A double of under 1e12 with three places, rounded as C's `%.3f`: by its exact binary value, exact ties to even.

    Java's format rounds the shortest decimal that stands for the double, so it goes up where that ends in a 5.
    """
    exact = x.cast("decimal(38,24)")
    whole = F.floor(exact * F.lit(1000))
    rest = exact * F.lit(1000) - whole
    # Where the shortest decimal is a tie, the sign of 2000 x - (2 whole + 1), from halves of x whose products are exact.
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    over = (high * F.lit(2000.0) - (whole * 2 + 1).cast("double")) + (x - high) * F.lit(2000.0)
    up = F.when(rest == F.lit(0.5).cast("decimal(2,1)"), (over > 0) | ((over == 0) & (F.pmod(whole, F.lit(2)) == 1))).otherwise(rest > F.lit(0.5).cast("decimal(2,1)"))
    n = whole + up.cast("int")
    text = (n.cast("decimal(30,0)") / F.lit(1000)).cast("decimal(30,3)").cast("string")
    return F.when((x < 0) & (n == 0), "-0.000").otherwise(text)
