"""What is told by image paths and file names, as Column expressions (no UDFs).

All functions take and give Columns, map null to null, and ignore letter case where
they say so. Patterns use `\\z`, so a line end in a name is an ordinary character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of the three splits, and the largest digit run that is a frame number.
SPLIT_SPELLINGS = {"train": "train", "training": "train", "valid": "valid", "val": "valid", "validation": "valid", "test": "test", "testing": "test"}
LARGEST_FRAME = 100_000_000
EXPORT_MARK = r"(?:_(?:jpg|jpeg|png))?\.rf\.[0-9a-f]{32}\z"
TIMED_FRAME = r"(?s)\A(.*)_f([0-9]+)_t[0-9]+(?:\.[0-9]+)?\z"


def slashes(path: Column) -> Column:
    """Either kind of slash, repeated or not, as one forward slash."""
    p = F.when(F.contains(path, F.lit("\\")), F.replace(path, F.lit("\\"), F.lit("/"))).otherwise(path)
    return F.when(F.contains(p, F.lit("//")), F.regexp_replace(p, "/+", "/")).otherwise(p)


def levels(path: Column) -> Column:
    """The last four levels of a path, `<dataset>/<split>/images/<file>`; null where the third isn't `images`."""
    tail = F.substring_index(slashes(path), "/", -4)
    return F.when(F.substring_index(F.substring_index(tail, "/", -2), "/", 1) == "images", tail)


def level_dataset(tail: Column) -> Column:
    return F.substring_index(tail, "/", 1)


def level_split(tail: Column) -> Column:
    return F.substring_index(F.substring_index(tail, "/", -3), "/", 1)


def path_dataset(path: Column) -> Column:
    """`<dataset>` of `.../<dataset>/<split>/images/<file>`; null where the path ends otherwise."""
    return level_dataset(levels(path))


def path_split(path: Column) -> Column:
    """`<split>` of such a path; null where the path ends otherwise."""
    return level_split(levels(path))


def path_file(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -1), "\\", -1)


def split_spelling(split: Column) -> Column:
    """train, valid or test for any usual spelling, blanks and letter case ignored; else null."""
    said, out = F.lower(F.trim(split)), None
    for name in ("train", "valid", "test"):
        of = [k for k, v in SPLIT_SPELLINGS.items() if v == name]
        out = F.when(said.isin(of), name) if out is None else out.when(said.isin(of), name)
    return out


def stem(file: Column) -> Column:
    """The file name in lower case without its extension."""
    f = F.lower(file)
    return F.when(F.contains(f, F.lit(".")), F.left(f, F.length(f) - F.length(F.substring_index(f, ".", -1)) - 1)).otherwise(f)


def export_mark(file: Column) -> Column:
    """The 32 hex digits of the export mark in lower case; null where there is none."""
    return F.when(F.left(F.right(stem(file), F.lit(36)), F.lit(4)) == ".rf.", F.nullif(F.regexp_extract(stem(file), r"\.rf\.([0-9a-f]{32})\z", 1), F.lit("")))


def base_name(file: Column) -> Column:
    """Lower-case name without extension, export mark, all up to the first `__`, and mirror mark.

    Patterns are tried only where a plain comparison says that they may match.
    """
    s = stem(file)
    s = F.when(F.contains(s, F.lit(".rf.")), F.regexp_replace(s, EXPORT_MARK, "")).otherwise(s)
    at = F.instr(s, "__")
    s = F.when(at > 0, s.substr(at + 2, F.length(s))).otherwise(s)
    return F.when(F.endswith(s, F.lit("flip")), F.regexp_replace(s, r"[ _-]?flip\z", "")).otherwise(s)


def variant_base(file: Column) -> Column:
    """The file name without `.rf.<hash>.<extension>`, letter case kept: one name for all augmented variants."""
    return F.regexp_replace(file, r"(?i)\.rf\.[0-9a-f]+\.(?:jpg|jpeg|png)\z", "")


def _number(digits: Column) -> Column:
    """BIGINT of a digit run; null for an empty or null run or one beyond 18 digits without leading zeros."""
    return F.when((digits != "") & (F.length(F.ltrim(digits, F.lit("0"))) <= 18), digits.cast("bigint"))


def with_names(df: DataFrame, path: str = "image_path") -> DataFrame:
    """Adds __file, __base, __clip and __frame (both null for images of no clip; a clip's name may be empty).

    Each step is a projection of its own, so that nothing is computed twice.
    """
    base, digits = F.col("__base"), F.lit("0123456789")
    df = df.withColumn("__file", path_file(F.col(path))).withColumn("__base", base_name(F.col("__file")))
    df = df.withColumns({"__head": F.rtrim(base, digits), "__timed": F.when(F.contains(base, F.lit("_t")), F.nullif(F.regexp_extract(base, TIMED_FRAME, 2), F.lit("")))})
    df = df.withColumns({"__tail": _number(base.substr(F.length("__head") + 1, F.length("__base"))), "__at": _number(F.col("__timed"))})
    head, plain = F.col("__head"), F.col("__timed").isNull() & (F.col("__tail") <= LARGEST_FRAME)
    before = F.when(F.right(head, F.lit(1)).isin(" ", "_", "-"), F.left(head, F.length(head) - 1)).otherwise(head)
    df = df.withColumns({
        "__clip": F.when(F.col("__at").isNotNull(), F.regexp_extract(base, TIMED_FRAME, 1)).when(plain, before),
        "__frame": F.when(F.col("__at").isNotNull(), F.col("__at")).when(plain, F.col("__tail")),
    })
    return df.drop("__head", "__timed", "__tail", "__at")


def dataset_of_flat_name(name: Column) -> Column:
    """What precedes the first `__`; the whole name if there is none."""
    return F.split_part(name, F.lit("__"), F.lit(1))
