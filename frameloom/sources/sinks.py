"""What the curation steps write: lists, indexes, datasets as plans of files, class maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_list(df: DataFrame, value: Column, order: list[Column | str], path: str) -> None:
    """Lines in a total order, as text files whose names sort in it."""
    df.withColumn("__value", value).orderBy(*order).select(F.col("__value").alias("value")).write.mode("overwrite").text(path)


def write_index(df: DataFrame, key: str, path: str) -> None:
    """JSON lines in the order of the key, nulls written too."""
    df.orderBy(key).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_by_dataset(df: DataFrame, path: str, column: str = "dataset", rows_per_file: int = 1_000_000) -> None:
    """A Parquet folder per dataset; a large dataset is spread over a task per `rows_per_file` rows. Rows are counted first."""
    parts = df.groupBy(column).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("__parts")).withColumnRenamed(column, "__of")
    salted = df.join(parts, df[column].eqNullSafe(F.col("__of"))).repartition(F.col(column), F.pmod(F.xxhash64(*df.columns), F.col("__parts")))
    salted.drop("__of", "__parts").write.mode("overwrite").partitionBy(column).option("maxRecordsPerFile", rows_per_file).parquet(path)


def overlap_flags(df: DataFrame) -> Column:
    """A flag line: name, class, confidence, containment and label line between tabs."""
    return F.concat_ws("\t", "name", "class_name", F.format_string("conf=%.2f", "conf"), F.format_string("containment=%.2f", "containment"), "label")


def class_map_yaml(names: list[str], splits: dict[str, str], root: str = ".") -> str:
    """Text of a class map with numbered names."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    lines = [f"path: {quote(root)}", *(f"{k}: {quote(v)}" for k, v in splits.items()), f"nc: {len(names)}", "names:", *(f"  {i}: {quote(n)}" for i, n in enumerate(names))]
    return "\n".join(lines) + "\n"


def class_map(text: str) -> dict[int, str]:
    """Names by number of a class map, whose names are a list or a map numbered from 0; errors name what is wrong."""
    import yaml

    data = yaml.safe_load(text) or {}
    names = data.get("names")
    got = dict(enumerate(names)) if isinstance(names, list) else names
    if not isinstance(got, dict) or not got:
        raise ValueError("names must be a list or a map")
    if any(not isinstance(k, int) or isinstance(k, bool) for k in got):
        raise ValueError("class ids must be whole numbers")
    if sorted(got) != list(range(len(got))):
        raise ValueError("class ids must go from 0 without gaps")
    if "nc" in data and data["nc"] != len(got):
        raise ValueError(f"nc is {data['nc']}, {len(got)} names are given")
    return {int(k): str(v) for k, v in got.items()}


def class_spec(spec: str, names: dict[int, str], presets: dict[str, list[int]] | None = None) -> list[int]:
    """Class numbers of a comma-separated list of numbers, names or presets, in order, each once; unknown ones are errors."""
    by_name = {n.lower(): i for i, n in sorted(names.items(), reverse=True)}
    out: list[int] = []
    for part in (p.strip() for p in spec.split(",")):
        if not part:
            continue
        if presets and part in presets:
            found = presets[part]
        elif part.isdigit():
            found = [int(part)]
        elif part.lower() in by_name:
            found = [by_name[part.lower()]]
        else:
            raise ValueError(f"unknown class {part!r}")
        for c in found:
            if c not in names:
                raise ValueError(f"class {c} is not in the class map")
            if c not in out:
                out.append(c)
    return out


def virtual_dataset(boxes: DataFrame, classes: list[int]) -> DataFrame:
    """Boxes of the classes only; pictures left with none aren't in it. No picture is copied."""
    return boxes.where(F.col("class_id").isin(*classes))


def filtered_dataset(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Every picture with its (already mapped) boxes; one without any keeps a row of null class: an empty label file."""
    return images.join(boxes, "image_id", "left")


def copy_plan(images: DataFrame, labels: DataFrame, source: str = "path") -> DataFrame:
    """(path, label, has_label, to) of the files a materialized split holds; a picture without labels gets an empty file."""
    j = images.join(labels.select("image_id", F.lit(True).alias("__l")).distinct(), "image_id", "left")
    name = F.substring_index(source, "/", -1)
    return j.select(source, F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit(".txt")).alias("label"), F.col("__l").isNotNull().alias("has_label"), name.alias("to"))


def catalog_markdown(cat: DataFrame) -> DataFrame:
    """Table rows of a catalog as Markdown text, one per dataset, in order of the dataset."""
    cell = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-"))
    number = lambda c: cell(F.regexp_replace(F.col(c).cast("decimal(20,10)").cast("string"), r"\.?0+$", ""))  # noqa: E731  (no exponent)
    row = F.concat(F.lit("| "), F.concat_ws(" | ", "dataset", cell("workspace_id"), F.when(F.col("enabled"), "yes").otherwise("no"), F.coalesce(F.array_join("class_names", ", "), F.lit("-")), cell("variety_min"), number("closeup"), number("faraway"), cell("phash_max")), F.lit(" |"))
    return cat.select("dataset", row.alias("line")).orderBy("dataset")
