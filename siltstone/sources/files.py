"""Plain sources and sinks."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import registry_date, row_hash

REGISTRY = ("tag", "id_per", "first_name", "last_name", "birth_date", "id_org", "name_org", "start_date", "end_date", "relation")
#: Formats that a last-modified header may have, after its weekday.
DATE_FORMATS = ("dd MMM yyyy HH:mm:ss z", "dd-MMM-yy HH:mm:ss z", "MMM d HH:mm:ss yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssX", "yyyyMMddHHmmss")


def sequence_file(spark: SparkSession, path: str) -> DataFrame:
    """Key and value texts of a sequence file."""
    return spark.sparkContext.sequenceFile(path).toDF("page_id string, html string")


def write_sequence_file(rows: DataFrame, path: str) -> None:
    """(page_id, html) as a sequence file; the folder must be new."""
    rows.select("page_id", "html").rdd.map(tuple).saveAsSequenceFile(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """S3: path and collection of each line; comments and empty lines do not count."""
    part = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.regexp_like("value", F.lit(r"^\s*[^#\s]"))).select(part[0].alias("path"), F.get(part, F.lit(1)).alias("collection"))


def text_lines(spark: SparkSession, paths: str) -> DataFrame:
    """Lines of comma-joined paths."""
    return spark.read.text([p for p in paths.split(",") if p])


def text_records(spark: SparkSession, path: str) -> DataFrame:
    """File name and content of each file, without its line ends."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("page_id"), F.regexp_replace("value", r"\r?\n", "").alias("html"))


def parse_registry(lines: DataFrame) -> DataFrame:
    """Rows of ten parts, or nine without the tag; others are dropped. \\N and the zero date are null."""
    part = F.split("value", ",")
    shift = F.size(part) - 10
    at = lambda i: F.nullif(F.get(part, F.lit(i) + shift), F.lit("\\N"))
    cols = [(registry_date(at(i)) if name.endswith("_date") else at(i)).alias(name) for i, name in enumerate(REGISTRY)]
    return lines.where(F.size(part).isin(9, 10)).select(*cols, row_hash(F.col("value")).alias("row_hash"))


def simple_registry(lines: DataFrame) -> DataFrame:
    """Rows with both names and an organisation."""
    return parse_registry(lines).where("first_name <> '' and last_name <> '' and name_org <> ''")


def parse_exclusions(lines: DataFrame) -> DataFrame:
    """Name, tag1, synonym, tag2; rows may be short; the header line goes."""
    part = F.split("value", ",")
    return lines.select(*(F.coalesce(F.trim(F.get(part, F.lit(i))), F.lit("")).alias(c) for i, c in enumerate(("name", "tag1", "synonym", "tag2")))).where("name <> 'name' and name <> ''")


def _as_json(line: str | None) -> str | None:
    """A Python literal of a key and a dictionary as JSON; null if a line is none."""
    try:
        key, value = ast.literal_eval(line.strip())
        return json.dumps({"page": key, **value}) if isinstance(value, dict) else None
    except (ValueError, SyntaxError, TypeError, AttributeError, MemoryError, RecursionError):
        return None


def _literal(lines: Column) -> Column:
    """The annotator's own lines as JSON. Python's quoting is beyond patterns, so this is a vectorised function."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(_as_json)

    return run(lines)


def parse_annotations(lines: DataFrame) -> DataFrame:
    """Page, label, entity of JSON lines, or of the annotator's own literals `('key', {'named_entities': [...], ...})`
    with the names at the top or under ner; labels may be missing (null). Sentinels, lines under ten characters and lines
    that are neither have none."""
    ner = "named_entities: array<string>, named_entity_labels: array<string>"
    own = lines.where((F.length("value") >= 10) & F.rlike("value", F.lit(r"^\s*\("))).select(_literal(F.col("value")).alias("value"))
    other = lines.where((F.length("value") >= 10) & ~F.rlike("value", F.lit(r"^\s*\(|^[^{]*NO_TEXT"))).select("value")
    rows = own.union(other).select(F.from_json("value", f"page string, page_id string, {ner.replace(':', '')}, ner struct<{ner}>").alias("r"))
    names = F.coalesce("r.named_entities", "r.ner.named_entities")
    labels = F.coalesce("r.named_entity_labels", "r.ner.named_entity_labels", F.array().cast("array<string>"))
    found = rows.where(F.col("r").isNotNull()).select(F.coalesce("r.page", "r.page_id").alias("page"), F.arrays_zip(names.alias("n"), labels.alias("l")).alias("z"))
    return found.select("page", F.explode("z").alias("e")).select("page", F.col("e.l").alias("label"), F.col("e.n").alias("entity"))


def _full_years(header: Column) -> list[Column]:
    """Of a header whose year has two digits, the times in each century of 1970 to 2369, of which the weekday fits one at most."""
    part = lambda i: F.regexp_extract(header, r"^([A-Z][a-z]{2})[a-z]*, (\d{2}-[A-Za-z]{3}-)(\d{2})( .*)$", i)
    found = []
    for k in range(4):
        day = F.concat(part(2), (F.lit(19 + k) + (part(3) < "70").cast("int")).cast("string"), part(3))
        fits = F.date_format(F.try_to_timestamp(day, F.lit("dd-MMM-yyyy")), "EEE") == part(1)
        found.append(F.when(fits, F.try_to_timestamp(F.concat(day, part(4)), F.lit("dd-MMM-yyyy HH:mm:ss z"))))
    return found


def last_modified(header: Column) -> Column:
    """The first format that fits; null if none does. Years of two digits are those of 1970 to 2369 whose weekday the
    header says; without a weekday that fits they are from 2000 on."""
    return F.coalesce(*_full_years(header), *(F.try_to_timestamp(F.regexp_replace(header, "^[A-Za-z]{3,}day, |^[A-Z][a-z]{2},? (?=[0-9A-Z])", ""), F.lit(f)) for f in DATE_FORMATS))


def write_new(rows: DataFrame, path: str, single: bool = False, max_records: int = 0) -> None:
    """Parquet into a new folder, an existing one is an error; a single file only if asked for.

    Files of few rows take longer to open than to fill, so with max_records rows are dealt to all cores first, however few
    splits they come from."""
    spark = rows.sparkSession
    if single:
        rows = rows.coalesce(1)
    elif max_records:
        rows = rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows.write.mode("errorifexists").option("maxRecordsPerFile", max_records).parquet(path)


def write_dump(rows: DataFrame, path: str) -> None:
    """Semicolon-separated lines with a header."""
    rows.write.mode("errorifexists").csv(path, sep=";", header=True)


def write_segment(parts: dict[str, DataFrame], path: str, segment: str) -> None:
    """Each part of a segment as a table of its own, partitioned by segment."""
    for name, rows in parts.items():
        rows.withColumn("segment", F.lit(segment)).write.mode("append").partitionBy("segment").parquet(f"{path}/{name}")


def merge_sorted(tables: list[DataFrame], key: str) -> DataFrame:
    """One table in ranges of a key."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.repartitionByRange(key).sortWithinPartitions(key)


def append_ledger(paths: DataFrame, ledger: str) -> None:
    """Paths that are done (or failed), added to their ledger."""
    paths.select("path").write.mode("append").parquet(ledger)


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """The elements of a name in XML files as rows, by Spark's own XML source; bad elements have null columns."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE").schema(schema).load(path)
