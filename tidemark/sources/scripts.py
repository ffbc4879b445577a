"""Migration files as rows: reading, naming, placeholders, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import version_text

SCRIPT_NAME = r"^V([0-9._]+)__(.*)\.sql$"
PLACEHOLDER = r"\$\{[^}]+\}"


def read_scripts(spark: SparkSession, folder: str, glob: str = "*.sql") -> DataFrame:
    """One row ``(path, text)`` per file below a folder; an empty file has none."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def file_name(path: Column | str) -> Column:
    """Last part of a path."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, r"[^/]*$", 0)


def resolve(files: DataFrame, name: str = "name") -> DataFrame:
    """Add version and description, read from the file name.

    Both are null for a file that does not follow the naming rule.
    """
    named = F.col(name).rlike(SCRIPT_NAME)
    version = F.regexp_extract(name, SCRIPT_NAME, 1)
    words = F.translate(F.regexp_extract(name, SCRIPT_NAME, 2), "_", " ")
    return files.withColumns(
        {"version": F.when(named, version), "description": F.when(named, words)}
    )


def substitute(text: Column | str, values: dict[str, Column | str], strict: bool = True) -> Column:
    """Replace ``${name}`` placeholders in one pass; values are not filled again.

    An unknown name fails the query if ``strict`` and stays as it is otherwise; a
    null value of a placeholder that occurs fails the query. Null stays null.
    """
    text = F.col(text) if isinstance(text, str) else text

    def filled(part: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("no value for placeholder "), part)).cast("string")
        new = F.when(part.rlike(f"^{PLACEHOLDER}$"), unknown).otherwise(part) if strict else part
        for name, value in values.items():
            value = F.lit(value) if isinstance(value, str) else value
            missing = F.raise_error(F.lit(f"null value for placeholder {name}")).cast("string")
            new = F.when(part == F.lit("${" + name + "}"), F.coalesce(value, missing)).otherwise(new)
        return new

    parts = F.regexp_extract_all(text, F.lit(PLACEHOLDER + r"|[^$]+|\$"), F.lit(0))
    return F.array_join(F.transform(parts, filled), "")


def script_checksum(text: Column | str) -> Column:
    """CRC-32 of the text, folded into the signed 32-bit range."""
    text = F.col(text) if isinstance(text, str) else text
    crc = F.crc32(text.cast("binary"))
    return F.when(crc >= 2**31, crc - 2**32).otherwise(crc).cast("int")


def changed_scripts(scripts: DataFrame, history: DataFrame) -> DataFrame:
    """Applied scripts whose text no longer has the recorded checksum.

    ``scripts`` has version and text, ``history`` the recorded rows. A history
    row without a checksum cannot tell.
    """
    recorded = history.filter("success AND checksum IS NOT NULL").select(
        version_text("version").alias("_version"), F.col("checksum").alias("recorded")
    )
    current = scripts.select(
        "version",
        version_text("version").alias("_version"),
        script_checksum("text").alias("current"),
    )
    return (
        current.join(recorded, "_version")
        .filter("recorded <> current")
        .select("version", "recorded", "current")
    )
