"""Delimited readers: vocabulary files (pipe, no header, trailing
delimiter), directory files (tab, header, Windows-1252), comma CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference: vocabulary file layouts.  The
# last name, ``test``, is the empty field after the closing delimiter.
RXNCONSO_COLUMNS = ("RXCUI", "LAT", "TS", "LUI", "STT", "SUI", "ISPREF", "RXAUI", "SAUI", "SCUI",
                    "SDUI", "SAB", "TTY", "CODE", "STR", "SRL", "SUPPRESS", "CVF", "test")
RXNREL_COLUMNS = ("RXCUI1", "RXAUI1", "STYPE1", "REL", "RXCUI2", "RXAUI2", "STYPE2", "RELA", "RUI",
                  "SRUI", "SAB", "SL", "DIR", "RG", "SUPPRESS", "CVF", "test")
RXNSAT_COLUMNS = ("RXCUI", "LUI", "SUI", "RXAUI", "STYPE", "CODE", "ATUI", "SATUI", "ATN", "SAB",
                  "ATV", "SUPPRESS", "CVF", "test")

# Text read as missing by the delimited readers (the default missing-value
# tokens of the pandas reader the reference uses).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def null_tokens(c: Column) -> Column:
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def _fields(line: str, names: Sequence[str], wanted: Sequence[str]) -> list[Column]:
    """The wanted fields of a pipe line; the others are never made."""
    parts = F.split(F.col(line), r"\|", -1)
    return [null_tokens(F.get(parts, F.lit(list(names).index(n)))).alias(n) for n in wanted]


def _whole(line: str, names: Sequence[str]) -> Column:
    """Whether a line has exactly the layout's fields, from its delimiters alone."""
    return F.length(line) - F.length(F.replace(F.col(line), F.lit("|"), F.lit(""))) == len(names) - 1


def read_pipe(spark: SparkSession, path: str, names: Sequence[str], keep_last: bool = False,
              columns: Sequence[str] | None = None) -> DataFrame:
    """Pipe-delimited text without header; every field is text, a ``"`` is
    data, empty lines are skipped.  The trailing empty field is dropped unless
    asked for.  A line with too few or too many fields is an error; the check
    counts delimiters, so only the fields in ``columns`` are parsed."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    broken = F.raise_error(F.concat(F.lit(f"not {len(names)} fields: "), F.substring("value", 1, 200))).cast("boolean")
    lines = lines.where(F.when(_whole("value", names), F.lit(True)).otherwise(broken))
    return lines.select(*_fields("value", names, columns or (names if keep_last else names[:-1])))


class TooManyBadLines(ValueError):
    """More of a file's lines are broken than its reader was told to accept."""


def read_pipe_checked(spark: SparkSession, path: str, names: Sequence[str], quarantine: str,
                      most_bad: float = 0.001, columns: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """The whole lines of ``path``, and the numbers of whole and broken lines.

    One cheap pass counts both kinds and writes the broken lines, with their
    file, to the ``quarantine`` folder as Parquet; when they are more than the
    share ``most_bad``, the read fails (and the quarantine stays for a look).
    The rows themselves are read lazily, with the wanted fields only."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    ok = _whole("value", names)
    seen = Observation()
    told = lines.observe(seen, F.count_if(ok).alias("whole"), F.count_if(~ok).alias("broken"))
    told.where(~ok).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).write.mode(
        "overwrite").parquet(quarantine)
    counts = {k: int(v) for k, v in seen.get.items()}
    if counts["broken"] > most_bad * sum(counts.values()):
        raise TooManyBadLines(f"{counts['broken']} of {sum(counts.values())} lines of {path} have other than {len(names)} fields; "
                              f"see {quarantine}")
    return lines.where(ok).select(*_fields("value", names, columns or names[:-1])), counts


def write_pipe(df: DataFrame, path: str) -> None:
    """Write rows as pipe-delimited lines with a closing delimiter."""
    line = F.concat(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]),
                    F.lit("|"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


# The characters of Windows-1252 from 0x80 to 0x9F; five bytes are undefined.
CP1252 = {
    0x80: "\u20ac", 0x82: "\u201a", 0x83: "\u0192", 0x84: "\u201e", 0x85: "\u2026", 0x86: "\u2020", 0x87: "\u2021",
    0x88: "\u02c6", 0x89: "\u2030", 0x8A: "\u0160", 0x8B: "\u2039", 0x8C: "\u0152", 0x8E: "\u017d",
    0x91: "\u2018", 0x92: "\u2019", 0x93: "\u201c", 0x94: "\u201d", 0x95: "\u2022", 0x96: "\u2013", 0x97: "\u2014",
    0x98: "\u02dc", 0x99: "\u2122", 0x9A: "\u0161", 0x9B: "\u203a", 0x9C: "\u0153", 0x9E: "\u017e", 0x9F: "\u0178",
}
_BYTES, _CHARACTERS = "".join(map(chr, CP1252)), "".join(CP1252.values())
_UNDEFINED = "[\u0081\u008d\u008f\u0090\u009d]"


def from_cp1252(c: Column, undefined: str = "raise") -> Column:
    """Text that was read byte by byte (Latin-1) as Windows-1252.  A byte that
    Windows-1252 does not define is an error, or U+FFFD with ``"replace"``."""
    text = F.translate(c, _BYTES, _CHARACTERS)
    if undefined == "replace":
        return F.regexp_replace(text, _UNDEFINED, "\ufffd")
    return F.when(c.rlike(_UNDEFINED), F.raise_error(F.concat(F.lit("undefined Windows-1252 byte in: "), F.substring(text, 1, 200)))
                  .cast("string")).otherwise(text)


def read_tsv(spark: SparkSession, path: str, undefined: str = "raise") -> DataFrame:
    """Tab-separated Windows-1252 text with a header row; names from the
    header, every field text.  The bytes are read as Latin-1 and mapped by a
    column expression, so no session option is touched.  A line with other than
    the header's fields is an error."""
    rows = (spark.read.option("sep", "\t").option("header", True).option("encoding", "ISO-8859-1")
            .option("mode", "FAILFAST").option("columnPruning", False).csv(path))
    return rows.select(*[from_cp1252(F.col(f"`{c}`"), undefined).alias(c.translate(str.maketrans(_BYTES, _CHARACTERS)))
                         for c in rows.columns])


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated Windows-1252 text with a header row; a character that the
    encoding lacks is an error."""
    def encoded(c: str) -> Column:
        text = F.translate(F.col(f"`{c}`").cast("string"), _CHARACTERS, _BYTES)
        return F.when(text.rlike("[^\u0000-\u00ff]"), F.raise_error(F.concat(F.lit("not in Windows-1252: "), F.col(f"`{c}`").cast("string")))
                      .cast("string")).otherwise(text).alias(c.translate(str.maketrans(_CHARACTERS, _BYTES)))

    (df.select(*[encoded(c) for c in df.columns]).write.mode("overwrite")
     .option("sep", "\t").option("header", True).option("encoding", "ISO-8859-1").csv(path))


def read_csv_columns(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """Comma CSV: some columns, found by their name in the header wherever they
    stand and however many others there are; types from ``schema``.  A name
    that the header lacks, a value that does not parse and a line with other
    than the header's fields are errors."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").option("columnPruning", False).csv(path)
    return rows.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in columns])
