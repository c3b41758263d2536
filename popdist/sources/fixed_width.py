"""Fixed-width text readers (survey prescription and person files).

A line is read as one text column and every field is a ``substring`` of
it, trimmed, blank -> null.  Fields that are not selected are never
computed (column pruning happens in the projection), so reading 5 fields
of a 1 501-field line costs 5 substrings.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference: prescription file layout,
# (name, 0-based start, end exclusive); the last field runs to the line end.
PRESCRIPTION_SPECS = (
    ("DUID", 0, 7), ("PID", 7, 10), ("DUPERSID", 10, 20), ("DRUGIDX", 20, 33),
    ("RXRECIDX", 33, 52), ("LINKIDX", 52, 68), ("PANEL", 68, 70), ("PURCHRD", 70, 71),
    ("RXBEGMM", 71, 74), ("RXBEGYRX", 74, 78), ("RXNAME", 78, 128), ("RXDRGNAM", 128, 188),
    ("RXNDC", 188, 199), ("RXQUANTY", 199, 206), ("RXFORM", 206, 256), ("RXFRMUNT", 256, 306),
    ("RXSTRENG", 306, 356), ("RXSTRUNT", 356, 406), ("RXDAYSUP", 406, 409), ("PHARTP1", 409, 412),
    ("PHARTP2", 412, 414), ("PHARTP3", 414, 416), ("PHARTP4", 416, 418), ("PHARTP5", 418, 420),
    ("PHARTP6", 420, 422), ("PHARTP7", 422, 424), ("PHARTP8", 424, 426), ("PHARTP9", 426, 428),
    ("RXFLG", 428, 429), ("IMPFLAG", 429, 430), ("PCIMPFLG", 430, 431), ("DIABEQUIP", 431, 432),
    ("INPCFLG", 432, 433), ("PREGCAT", 433, 436), ("TC1", 436, 439), ("TC1S1", 439, 442),
    ("TC1S1_1", 442, 445), ("TC1S1_2", 445, 448), ("TC1S2", 448, 451), ("TC1S2_1", 451, 454),
    ("TC1S3", 454, 456), ("TC1S3_1", 456, 458), ("TC2", 458, 461), ("TC2S1", 461, 464),
    ("TC2S1_1", 464, 467), ("TC2S1_2", 467, 470), ("TC2S2", 470, 473), ("TC3", 473, 476),
    ("TC3S1", 476, 479), ("TC3S1_1", 479, 482), ("RXSF18X", 482, 490), ("RXMR18X", 490, 498),
    ("RXMD18X", 498, 506), ("RXPV18X", 506, 514), ("RXVA18X", 514, 522), ("RXTR18X", 522, 529),
    ("RXOF18X", 529, 536), ("RXSL18X", 536, 543), ("RXWC18X", 543, 550), ("RXOT18X", 550, 558),
    ("RXOR18X", 558, 566), ("RXOU18X", 566, 573), ("RXXP18X", 573, 581), ("PERWT18F", 581, 593),
    ("VARSTR", 593, 597), ("VARPSU", 597, None),
)

# Fixed values that must equal the reference: the person-file fields that
# are read (the file has 1 501 fields; only these five are used).
PERSON_SPECS = (
    ("DUPERSID", 10, 20), ("REGION18", 83, 85), ("AGELAST", 183, 185), ("SEX", 191, 192),
    ("PERWT18F", 4320, 4332),
)
PERSON_COLUMNS = ("DUPERSID", "PERWT18F", "REGION18", "SEX", "AGELAST")


def field(line: Column, start: int, end: int | None) -> Column:
    """One fixed-width field: trimmed text, blank -> null."""
    length = (1 << 30) if end is None else end - start
    return F.nullif(F.trim(F.substring(line, start + 1, length)), F.lit(""))


def parse_fixed_width(lines: DataFrame, specs: Sequence[tuple[str, int, int | None]],
                      columns: Sequence[str] | None = None, line_col: str = "value") -> DataFrame:
    """Project the wanted fields out of a one-column DataFrame of lines."""
    wanted = [s for s in specs if columns is None or s[0] in columns]
    if columns is not None:
        order = {c: i for i, c in enumerate(columns)}
        wanted.sort(key=lambda s: order[s[0]])
    line = F.col(line_col)
    return lines.select(*[field(line, a, b).alias(n) for n, a, b in wanted])


def read_fixed_width(spark: SparkSession, path: str, specs, columns=None) -> DataFrame:
    return parse_fixed_width(spark.read.text(path), specs, columns)


def strip_digits(df: DataFrame) -> DataFrame:
    """Remove year digits from column names (REGION18 -> REGION)."""
    return df.toDF(*[re.sub(r"\d+", "", c) for c in df.columns])


def read_person_file(spark: SparkSession, path: str) -> DataFrame:
    """Person file, five fields, year digits stripped from the names."""
    return strip_digits(read_fixed_width(spark, path, PERSON_SPECS, PERSON_COLUMNS))


def format_fixed_width(df: DataFrame, specs, width: int | None = None) -> DataFrame:
    """The inverse: one text line per row, each field left-aligned in its
    span (used to stage survey-shaped files from tables).  A value wider than
    its span raises an error."""
    end = width or max(b or a + 1 for _, a, b in specs)
    by_start = sorted(specs, key=lambda s: s[1])
    parts, pos = [], 0
    for name, a, b in by_start:
        if a > pos:
            parts.append(F.lit(" " * (a - pos)))
        span = (b or end) - a
        if name in df.columns:
            value = F.coalesce(F.col(name).cast("string"), F.lit(""))
            wide = F.raise_error(F.concat(F.lit(f"{name} is wider than {span}: "), value)).cast("string")
            parts.append(F.when(F.char_length(value) > span, wide).otherwise(F.rpad(value, span, " ")))
        else:
            parts.append(F.lit(" " * span))
        pos = a + span
    return df.select(F.concat(*parts).alias("value"))


def write_fixed_width(df: DataFrame, specs, path: str, width: int | None = None) -> None:
    """``df`` staged as fixed-width lines, gzip files that ``read_fixed_width``
    reads as they are: most of a line is the blanks of fields that a stand-in
    lacks, and they take no disk.  A file is one writing task's, so its lines
    need not be split."""
    format_fixed_width(df, specs, width).write.mode("overwrite").option("compression", "gzip").text(path)
