"""Raw CSV files: one header line, all columns read as text, lines that are no rows told apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill import fixed_values as V
from snapmill.functions.casts import DATE, parse
from snapmill.schemas import SnapshotTable

#: Quotes inside quoted values are doubled.
_QUOTING = {"escape": '"'}
#: Read and written as they are: a line is one column, and nothing in it is a quote.
_WHOLE_LINES = {"header": True, "quote": "", "escape": ""}

#: Beside the table's columns: what is wrong with a line, null for good ones; its text and its file.
FAULT, LINE, FILE = "__fault", "__line", "__file"
OPEN_QUOTE, TOO_FEW, TOO_MANY = FAULTS = ("open_quote", "too_few_fields", "too_many_fields")

_CORRUPT = "__corrupt"


def _header(spark: SparkSession, table: SnapshotTable, path: str) -> list[str]:
    header = spark.read.options(header=True, **_QUOTING).csv(path).columns
    absent = set(table.columns) - set(header)
    if absent:
        raise ValueError(f"{path}: no column {', '.join(sorted(absent))} for {table.name}")
    return header


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _fields(line: Column) -> Column:
    """Delimited fields of a line; delimiters within quoted fields do not count."""
    bare = F.regexp_replace(line, '(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.size(F.split(bare, ",", -1))


def parse_raw(
    spark: SparkSession, table: SnapshotTable, path: str, line_breaks: bool = False, suspects: bool = False, files: bool = True
) -> DataFrame:
    """All lines of a raw table: its columns as text, and FAULT, LINE and FILE.

    Columns are found by header name, whatever their order; that reads one line. Files whose
    header differs from the first one are refused instead of being misread by position. A line
    with an odd number of quotes, or with other than the header's number of fields, is at fault:
    its columns are whatever could be read, LINE is its text. Empty lines are no lines.

    Without ``line_breaks`` every line is a row of its own, and files are split across tasks; a
    quoted line break shows as two lines with an open quote. With it a quoted line break belongs
    to its value, and a file, which cannot be split then, is streamed by one task. A quote that
    is never closed takes following lines along; such a record, known by a value that holds
    a line's worth of delimiters after a line break or by its number of fields, is at fault as a whole.

    ``suspects`` is for whoever wants the lines at fault only: lines without a quote that have as
    many delimiters as the header are left out before they are parsed. Records are all read.
    Without ``files`` there is no FILE: a scan that knows its files adds them to every row, wanted or not.
    """
    header = _header(spark, table, path)
    lines = _parse_records(spark, header, path, files) if line_breaks else _parse_lines(spark, header, path, suspects, files)
    return lines.select(*map(_quoted, table.columns), FAULT, LINE, *_file(files))


def _file(files: bool) -> list[str]:
    return [FILE] if files else []


def read_lines(spark: SparkSession, path: str, files: bool = False) -> DataFrame:
    """The lines below the headers as they are, as LINE, and if asked for their FILE."""
    reader = spark.read.options(**_WHOLE_LINES, sep="\n")
    (title,) = reader.csv(path).columns
    rows = reader.options(enforceSchema=False).schema(T.StructType([T.StructField(title, T.StringType())])).csv(path)
    return rows.select(F.col(_quoted(title)).alias(LINE), *[F.col("_metadata.file_path").alias(f) for f in _file(files)])


def _parse_lines(spark: SparkSession, header: list[str], path: str, suspects: bool, files: bool) -> DataFrame:
    lines = read_lines(spark, path, files)
    schema = ", ".join(f"{_quoted(c)} string" for c in [*header, _CORRUPT])
    line = F.col(LINE)
    if suspects:
        delimiters = F.char_length(line) - F.char_length(F.replace(line, F.lit(","), F.lit("")))
        lines = lines.where(line.contains('"') | (delimiters != len(header) - 1))
    quoted = line.contains('"')
    read = F.struct(
        # no quote, no need of a parser: one delimiter more than there should be ends the search for more
        F.when(~quoted, F.split(line, ",", len(header) + 1)).alias("plain"),
        F.when(quoted, F.from_csv(line, schema, {**_QUOTING, "columnNameOfCorruptRecord": _CORRUPT})).alias("row"),
    )
    # Conditions on what was read stay behind an explode. Pushed down to the scan they would parse every
    # line again for each of their parts.
    read = lines.select("*", F.explode(F.array(read)).alias("read")).select(*lines.columns, "read.*")
    plain, quotes = F.col("plain"), F.char_length(line) - F.char_length(F.replace(line, F.lit('"'), F.lit("")))
    fault = (
        F.when(plain.isNotNull(), F.when(F.size(plain) < len(header), TOO_FEW).when(F.size(plain) > len(header), TOO_MANY))
        .when(quotes % 2 == 1, OPEN_QUOTE)
        .when(F.col(f"row.{_CORRUPT}").isNotNull(), F.when(_fields(line) < len(header), TOO_FEW).otherwise(TOO_MANY))
    )
    values = [
        F.when(plain.isNotNull(), F.nullif(F.get(plain, F.lit(i)), F.lit(""))).otherwise(F.col(f"row.{_quoted(c)}")).alias(c)
        for i, c in enumerate(header)
    ]
    return read.select(*values, fault.alias(FAULT), *lines.columns)


def _parse_records(spark: SparkSession, header: list[str], path: str, files: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    options = {"header": True, "enforceSchema": False, "multiLine": True, "columnNameOfCorruptRecord": _CORRUPT}
    read = spark.read.schema(schema).options(**_QUOTING, **options).csv(path)
    values = F.array(*[F.col(_quoted(c)) for c in header])
    took_lines = F.exists(values, lambda v: v.contains("\n") & (F.size(F.split(v, ",", -1)) >= len(header)))
    corrupt = F.col(_CORRUPT)
    fault = F.when(took_lines | corrupt.contains("\n"), OPEN_QUOTE).when(
        corrupt.isNotNull(), F.when(_fields(corrupt) < len(header), TOO_FEW).otherwise(TOO_MANY)
    )
    text = F.coalesce(corrupt, F.to_csv(F.struct(*[F.col(_quoted(c)) for c in header]), _QUOTING))
    return read.withColumns({FAULT: fault, LINE: text, **{f: F.col("_metadata.file_path") for f in _file(files)}})


def read_raw(spark: SparkSession, table: SnapshotTable, path: str, line_breaks: bool = False) -> DataFrame:
    """The rows of a raw table as text, in the table's column order, without lines at fault."""
    lines = parse_raw(spark, table, path, line_breaks, files=False)
    return lines.where(F.col(FAULT).isNull()).select(*map(_quoted, table.columns))


def dated(raw: DataFrame) -> DataFrame:
    """Raw rows with the snapshot as a date, the column they will be partitioned by."""
    return raw.withColumn(V.SNAPSHOT, parse(F.col(V.SNAPSHOT), DATE))


def write_raw(df: DataFrame, path: str) -> None:
    """Write a table the way raw files look: CSV with header and doubled quotes."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def append_lines(lines: DataFrame, header: str, path: str) -> None:
    """Add files of lines as they are, each below the header; ``lines`` has one text column."""
    kept_space = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.toDF(header).write.mode("append").options(**_WHOLE_LINES, **kept_space, sep="\u0001").csv(path)
