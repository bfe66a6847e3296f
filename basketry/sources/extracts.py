"""Loading the seven CSV extracts: every check first, then the tables as Parquet.

An extract may be one file or a directory of parts under the file's name. All columns are
read as text, because Spark matches a given CSV schema by position and the extracts are
matched by name, then converted without raising: a value that cannot be read is null.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketry.operators.audit import MALFORMED, key_audit
from basketry.sources.generations import Generations
from basketry.sources.model import MODEL, MOMENT, TEXT, WHOLE, TableSpec, Tables
from basketry.sources.records import whole_records

# Texts that stand for a missing value.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Accepted ways to write a date, each rewritten to the ISO order before one conversion.
DATE_SHAPES = (
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
)

_BROKEN_LINE = "_broken_line"


def _path(data_dir: str, spec: TableSpec) -> str:
    return f"{data_dir}/{spec.file_name}"


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The physical lines of an extract, or None if it does not exist."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _present_lines(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The lines of every extract; all missing files are reported together."""
    lines = {name: _lines(spark, _path(data_dir, spec)) for name, spec in MODEL.items()}
    missing = sorted(MODEL[name].file_name for name, found in lines.items() if found is None)
    if missing:
        raise FileNotFoundError(
            f"{data_dir} lacks {len(missing)} extract(s): {', '.join(missing)}"
        )
    return lines


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def spans_lines(lines: DataFrame) -> bool:
    """Whether any record continues over a line break inside quotes.

    Such a record starts on a line with an odd number of quotes. Without one every line is a
    record; with one the records have to be found first.
    """
    return not lines.where(_quotes(F.col("value")) % 2 == 1).isEmpty()


def _has_surplus_fields(fields: int) -> Column:
    """Whether a line that does not fit the header has too many fields, not too few."""
    line = F.col(_BROKEN_LINE)
    unquoted = F.regexp_replace(line, r'"([^"]|"")*"', "")
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    return F.coalesce(separators >= fields, F.lit(False))


_FORMAT = {"escape": '"', "columnNameOfCorruptRecord": _BROKEN_LINE}


def read_text_columns(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """An extract with all its columns as text and a flag for rows with surplus fields.

    Both ways read a file in parallel splits.
    """
    reader = (
        spark.read.options(**_FORMAT)
        .option("header", True)
        # Pruned columns would hide that a line does not fit the header.
        .option("columnPruning", False)
        # Parts whose header names other columns, or in another order, are refused.
        .option("enforceSchema", False)
    )
    names = reader.option("multiLine", multi_line).csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in (*names, _BROKEN_LINE)])
    if multi_line:
        rows = _parsed(whole_records(spark, path), names, schema)
    else:
        rows = reader.option("multiLine", False).schema(schema).csv(path)
    return rows.select(
        *[F.col(f"`{name}`") for name in names],
        _has_surplus_fields(len(names)).alias(MALFORMED),
    )


def _parsed(records: DataFrame, names: list[str], schema: StructType) -> DataFrame:
    """Records as rows of text columns, without the header of each file."""
    types = ", ".join(f"`{field.name}` string" for field in schema)
    row = F.from_csv("record", types, _FORMAT)
    header = F.regexp_replace("record", "^\uFEFF", "")
    plain = ", ".join(f"c{at} string" for at in range(len(names)))
    heads = records.where("first").select(F.from_csv(header, plain, {"escape": '"'}).alias("head"))
    for found in heads.distinct().collect():
        if [name for name in found.head] != list(names):
            raise ValueError(f"the header of a part is not {','.join(names)}")
    return records.where("not first").select(row.alias("row")).select("row.*")


def _iso(text: Column) -> Column:
    return reduce(lambda value, shape: F.regexp_replace(value, *shape), DATE_SHAPES, text)


def _converted(name: str, spec: TableSpec) -> Column:
    column = F.col(f"`{name}`")
    text = F.when(~column.isin(*NULL_TOKENS), column)
    kind = spec.columns.get(name, TEXT)
    if kind == TEXT:
        value = text
    elif kind == MOMENT:
        value = _iso(F.trim(text)).try_cast(kind)
    elif kind == WHOLE:
        # Whole numbers may be written as 40.0 where a column has gaps; 40.5 is no whole number.
        number = text.try_cast("decimal(38,10)")
        value = F.when(number == F.floor(number), number).try_cast(kind)
    else:
        value = text.try_cast(kind)
    return value.alias(name)


def typed(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Null tokens as null and known columns in their types; further columns stay text."""
    names = [name for name in raw.columns if name != MALFORMED]
    kept = [MALFORMED] if MALFORMED in raw.columns else []
    return raw.select(*[_converted(name, spec) for name in names], *kept)


def _check_columns(name: str, raw: DataFrame) -> None:
    spec = MODEL[name]
    missing = sorted(spec.required - set(raw.columns))
    if missing:
        raise ValueError(
            f"no missing required column may be in {spec.file_name}, but: {', '.join(missing)}"
        )


def _check_audit(audit) -> None:
    """Raise for the first fault in one table's audit row."""
    name, spec = audit.table_name, MODEL[audit.table_name]
    if audit.malformed_rows:
        raise ValueError(
            f"{audit.malformed_rows} line(s) of {spec.file_name} hold more fields than its header"
        )
    nulls = [found.column_name for found in audit.null_identifiers if found.violations]
    if nulls:
        raise ValueError(
            f"{name}: every required identifier must be given; empty in {', '.join(nulls)}"
        )
    for found in audit.invalid_moments:
        if found.violations:
            raise ValueError(
                f"{found.violations} missing or invalid timestamp(s) in {name}.{found.column_name}"
            )
    if audit.duplicate_keys:
        raise ValueError(
            f"{audit.duplicate_keys} duplicate key values in {name}, whose key is "
            f"({', '.join(spec.key)})"
        )


def read_extracts(
    spark: SparkSession, data_dir: str, multi_line: Collection[str] | None = None
) -> Tables:
    """The extracts as typed tables; each checks its columns when it is opened.

    `multi_line` names the tables whose records may span lines; by default each extract is
    looked at.
    """
    lines = _present_lines(spark, data_dir)

    def opened(name: str) -> DataFrame:
        spec = MODEL[name]
        spans = spans_lines(lines[name]) if multi_line is None else name in multi_line
        raw = read_text_columns(spark, _path(data_dir, spec), spans)
        _check_columns(name, raw)
        return typed(raw, spec)

    return Tables({name: lambda name=name: opened(name) for name in MODEL})


def load_tables(
    spark: SparkSession,
    data_dir: str,
    tables_dir: str,
    multi_line: Collection[str] | None = None,
) -> dict[str, int]:
    """Write all tables as a new generation, check it, then publish it. Returns the row counts.

    The text is parsed and written once; the checks read what was written. Readers see the new
    tables all together, after every check of every table has passed, and else go on with the
    old ones: what was written is removed again. The audit brings one row per table to the driver.
    """
    generations = Generations(spark, tables_dir)
    generation = generations.begin()
    try:
        # Opens all tables, so that missing columns show before any of them is parsed.
        for name, df in list(read_extracts(spark, data_dir, multi_line).items()):
            _written(name, df, generations.location(generation, name))
        audits = {
            audit.table_name: audit
            for audit in key_audit(_generation(generations, generation)).collect()
        }
        for name in MODEL:
            _check_audit(audits[name])
        counts = {name: audits[name].row_count for name in MODEL}
        generations.publish(generation, counts)
    except BaseException:
        generations.abandon(generation)
        raise
    return counts


def _written(name: str, df: DataFrame, path: str) -> None:
    try:
        df.write.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if "header" not in str(error).lower():
            raise
        raise ValueError(f"{MODEL[name].file_name}: the headers of its parts differ") from error


def _generation(generations: Generations, generation: str) -> Tables:
    """The tables of a generation as they were written, with the flag of malformed rows."""

    def opened(name: str) -> DataFrame:
        return generations.spark.read.parquet(generations.location(generation, name))

    return Tables({name: lambda name=name: opened(name) for name in MODEL})


def stored_tables(spark: SparkSession, tables_dir: str, version: int | None = None) -> Tables:
    """The tables of the last load, or of the one that published a version."""
    generations = Generations(spark, tables_dir)
    written = _generation(generations, generations.read(version).generation)
    return Tables(
        {name: lambda name=name: getattr(written, name).drop(MALFORMED) for name in MODEL}
    )
