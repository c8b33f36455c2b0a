"""Report output: tab-separated files, and the cell view that marks what needs attention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(field: T.StructField) -> Column:
    """Text form of a report column: no exponents, and one line per row."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        value = value.cast("decimal(38,2)")
    elif isinstance(field.dataType, T.StringType):
        value = F.regexp_replace(value, r"[\t\r\n]+", " ")
    return value.alias(field.name)


def export_tsv(
    report: DataFrame, directory: str, name: str, single_file: bool = False, order: Sequence[Column] = ()
) -> str:
    """Write a report with a header line under `directory/name` and return that path.

    The result is a directory of part files. `single_file` writes one part; use it for reports of
    bounded size only, such as environment summaries and top-k lists. `order`: the order of the lines, by
    columns of the report; the part files in the order of their names then hold the whole report in it.
    """
    path = f"{directory.rstrip('/')}/{name}"
    rows = report
    if single_file:
        # Blocks of a shuffle come in any order, so the rows are sorted behind it.
        rows = rows.repartition(1).sortWithinPartitions(*order) if order else rows.repartition(1)
    elif order:
        rows = rows.orderBy(*order)
    rows = rows.select(*[_plain(f) for f in report.schema.fields])
    (
        rows.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("escape", "")
        .option("nullValue", "NULL")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path


def report_cells(report: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """One row per report cell with its text and whether it is to be highlighted.

    Highlighted are changes (`*_fmt` starting with a sign) and statuses other than ok.
    """
    texts = report.select(
        *id_columns,
        *[
            F.col(c).cast("string").alias(c) for c in report.columns if c not in set(id_columns)
        ],
    )
    cells = texts.unpivot(list(id_columns), None, "column_name", "cell")
    column, cell = F.col("column_name"), F.col("cell")
    change = column.endswith("_fmt") & F.regexp_like(cell, F.lit("^[+-]"))
    status = column.contains("status") & (cell != "") & (cell != "ok")
    return cells.withColumn("highlight", F.coalesce(change | status, F.lit(False)))
