"""CSV in and out without losing the defects the checks look for.

Reading keeps whitespace, maps the usual spellings of "not available" to NULL,
and infers only numbers and booleans: dates stay text, because several formats
may be mixed in one column.  Writing keeps whitespace too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import strip
from plumbline.functions.values import NUMBER_PATTERN, quoted

# Cell texts that mean "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Cell texts read as booleans.
BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")

INTEGER_PATTERN = "^[+-]?[0-9]+$"


def read_text_cells(
    spark: SparkSession,
    path: str,
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = False,
    surplus: str = "fail",
) -> DataFrame:
    """Every column as text, missing cells as NULL.

    `multiline` allows line breaks inside quotes, but then a file cannot be split.
    A row with more cells than the header, empty ones included, fails the read, or
    loses them when `surplus` is "drop"; cells that a row lacks are missing.
    """
    if surplus not in ("fail", "drop"):
        raise ValueError("surplus must be 'fail' or 'drop'")
    options = {
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    names = spark.read.csv(path, inferSchema=False, **options).columns
    if surplus == "fail":  # the parser itself refuses a row with more cells, whichever columns are read
        options["maxColumns"] = len(names)
    refs = [f"c{i}" for i in range(len(names))]
    raw = spark.read.schema(", ".join(f"{r} string" for r in refs)).csv(path, enforceSchema=True, **options)
    tokens = list(na_tokens)
    return raw.select(
        *(F.when(~F.col(ref).isin(tokens), F.col(ref)).alias(name) for ref, name in zip(refs, names, strict=True))
    )


def check_line_breaks(spark: SparkSession, path: str) -> None:
    """Fails if a line opens a quoted cell that it does not close: the file needs `multiline`.

    Only a quote at the start of a cell opens one; others are characters of the cell.
    """
    # Doubled quotes stand for one inside a cell; without them a quoted cell ends at its next quote.
    single = """replace(value, '""', '')"""
    unclosed = f"""regexp_replace({single}, '(^|,)"[^"]*+"', '$1') RLIKE '(^|,)"'"""
    open_ = spark.read.text(path).where(unclosed).limit(1)
    if not open_.isEmpty():
        raise ValueError("a quoted cell does not close on its line; read the file with multiline=True")


def infer_types(cells: DataFrame) -> T.StructType:
    """Whole numbers, numbers, booleans, else text, from one aggregate per column.

    Each cell is one kind, a bit; a column's type follows from the kinds it has.
    A column of whole numbers too large for 64 bits stays text, digits intact,
    as does one without rows; one with nothing but missing cells is a number.
    """
    missing, boolean, whole, large, number, text = (1 << i for i in range(6))
    flat = cells.toDF(*(f"c{i}" for i in range(len(cells.columns))))
    stripped = flat.selectExpr(*(f"{strip(ref)} AS {ref}" for ref in flat.columns))
    booleans = ", ".join(f"'{b}'" for b in BOOLEANS)
    kinds = stripped.selectExpr(
        *(
            f"""bit_or(CASE WHEN {ref} IS NULL THEN {missing}
                            WHEN {ref} IN ({booleans}) THEN {boolean}
                            WHEN {ref} RLIKE '{INTEGER_PATTERN}'
                            THEN if(TRY_CAST({ref} AS BIGINT) IS NULL, {large}, {whole})
                            WHEN {ref} RLIKE '{NUMBER_PATTERN}' THEN {number}
                            ELSE {text} END) AS {ref}"""
            for ref in flat.columns
        )
    ).first()

    def inferred(seen: int | None) -> T.DataType:
        if seen is None or seen & (large | text):
            return T.StringType()
        if seen == boolean:
            return T.BooleanType()
        if seen & boolean:
            return T.StringType()
        return T.LongType() if seen & ~missing == whole else T.DoubleType()

    return T.StructType([T.StructField(name, inferred(seen)) for name, seen in zip(cells.columns, kinds)])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = False,
    bad_cells: str = "fail",
    surplus: str = "fail",
) -> DataFrame:
    """Read a CSV file or folder with a header.

    Without `schema` the types are inferred in one extra pass.  With `schema`,
    a cell that does not fit its type fails the read, or becomes NULL when
    `bad_cells` is "null".  Without `multiline` the lines are checked first for
    quoted cells that do not close; a row with surplus cells fails the read,
    unless `surplus` is "drop".
    """
    if bad_cells not in ("fail", "null"):
        raise ValueError("bad_cells must be 'fail' or 'null'")
    if not multiline:
        check_line_breaks(spark, path)
    cells = read_text_cells(spark, path, na_tokens, multiline, surplus)
    if schema is None:
        schema = infer_types(cells)
    if [f.name for f in schema.fields] != cells.columns:
        raise ValueError(f"the file has columns {cells.columns}, the schema {[f.name for f in schema.fields]}")
    columns = []
    for field in schema.fields:
        c = F.col(quoted(field.name))
        if not isinstance(field.dataType, T.StringType):
            trimmed = F.expr(strip(quoted(field.name)))
            c = trimmed.try_cast(field.dataType) if bad_cells == "null" else trimmed.cast(field.dataType)
        columns.append(c.alias(field.name))
    return cells.select(*columns)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a CSV folder with a header; `single_file` is for result tables of bounded size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def write_json(df: DataFrame, path: str) -> str:
    """Write a one-row summary as a JSON folder."""
    df.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)
    return path
