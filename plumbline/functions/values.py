"""Missing values, numbers and keys, as SQL over a column reference."""

from __future__ import annotations

from pyspark.sql import types as T

from plumbline.functions.text import compact, strip

TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Spellings a text cell must have to count as a number.  Spark alone would
# also take '1.0d' and hexadecimal floats.
NUMBER_PATTERN = r"(?i)^[+-]?(inf|infinity|nan|([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?)$"


def quoted(name: str) -> str:
    """A column name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, TEXT_TYPES)


def is_missing(ref: str, dtype: T.DataType) -> str:
    """NULL and NaN are one notion of missing."""
    if isinstance(dtype, FLOAT_TYPES):
        return f"({ref} IS NULL OR isnan({ref}))"
    return f"{ref} IS NULL"


def nan_to_null(ref: str, dtype: T.DataType) -> str:
    return f"nanvl({ref}, NULL)" if isinstance(dtype, FLOAT_TYPES) else ref


def as_number(ref: str, dtype: T.DataType) -> str | None:
    """The value to compare with a range, or None for a type that has no number."""
    if isinstance(dtype, T.NumericType):
        return ref
    if isinstance(dtype, T.BooleanType):
        return f"CAST({ref} AS INT)"
    if is_text(dtype):
        text = strip(ref)
        return f"if({text} RLIKE '{NUMBER_PATTERN}', TRY_CAST({text} AS DOUBLE), NULL)"
    return None


def key_value(ref: str, dtype: T.DataType) -> str:
    """The form in which keys are compared: NaN equals NULL, long text by digest."""
    return compact(ref) if is_text(dtype) else nan_to_null(ref, dtype)


def key_text(ref: str, dtype: T.DataType) -> str:
    """A key form as text of bounded width, equal exactly when the key is."""
    if isinstance(dtype, T.BinaryType):
        text = f"hex({ref})"
    elif isinstance(dtype, (T.ArrayType, T.StructType)):
        text = f"to_json({ref}, map('ignoreNullFields', 'false'))"
    elif isinstance(dtype, FLOAT_TYPES):
        text = f"CAST({ref} + 0.0D AS STRING)"  # -0.0 is 0.0
    else:
        text = f"CAST({ref} AS STRING)"
    return compact(text)


def orderable(dtype: T.DataType) -> bool:
    """Whether values of the type can be compared and sorted, as keys must be."""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def hashable(dtype: T.DataType) -> bool:
    """Whether xxhash64 accepts the type (maps and variants are refused)."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(hashable(f.dataType) for f in dtype.fields)
    return True
