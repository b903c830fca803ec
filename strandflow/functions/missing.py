"""Missing-value rules of R, awk and pandas, written as columns (ANSI mode safe)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def to_number(c: Column) -> Column:
    """Text to double, NULL where the text is no number."""
    return c.try_cast("double")


def number_or_zero(c: Column) -> Column:
    """awk's reading: anything that is no number counts as 0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def float_division(num: Column, den: Column) -> Column:
    """IEEE division: x/0 is an infinity, 0/0 is NaN."""
    num, den = num.cast("double"), den.cast("double")
    return F.when(den != 0, num / F.when(den != 0, den)).when(
        num == 0, F.lit(float("nan"))
    ).when(num.isNull() | den.isNull() | F.isnan(num), num + den).otherwise(
        F.signum(num) * F.lit(float("inf"))
    )


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column; infinities stay."""
    kept = df.dropna("any")
    for field in df.schema.fields:
        if field.dataType.simpleString() in ("double", "float"):
            kept = kept.where(~F.isnan(field.name))
    return kept


def fill_zero(df: DataFrame) -> DataFrame:
    """Every missing value becomes 0, the text '0' in text columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.fillna(0, numeric).fillna("0", text)
