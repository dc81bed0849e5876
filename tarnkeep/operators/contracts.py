"""One schema contract per table: the columns, their types and how text becomes those types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkeep.functions.names import named, quoted


@dataclass(frozen=True)
class Contract:
    """Column names with Spark type names, in order, and the text formats of dates and times."""

    columns: Mapping[str, str]
    date_format: str = "yyyy-MM-dd"
    timestamp_format: str | None = None

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{quoted(name)} {kind}" for name, kind in self.columns.items())


# The shapes of text worth casting: a cast of other text raises and recovers inside, which costs
# far more than the pattern test.
_ISO_DATE = "yyyy-MM-dd"
_ISO_DATE_SHAPE = r"^(?!0000)\d{4}-\d{2}-\d{2}$"
_WHOLE_SHAPE = r"^\s*[+-]?\d+\s*$"
_FRACTION_SHAPE = r"^\s*[+-]?(\d+\.\d*|\.\d+)\s*$"
_NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DOUBLE_SHAPE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?|(?i:nan|inf|infinity))\s*$"


def _parse_text(text: Column, target: T.DataType, contract: Contract) -> Column:
    def shaped(pattern: str, cast: Column) -> Column:
        return F.when(text.rlike(pattern), cast)

    if isinstance(target, T.DateType):
        if contract.date_format == _ISO_DATE:
            return shaped(_ISO_DATE_SHAPE, text.try_cast("date"))
        return F.try_to_date(text, contract.date_format)
    if isinstance(target, T.TimestampType):
        if contract.timestamp_format is None:
            return F.try_to_timestamp(text)
        return F.try_to_timestamp(text, F.lit(contract.timestamp_format))
    if isinstance(target, T.IntegralType):
        # a number with a fraction or an exponent keeps its whole part; the fraction is cut off as
        # text, so that no digit is lost, and only exponents go through a double
        whole = F.regexp_extract(text, r"^\s*([+-]?\d*)", 1)
        cut = F.when(whole.rlike(r"\d"), whole.try_cast(target)).otherwise(F.lit(0).cast(target))
        real = text.try_cast("double")
        return F.coalesce(
            shaped(_WHOLE_SHAPE, text.try_cast(target)),
            shaped(_FRACTION_SHAPE, cut),
            shaped(_NUMBER_SHAPE, F.when(
                text.rlike("[eE]") & (F.abs(real) < F.lit(2.0**63)), real.try_cast(target)
            )),
        )
    if isinstance(target, T.DecimalType):
        return shaped(_NUMBER_SHAPE, text.try_cast(target))
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return shaped(_DOUBLE_SHAPE, text.try_cast(target))
    return text.try_cast(target)


def apply_contract(df: DataFrame, contract: Contract, keep_others: bool = False) -> DataFrame:
    """Project the contract's columns and cast them; a value that cannot be cast becomes null."""
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [name for name in contract.names if name not in present]
    if missing:
        raise ValueError(f"columns of the contract are missing: {missing}")

    projected = []
    for field in contract.schema.fields:
        source = named(field.name)
        have = present[field.name]
        if have == field.dataType:
            cast = source
        elif isinstance(have, T.StringType):
            cast = _parse_text(source, field.dataType, contract)
        else:
            cast = source.try_cast(field.dataType)
        projected.append(cast.alias(field.name))
    if keep_others:
        projected += [named(n) for n in present if n not in contract.columns]
    return df.select(*projected)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``columns`` (every column if none are named)."""
    return df.dropna(how="any", subset=list(columns) if columns is not None else None)


def timestamp_literal(as_of: datetime | str | None) -> Column:
    """The given moment, or the query's own clock."""
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def date_literal(as_of: date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def with_audit(df: DataFrame, column: str, as_of: datetime | str | None = None) -> DataFrame:
    """Add a load time column."""
    return df.withColumn(column, timestamp_literal(as_of))
