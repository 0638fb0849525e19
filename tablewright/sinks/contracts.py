"""Typed table contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A column of a contract; ``max_length`` bounds text."""

    name: str
    type: T.DataType
    max_length: int | None = None

    def ddl(self) -> str:
        kind = f"varchar({self.max_length})" if self.max_length else self.type.simpleString()
        return f"{self.name} {kind}"

    def fits(self) -> Column:
        """True if the value, null included, fits the column."""
        c = F.col(self.name)
        if self.max_length:
            return F.coalesce(F.length(c) <= self.max_length, F.lit(True))
        return c.isNull() | c.try_cast(self.type).isNotNull()

    def checked(self) -> Column:
        """The value in the column's type; one that does not fit fails the job."""
        message = F.concat(
            F.lit(f"{self.ddl()}: value does not fit: "), F.col(self.name).cast("string")
        )
        value = F.col(self.name).try_cast(self.type)
        return F.when(self.fits(), value).otherwise(F.raise_error(message)).alias(self.name)


@dataclass(frozen=True)
class Contract:
    """Columns, in order, and the key of a published table."""

    name: str
    key: str
    fields: tuple[Field, ...]

    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def jdbc_column_types(self) -> str:
        return ", ".join(f.ddl() for f in self.fields)


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns in its order and types."""
    return df.select(*[f.checked() for f in contract.fields])


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``(column, violations)``: values that do not fit, in one pass."""
    counts = df.agg(*[F.count_if(~f.fits()).alias(f.name) for f in contract.fields])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("violations"))
        for f in contract.fields
    ])))
