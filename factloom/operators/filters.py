"""Row filters. All compare text with text, so they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import codes
from factloom.functions.text import literal
from factloom.spec import quoted


def client_filter(df: DataFrame, client: str = codes.LEDGER_CLIENT, column: str = "MANDT") -> DataFrame:
    """Rows of one client. The client is text: ``'0110'`` is not ``'110'``."""
    return df.filter(f"{quoted(column)} = {literal(client)}")


def account_range_filter(
    df: DataFrame,
    client: str = codes.LEDGER_CLIENT,
    low: str = codes.ACCOUNT_RANGE[0],
    high: str = codes.ACCOUNT_RANGE[1],
    client_column: str = "RCLNT",
    account_column: str = "RACCT",
    pad_to: int | None = None,
) -> DataFrame:
    """Rows of one client whose account lies in an inclusive text range.

    ``pad_to`` left-pads accounts with zeros first, for feeds that drop leading zeros.
    """
    account = quoted(account_column)
    if pad_to is not None:
        account = f"lpad({account}, {pad_to}, '0')"
    return client_filter(df, client, client_column).filter(f"{account} BETWEEN {literal(low)} AND {literal(high)}")


def doc_type_filter(
    df: DataFrame,
    types: Sequence[str] = codes.DOCUMENT_TYPES,
    transactions: Sequence[str] = codes.TRANSACTION_CODES,
    type_column: str = "BLART",
    transaction_column: str = "TCODE",
) -> DataFrame:
    """Document headers of the given types that were posted by the given transactions."""
    def one_of(column: str, values: Sequence[str]) -> str:
        return f"{quoted(column)} IN ({', '.join(literal(v) for v in values)})"

    return df.filter(f"{one_of(type_column, types)} AND {one_of(transaction_column, transactions)}")


def unit_filter(
    df: DataFrame,
    client: str = codes.LEDGER_CLIENT,
    unit: str = codes.VOLUME_UNIT,
    client_column: str = "MANDT",
    unit_column: str = "MSEHI",
) -> DataFrame:
    """Rows of one client in one unit of measure."""
    return client_filter(df, client, client_column).filter(f"{quoted(unit_column)} = {literal(unit)}")


def source_system_filter(df: DataFrame, source: str, column: str = "Client") -> DataFrame:
    """Rows of the source's client; an unknown source passes everything through."""
    client = codes.SOURCE_CLIENTS.get(source)
    return df if client is None else client_filter(df, client, column)


def watermark_text(df: DataFrame, column: str, watermark) -> str:
    """A watermark (text, date, timestamp, or one-row DataFrame) as SQL text of the column's type.

    A one-row DataFrame is read as text, so the session time zone applies throughout.
    """
    if isinstance(watermark, DataFrame):
        watermark = watermark.select(F.col(quoted(watermark.columns[0])).cast("string")).first()[0]
    return f"CAST({literal(str(watermark))} AS {df.schema[column].dataType.simpleString()})"


def since_watermark(df: DataFrame, watermark, column: str = "ingested_at") -> DataFrame:
    """Rows loaded at or after the watermark; no watermark (None) means a full load.

    The watermark is a text, a date, a timestamp, or a one-row one-column DataFrame,
    which becomes a scalar subquery: no driver round trip, and still pushed to the scan.
    """
    if watermark is None:
        return df
    if isinstance(watermark, DataFrame):
        return df.filter(F.col(quoted(column)) >= watermark.scalar())
    return df.filter(f"{quoted(column)} >= {watermark_text(df, column, watermark)}")


def before_watermark(df: DataFrame, watermark, column: str = "ingested_at") -> DataFrame:
    """Rows loaded strictly before the watermark."""
    return df.filter(f"{quoted(column)} < {watermark_text(df, column, watermark)}")


def split_changes(df: DataFrame, action: str = "OPFLAG") -> tuple[DataFrame, DataFrame]:
    """Upserts and deletes of a change feed. A NULL action counts as an upsert."""
    code, deleted = quoted(action), literal(codes.DELETED)
    return df.filter(f"NOT ({code} <=> {deleted})"), df.filter(f"{code} = {deleted}")


def trailing_months_filter(df: DataFrame, as_of, months: int = 24, column: str = "BUDAT") -> DataFrame:
    """Rows dated within ``months`` before ``as_of``, the first day included."""
    return df.filter(f"{quoted(column)} >= add_months(CAST({literal(str(as_of))} AS date), -{months})")


def latest_batch(df: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Rows that carry the highest value of ``column``.

    The maximum is one row by construction, so it travels as a scalar subquery.
    """
    newest = df.agg(F.max(quoted(column)))
    return df.filter(F.col(quoted(column)) == newest.scalar())
