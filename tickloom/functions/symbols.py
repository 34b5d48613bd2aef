"""Symbol text helpers: ``EXCHANGE:BASEQUOTE``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Text without surrounding white space of any kind; ``trim`` takes off blanks only."""
    return F.btrim(text, F.lit(" \t\r\n\f\x0b"))


def normalise(symbol: Column) -> Column:
    return F.upper(strip(symbol))


def exchange_name(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit(":"), F.lit(1))


def symbol_code(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit(":"), F.lit(2))


def base_currency(symbol: Column, quote: str = "USDT") -> Column:
    return F.regexp_replace(symbol_code(symbol), quote + "$", "")


def asset_name(symbol: Column, names: Mapping[str, str]) -> Column:
    """Name from a mapping, or the symbol itself."""
    if not names:
        return symbol
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, symbol), symbol)


def split_symbol(trades: DataFrame, quote: str = "USDT") -> DataFrame:
    """Add exchange_name, symbol_code, base_currency and quote_currency."""
    s = F.col("symbol")
    return trades.withColumns(
        {
            "exchange_name": exchange_name(s),
            "symbol_code": symbol_code(s),
            "base_currency": base_currency(s, quote),
            "quote_currency": F.when(symbol_code(s).endswith(quote), quote),
        }
    )
