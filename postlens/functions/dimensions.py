"""Derived dimensions: region, market, network name and paid/organic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.fixed_values import (
    COLLABORATION,
    MARKET_COUNTRIES,
    NETWORK_NAMES,
    PAID_RAW,
    REGION_COUNTRIES,
)
from postlens.functions.text import initcap_words


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _group_of(value: Column, groups: Mapping[str, list[str]]) -> Column:
    """Name of the group that lists the value, NULL when none does."""
    return F.coalesce(*[F.when(value.isin(members), F.lit(name)) for name, members in groups.items()])


def region_of(country: Column | str) -> Column:
    return _group_of(F.upper(_col(country)), REGION_COUNTRIES)


def market_of(country: Column | str, username: Column | str, overrides: Mapping[str, str] | None = None) -> Column:
    """Market of a post; an account override wins over the country."""
    by_country = _group_of(F.upper(_col(country)), MARKET_COUNTRIES)
    by_account = [F.when(_col(username) == user, F.lit(market)) for user, market in (overrides or {}).items()]
    return F.coalesce(*by_account, by_country)


def network_name(network: Column | str) -> Column:
    """Display name of a network code; unknown codes are capitalised."""
    code = _col(network)
    known = [F.when(code == k, F.lit(name)) for k, name in NETWORK_NAMES.items()]
    return F.coalesce(*known, initcap_words(code))


def pauta_of(pauta: Column | str) -> Column:
    """'paid' for the paid label; every other value, NULL included, is 'organic'."""
    return F.when(_col(pauta) == PAID_RAW, "paid").otherwise("organic")


def is_collaboration(kind: Column | str) -> Column:
    """TRUE or FALSE, never NULL, so that rows without a kind survive the negation."""
    return _col(kind).eqNullSafe(COLLABORATION)
