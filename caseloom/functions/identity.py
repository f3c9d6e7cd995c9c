"""Pseudonyms and the projection that keeps identities out of later layers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.errors import IntegrityError
from caseloom.functions.text import normalize_person_name


def pseudonymize(name: Column, folio: Column, salt: str) -> Column:
    """Hex SHA-256 of normalised name, folio and salt; a missing part is empty."""
    missing = F.lit("")
    return F.sha2(
        F.concat(
            normalize_person_name(F.coalesce(name, missing)),
            F.coalesce(folio, missing),
            F.lit(salt),
        ),
        256,
    )


def coerce_text(value: Column, kind: Column) -> Column:
    """A cell as text. Whole numbers lose a trailing ``.0`` so that a folio
    hashes the same whether or not its column has blanks."""
    whole = F.regexp_replace(value, r"^([+-]?\d+)\.0+$", "$1")
    return F.when(kind == "number", whole).otherwise(value)


def project_without_pii(
    df: DataFrame, allowed: Sequence[str], banned: Iterable[str]
) -> DataFrame:
    """Keep the whitelisted columns only, and fail if one of them is banned."""
    leaked = {b.upper() for b in banned} & {c.upper() for c in allowed}
    if leaked:
        raise IntegrityError(f"identifying columns requested: {sorted(leaked)}")
    return df.select(*allowed)


def assert_no_columns(df: DataFrame, banned: Iterable[str]) -> DataFrame:
    leaked = {b.upper() for b in banned} & {c.upper() for c in df.columns}
    if leaked:
        raise IntegrityError(f"identifying columns present: {sorted(leaked)}")
    return df
