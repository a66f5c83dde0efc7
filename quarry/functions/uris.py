"""Model URI as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI format (fixed values): scheme, then the model, then "@alias" or "/version".
SCHEME, ALIAS_MARK, VERSION_MARK = "models:/", "@", "/"


def model_uri(model: Column, alias: Column | None = None, version: Column | None = None) -> Column:
    """URI of each row's model by alias, or by version where the alias is NULL; NULL where both are."""
    none = F.lit(None).cast("string")
    by_alias = none if alias is None else F.concat(F.lit(ALIAS_MARK), alias)
    by_version = none if version is None else F.concat(F.lit(VERSION_MARK), version.cast("string"))
    return F.concat(F.lit(SCHEME), model, F.coalesce(by_alias, by_version))
