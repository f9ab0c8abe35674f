"""Model tables as a relational CDM database wants them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp
from ..functions.values import trimmed
from ..specs.cdm import cdm_specs

# Texts cut to the width of their target column.
TRIMMED = {"value_as_string": 60, "drug_source_value": 512, "payer_source_value": 512}
_DIGIT_DATES = ("valid_start_date", "valid_end_date")


def conform_to_ddl(df: DataFrame, table: str, version: str = "5.4", dialect: str = "mssql") -> DataFrame:
    """The columns of the standard layout, in its order, under the load rules:

    keys 64 bits wide, three texts cut to their width, yyyymmdd numbers as dates, open
    drug exposures ending on their start, coordinates as floating point; for ``psql`` also
    datetimes as timestamps and quantities as floating point. Drug exposures without a
    start date are left out.
    """
    if table == "drug_exposure":
        df = df.filter("drug_exposure_start_date is not null")

    def column(name: str, kind: str):
        value = F.col(name) if name in df.columns else F.lit(None)
        if name in _DIGIT_DATES:
            value = F.try_to_timestamp(value.cast("string"), F.lit("yyyyMMdd")).cast("date")
        elif name in TRIMMED:
            value = trimmed(value, TRIMMED[name])
        elif name == "drug_exposure_end_date":
            value = F.coalesce(value, F.col("drug_exposure_start_date"))
        elif dialect == "psql" and "datetime" in name:
            value = as_timestamp(value)
        elif dialect == "psql" and name == "quantity":
            kind = "double"
        return value.try_cast(kind).alias(name)

    return df.select([column(n, k) for n, k in cdm_specs(version)[table].columns.items()])
