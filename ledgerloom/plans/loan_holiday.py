"""Loan-holiday mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import LOAN_HOLIDAY_INFO

_VERSION = "effective_from_date"


def loan_holiday_info(
    deals: DataFrame, holidays: DataFrame, products: DataFrame
) -> DataFrame:
    """Deals with the holiday and product of the same version date.

    The version dates in the result are those of the holiday, so they are NULL
    for a deal without one. Several holidays or product names for one key all
    stay, as separate rows.
    """
    deal = deals.select(
        "deal_rk",
        F.col("deal_num").alias("deal_number"),
        "deal_name",
        "deal_sum",
        "client_rk",
        "agreement_rk",
        "deal_start_date",
        "department_rk",
        "product_rk",
        "deal_type_cd",
        F.col(_VERSION).alias("_version"),
    )
    holiday = holidays.withColumn("_version", F.col(_VERSION))
    product = products.select(
        "product_rk", "product_name", F.col(_VERSION).alias("_version")
    )
    return (
        deal.join(holiday, ["deal_rk", "_version"], "left")
        .join(product, ["product_rk", "_version"], "left")
        .select(*LOAN_HOLIDAY_INFO.columns)
    )
