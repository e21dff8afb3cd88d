"""Monthly popularity as SQL text, with the month of an epoch as a SQL function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MONTH_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION month_of_epoch(seconds BIGINT) RETURNS INT
RETURN CAST(year(date_add(DATE'1970-01-01', CAST(floor(seconds / 86400) AS INT))) * 100
            + month(date_add(DATE'1970-01-01', CAST(floor(seconds / 86400) AS INT))) AS INT)
"""

MONTHLY = """
WITH dated AS (SELECT month_of_epoch(timestamp) AS month, mid FROM {rated} WHERE mid IS NOT NULL)
SELECT month, mid, count(*) AS count FROM dated GROUP BY ALL
"""


def monthly_counts(spark: SparkSession, ratings: DataFrame) -> DataFrame:
    """A2 by SQL: (month, mid, count). Spark inlines the function, so the month stays in codegen."""
    spark.sql(MONTH_FUNCTION)
    return spark.sql(MONTHLY, rated=ratings)
