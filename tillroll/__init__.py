"""tillroll: a retail analytics warehouse on Spark.

Raw shop tables -> staging -> marts -> daily metrics, cohorts, filtered
series, data-quality and schema-contract checks, every step a function from
DataFrames to DataFrames.
"""

from tillroll.plans.warehouse import build, register, run_all
from tillroll.session import get_spark, stage
from tillroll.sources.raw import read_raw, row_counts

__version__ = "0.1.0"
__all__ = ["build", "get_spark", "read_raw", "register", "row_counts", "run_all", "stage"]
