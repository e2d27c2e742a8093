"""Sales-rep roster (S11): schema, the seed roster, and the fallback used when the
roster table cannot be read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

REP_SCHEMA = ("rep_id string, first_name string, last_name string, email string, team string, "
              "territory array<string>, industries array<string>, is_active boolean, current_load int, "
              "max_load int")

# The seeded roster of the reference data model.
SEED_REPS = [
    ("REP001", "Alex", "Chen", "alex.chen@company.com", "enterprise_sales", ["US", "CA"],
     ["Technology", "Financial Services"], True, 12, 50),
    ("REP002", "Maria", "Santos", "maria.santos@company.com", "enterprise_sales", ["US", "GB"],
     ["Healthcare", "Manufacturing"], True, 8, 50),
    ("REP003", "James", "Wright", "james.wright@company.com", "mid_market_sales", ["US"],
     ["Technology", "Retail"], True, 15, 60),
    ("REP004", "Priya", "Sharma", "priya.sharma@company.com", "mid_market_sales", ["US", "IN"],
     ["Financial Services", "Technology"], True, 10, 60),
    ("REP005", "Marcus", "Johnson", "marcus.j@company.com", "smb_sales", ["US"], ["All"], True, 5, 80),
]

# The three reps assumed when the roster is unavailable (capacity default 50).
FALLBACK_REPS = [
    ("REP001", "Alex", "Chen", "alex.chen@company.com", "enterprise_sales", None, None, True, 12, 50),
    ("REP002", "Maria", "Santos", "maria.santos@company.com", "mid_market_sales", None, None, True, 8, 50),
    ("REP003", "James", "Wright", "james.wright@company.com", "smb_sales", None, None, True, 5, 50),
]


def seed_reps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_REPS, REP_SCHEMA)


def load_reps(spark: SparkSession, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The roster table, or the three-rep fallback when it is missing or unreadable."""
    if path:
        try:
            df = spark.read.format(fmt).load(path)
            df.schema  # resolve now so a missing table falls back here, not at run time
            return df
        except AnalysisException:
            pass
    return spark.createDataFrame(FALLBACK_REPS, REP_SCHEMA)
