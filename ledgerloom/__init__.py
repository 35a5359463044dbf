"""ledgerloom: bank-ledger data work (loads, marts, repairs) written for Spark.

Every operator takes DataFrames and returns a DataFrame, so Catalyst sees one
declarative plan; only ``plans.jobs`` and ``streaming`` trigger actions.
"""

__version__ = "0.1.0"
