"""Registered queries over duplicate, reconciliation and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.catalog import inputs as I
from ledgerloom.catalog.loads import RATES, STAGE_SQL
from ledgerloom.functions.casts import (
    DOTTED_DATE,
    MISSING_TOKENS,
    cut_text,
    null_tokens,
    parse_date,
)
from ledgerloom.operators import checks, digest_tree, reconcile, versions
from ledgerloom.operators.first_values import first_values
from ledgerloom.plans.audit import latest_states

_NEWEST = ["effective_to_date", "client_open_dttm"]


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.keep_freshest(
        I.client_versions(spark, sf_dir), S.CLIENT.key, _NEWEST
    )


def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.repeated_keys(I.client_versions(spark, sf_dir), S.CLIENT.key)


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.distinct_keys(I.client_versions(spark, sf_dir), S.CLIENT.key)


def dup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.rows_with_repeated_key(
        I.product_file(spark, sf_dir), S.PRODUCT.key
    )


def version_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_profile(I.deals(spark, sf_dir))


def recon_only_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.only_left(
        I.product_table(spark, sf_dir), I.product_file(spark, sf_dir)
    )


def recon_only_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.only_right(
        I.product_table(spark, sf_dir), I.product_file(spark, sf_dir)
    )


def recon_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.common_rows(
        I.product_table(spark, sf_dir), I.product_file(spark, sf_dir)
    )


def recon_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.difference_summary(
        I.product_table(spark, sf_dir), I.product_file(spark, sf_dir)
    )


def recon_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What only one side has, found by digests of buckets of product numbers."""
    return digest_tree.differing_rows(
        I.product_table(spark, sf_dir), I.product_file(spark, sf_dir), ["product_rk"]
    )


def recon_digest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for client versions against those of the newest load, without a key."""
    rows = I.client_versions(spark, sf_dir)
    return digest_tree.differing_rows(rows, versions.keep_freshest(rows, S.CLIENT.key, _NEWEST))


def recon_fixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.corrected_rows(
        I.product_table(spark, sf_dir), I.product_file(spark, sf_dir), ["product_rk"]
    )


def gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular days with repeats: every order day of every customer."""
    return checks.date_gaps(I.account_days(spark, sf_dir))


def gap_check_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regular daily rows with a few missing days."""
    return checks.date_gaps(I.daily_sums(spark, sf_dir))


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_violations(
        I.account_days(spark, sf_dir), ["account_rk", "effective_date"]
    )


def version_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate periods of seven days from every order day of a customer."""
    return checks.overlapping_versions(RATES.stage(spark, sf_dir), ["currency_rk"])


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    holidays = I.holidays(spark, sf_dir)
    return checks.null_profile(holidays, holidays.columns)


def scalar_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text forms of orders turned into typed columns, good and bad ones."""
    text = I.table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        """concat(CAST(day(o_orderdate) AS STRING), '.',
             CAST(month(o_orderdate) AS STRING), '.',
             CAST(year(o_orderdate) AS STRING)) AS dotted""",
        """CASE WHEN o_orderstatus = 'P' THEN 'no date'
             ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS iso""",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS amount",
        "o_orderpriority AS label",
        """CASE o_orderstatus WHEN 'F' THEN 'NULL' WHEN 'O' THEN 'n/a'
             ELSE 'kept' END AS token""",
    )
    day = parse_date(F.col("dotted"), DOTTED_DATE)
    return null_tokens(text, MISSING_TOKENS).select(
        F.col("id").cast("bigint").alias("id"),
        day.alias("day"),
        parse_date(F.col("iso"), "yyyy-MM-dd", lenient=True).alias("iso_day"),
        F.col("amount").cast(S.AMOUNT).alias("amount"),
        cut_text(F.col("label"), 3).alias("short_label"),
        cut_text(F.col("label"), 1).cast("int").alias("rank"),
        F.col("token").try_cast("int").alias("not_a_number"),
        F.add_months(day, -1).alias("month_before"),
        F.date_add(day, 1).alias("next_day"),
        F.col("token"),
    )


def audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as audit events: a user is a run, an event type is a state."""
    log = I.table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS run_id",
        "'event_stream' AS process",
        "concat('table_', CAST(user_id AS STRING)) AS table_name",
        "ts AS event_time",
        """CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'error' THEN 'FAILED'
             ELSE 'SUCCESS' END AS status""",
        "props AS message",
        "event_id AS input_rows",
        "CAST(0 AS BIGINT) AS inserted_rows",
        "CAST(0 AS BIGINT) AS updated_rows",
        "event_id AS skipped_rows",
    )
    return latest_states(log)


def dup_rows_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in key order, as a person would read them."""
    return versions.in_key_order(dup_rows(spark, sf_dir), S.PRODUCT.key)


def product_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.names_by_key(I.product_file(spark, sf_dir), ["product_rk"], "product_name")


def product_names_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each product how many names it has, and the first two."""
    names = first_values(I.product_file(spark, sf_dir), ["product_rk"], "product_name", 2)
    return names.select("product_rk", "total", F.array_join("shown", "; ").alias("names"))


QUERIES = {
    "dup_rows_listed": dup_rows_listed,
    "product_names": product_names,
    "product_names_first": product_names_first,
    "dedupe_latest": dedupe_latest,
    "dup_keys": dup_keys,
    "distinct_keys": distinct_keys,
    "dup_rows": dup_rows,
    "version_profile": version_profile,
    "recon_only_left": recon_only_left,
    "recon_only_right": recon_only_right,
    "recon_common": recon_common,
    "recon_summary": recon_summary,
    "recon_digest": recon_digest,
    "recon_digest_versions": recon_digest_versions,
    "recon_fixed_rows": recon_fixed_rows,
    "gap_check": gap_check,
    "gap_check_daily": gap_check_daily,
    "key_violations": key_violations,
    "version_overlaps": version_overlaps,
    "null_profile": null_profile,
    "scalar_casts": scalar_casts,
    "audit_latest": audit_latest,
}

# --- independent SQL -------------------------------------------------------

_BOTH = ("product_table", "product_file")


def _gap_sql(source: str) -> str:
    """Days in order as a list per account, and each day with its successor."""
    return I.with_inputs(
        f"""SELECT account_rk, days[i] AS effective_date, days[i + 1] AS next_date,
      CAST(days[i + 1] - days[i] AS INTEGER) AS date_diff
    FROM (SELECT account_rk, days, unnest(range(1, len(days))) AS i FROM (
      SELECT account_rk, list(effective_date ORDER BY effective_date)
        FILTER (effective_date IS NOT NULL) AS days FROM {source} GROUP BY account_rk))
    WHERE days[i + 1] <> days[i] + 1""",
        source,
    )


_DUP_ROWS_SQL = I.with_inputs(
    """SELECT * EXCLUDE (copies) FROM (SELECT *, count(*) OVER (
      PARTITION BY product_rk, effective_from_date) AS copies FROM product_file
      WHERE product_rk IS NOT NULL AND effective_from_date IS NOT NULL)
    WHERE copies > 1""",
    "product_file",
)

_HOLIDAY_COLUMNS = S.LOAN_HOLIDAY.columns

ORACLE = {
    "dedupe_latest": I.with_inputs(
        """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
      PARTITION BY client_rk, effective_from_date
      ORDER BY effective_to_date DESC NULLS FIRST, client_open_dttm DESC NULLS FIRST,
        event_id DESC NULLS FIRST, props DESC NULLS FIRST) AS place FROM client)
    WHERE place = 1""",
        "client",
    ),
    "dup_keys": I.with_inputs(
        """SELECT client_rk, effective_from_date, count(*) AS row_count FROM client
    GROUP BY client_rk, effective_from_date HAVING count(*) > 1""",
        "client",
    ),
    "distinct_keys": I.with_inputs(
        """SELECT client_rk, effective_from_date FROM client
    GROUP BY client_rk, effective_from_date""",
        "client",
    ),
    "dup_rows": _DUP_ROWS_SQL,
    "dup_rows_listed": _DUP_ROWS_SQL,
    "product_names": I.with_inputs(
        """SELECT product_rk, COALESCE(string_agg(product_name, '; ' ORDER BY product_name), '') AS names
    FROM (SELECT DISTINCT product_rk, product_name FROM product_file) GROUP BY product_rk""",
        "product_file",
    ),
    "product_names_first": I.with_inputs(
        """SELECT product_rk, count(product_name) AS total,
      COALESCE(string_agg(product_name, '; ' ORDER BY product_name) FILTER (WHERE place <= 2), '') AS names
    FROM (SELECT *, row_number() OVER (PARTITION BY product_rk ORDER BY product_name NULLS LAST) AS place
      FROM (SELECT DISTINCT product_rk, product_name FROM product_file)) GROUP BY product_rk""",
        "product_file",
    ),
    "version_profile": I.with_inputs(
        """SELECT effective_from_date, effective_to_date, count(*) AS row_count
    FROM deal GROUP BY effective_from_date, effective_to_date""",
        "deal",
    ),
    "recon_only_left": I.with_inputs(
        "SELECT * FROM product_table EXCEPT SELECT * FROM product_file", *_BOTH
    ),
    "recon_only_right": I.with_inputs(
        "SELECT * FROM product_file EXCEPT SELECT * FROM product_table", *_BOTH
    ),
    "recon_common": I.with_inputs(
        "SELECT * FROM product_table INTERSECT SELECT * FROM product_file", *_BOTH
    ),
    "recon_summary": I.with_inputs(
        """SELECT
      (SELECT count(*) FROM (FROM product_table EXCEPT FROM product_file)) AS only_left,
      (SELECT count(*) FROM (FROM product_file EXCEPT FROM product_table)) AS only_right,
      (SELECT count(*) FROM (FROM product_table INTERSECT FROM product_file)) AS common""",
        *_BOTH,
    ),
    "recon_digest": I.with_inputs(
        """SELECT *, 'left' AS found_in FROM (FROM product_table EXCEPT FROM product_file)
    UNION ALL SELECT *, 'right' FROM (FROM product_file EXCEPT FROM product_table)""",
        *_BOTH,
    ),
    "recon_digest_versions": I.with_inputs(
        """SELECT DISTINCT * EXCLUDE (place), 'left' AS found_in FROM (SELECT *, rank() OVER (
      PARTITION BY client_rk, effective_from_date
      ORDER BY effective_to_date DESC NULLS FIRST, client_open_dttm DESC NULLS FIRST,
        event_id DESC NULLS FIRST, props DESC NULLS FIRST) AS place FROM client)
    WHERE place > 1""",
        "client",
    ),
    "recon_fixed_rows": I.with_inputs(
        """SELECT * FROM product_file WHERE product_rk IN (SELECT product_rk
      FROM (SELECT * FROM product_table EXCEPT SELECT * FROM product_file))""",
        *_BOTH,
    ),
    "gap_check": _gap_sql("account_day"),
    "gap_check_daily": _gap_sql("daily_sum"),
    "key_violations": I.with_inputs(
        """SELECT account_rk, effective_date, count(*) AS row_count
    FROM account_day GROUP BY account_rk, effective_date HAVING count(*) > 1""",
        "account_day",
    ),
    "version_overlaps": I.with_inputs(
        """SELECT currency_rk, data_actual_date, row_count, reaches FROM (
      SELECT *, max(last_day) OVER (PARTITION BY currency_rk ORDER BY data_actual_date
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reaches
      FROM (SELECT currency_rk, data_actual_date, count(*) AS row_count,
              max(COALESCE(data_actual_end_date, DATE '9999-12-31')) AS last_day
            FROM stage GROUP BY currency_rk, data_actual_date))
    WHERE row_count > 1 OR reaches >= data_actual_date""",
        more={"stage": STAGE_SQL["rate"]},
    ),
    "null_profile": I.with_inputs(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM holiday"
            for c in _HOLIDAY_COLUMNS
        ),
        "holiday",
    ),
    "scalar_casts": """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS iso_day,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS amount,
      left(o_orderpriority, 3) AS short_label,
      CAST(left(o_orderpriority, 1) AS INTEGER) AS rank, CAST(NULL AS INTEGER) AS not_a_number,
      CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before,
      CAST(o_orderdate AS DATE) + 1 AS next_day,
      CASE WHEN o_orderstatus = 'P' THEN 'kept' END AS token
    FROM orders""",
    "audit_latest": """WITH log AS (SELECT CAST(user_id AS VARCHAR) AS run_id, ts, event_id,
      props, CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'error' THEN 'FAILED'
        ELSE 'SUCCESS' END AS status FROM events),
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id
        ORDER BY ts DESC, status <> 'STARTED' DESC, status DESC) AS place FROM log)
      WHERE place = 1),
    ends AS (SELECT run_id, min(ts) FILTER (status = 'STARTED') AS start_time,
        max(ts) FILTER (status <> 'STARTED') AS end_time FROM log GROUP BY run_id)
    SELECT run_id, 'event_stream' AS process, 'table_' || run_id AS table_name,
      start_time, end_time, status, props AS message, event_id AS input_rows,
      CAST(0 AS BIGINT) AS inserted_rows, CAST(0 AS BIGINT) AS updated_rows,
      event_id AS skipped_rows
    FROM last JOIN ends USING (run_id)""",
}
