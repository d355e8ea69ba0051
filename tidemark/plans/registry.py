"""Named queries over the test data, as registered in ``__spark_entry__``.

Each entry takes (spark, sf_dir) and returns a DataFrame. Model entries
return the model over the whole fixture; query, rollup and check
entries read the marts. For comparison with the SQL oracle the run date
and the build's instant are pinned (``AS_OF``, ``RUN_TS``) and decimals
are returned as double.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.operators.intermediate import payment_sequence
from tidemark.operators.quality import ACCOUNT_STATUS, Check, failures, run_checks, union_all
from tidemark.plans import curated as Q
from tidemark.plans import rollups as R
from tidemark.plans.models import MODELS, Warehouse
from tidemark.plans.summaries import Serving, summaries_database
from tidemark.session import checkpoint_dir, configure, shuffles_released
from tidemark.sources.catalog import MART_KEYS, build_marts, describe_table, list_tables
from tidemark.sources.fixtures import raw_tables
from tidemark.sources.publish import versions_database
from tidemark.sources.raw import read_catalog_tables, read_parquet_tables, write_parquet_tables
from tidemark.sources.views import LAYERS, create_views

AS_OF = dt.date(2002, 1, 1)
RUN_TS = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)

QueryFn = Callable[[SparkSession, str], DataFrame]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A fresh warehouse over the test data (lazy: nothing runs yet)."""
    configure(spark)
    return Warehouse(raw_tables(spark, sf_dir), as_of=AS_OF, run_ts=RUN_TS)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else c)
    return df.select(*cols)


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(warehouse(spark, sf_dir).model(name))
    run.__name__ = name
    return run


QUERIES: dict[str, QueryFn] = {name: _model_query(name) for name, m in MODELS.items()
                               if m.layer != "helper"}


def payment_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2b-D2d: every payment with its running frame."""
    return comparable(payment_sequence(warehouse(spark, sf_dir).model("stg_erp__payments")))


QUERIES["d2_payment_sequence"] = payment_frames


# ------------------------------------------------ queries over the marts
def _over(mart: str, fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(warehouse(spark, sf_dir).model(mart)))
    return run


# Parameters of the registered curated queries (the oracle uses the same).
LOOKUP_ACCOUNT = "A7"
RISK_BAND = "high"
HEALTH_BAND = "at_risk"
LEAD_OUTCOME = "closed_won"
ATTRIBUTION = "campaign"
ROW_LIMIT = 20
MAX_ROWS = 200

CHURN, REVENUE, FUNNEL = "mart_customer_churn", "mart_revenue", "mart_sales_funnel"

QUERIES.update({
    "q1_get_account_churn_risk":
        _over(CHURN, lambda m: Q.get_account_churn_risk(m, LOOKUP_ACCOUNT)),
    "q2_list_high_risk_accounts":
        _over(CHURN, lambda m: Q.list_high_risk_accounts(m, RISK_BAND, ROW_LIMIT)),
    "q3_get_account_revenue_health":
        _over(REVENUE, lambda m: Q.get_account_revenue_health(m, LOOKUP_ACCOUNT)),
    "q4_list_accounts_by_revenue_health":
        _over(REVENUE, lambda m: Q.list_accounts_by_revenue_health(m, HEALTH_BAND, ROW_LIMIT)),
    "q5_get_funnel_summary_by_stage": _over(FUNNEL, Q.get_funnel_summary_by_stage),
    "q6_list_leads_by_outcome":
        _over(FUNNEL, lambda m: Q.list_leads_by_outcome(m, LEAD_OUTCOME, ATTRIBUTION, ROW_LIMIT)),
    "q6_list_leads_by_outcome_any_attribution":
        _over(FUNNEL, lambda m: Q.list_leads_by_outcome(m, "in_pipeline", "all", MAX_ROWS)),
    "q7_average_churn_risk_by_tier": _over(CHURN, Q.average_churn_risk_by_tier),
    "r1_churn_kpis": _over(CHURN, R.churn_kpis),
    "r2_churn_by_band": _over(CHURN, R.churn_by_band),
    "r3_highest_risk_accounts": _over(CHURN, R.highest_risk_accounts),
    "r3_risk_bubble": _over(CHURN, R.risk_bubble),
    "r4_revenue_kpis": _over(REVENUE, R.revenue_kpis),
    "r5_revenue_by_health_band": _over(REVENUE, R.revenue_by_health_band),
    "r6_poor_collection_accounts": _over(REVENUE, R.poor_collection_accounts),
    "r7_funnel_kpis": _over(FUNNEL, R.funnel_kpis),
    "r8_leads_per_month": _over(FUNNEL, R.leads_per_month),
    "r9_conversion_by_source": _over(FUNNEL, R.conversion_by_source),
    "r10_return_by_campaign": _over(FUNNEL, R.return_by_campaign),
    "r10_return_by_channel": _over(FUNNEL, R.return_by_channel),
    "r10_return_by_source": _over(FUNNEL, R.return_by_source),
    "r11_top_won_deals": _over(FUNNEL, R.top_won_deals),
})


def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 95 checks over every model built from the test data."""
    wh = warehouse(spark, sf_dir)
    wh.write_checked(("helper",))
    return run_checks(wh.model)


QUERIES["v6_quality_suite"] = quality_suite


# The single checks, on raw tables whose rows do fail them.
RAW_CHECKS = {
    "v1_unique": ("leads", Check("leads", "contact_id", "unique")),
    "v2_not_null": ("contacts", Check("contacts", "account_id", "not_null")),
    "v3_accepted_values": ("accounts", Check("accounts", "account_status", "accepted_values",
                                             values=ACCOUNT_STATUS)),
    "v4_relationships": ("feature_usage", Check("feature_usage", "account_id", "relationships",
                                                to_model="contacts", to_column="account_id")),
    "v5_expression_is_true": ("orders", Check("orders", "unit_price", "expression_is_true",
                                              expression="unit_price >= 0")),
}


def _raw_check(table: str, check: Check) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = warehouse(spark, sf_dir).raw
        return comparable(failures(raw[table], check, raw.__getitem__))
    return run


QUERIES.update({name: _raw_check(*of) for name, of in RAW_CHECKS.items()})


class Scratch:
    """Databases of one query's own, dropped when its rows are read (a warehouse
    may keep the files of earlier sessions, so every call takes new names)."""

    def __init__(self, spark: SparkSession, *roles: str):
        tag = uuid.uuid4().hex[:12]
        self.spark, self.names = spark, {r: f"tidemark_{r}_{tag}" for r in roles}

    def __enter__(self) -> dict[str, str]:
        return self.names

    def __exit__(self, *_) -> None:
        for name in self.names.values():
            for database in (name, versions_database(name), summaries_database(name),
                             versions_database(summaries_database(name))):
                self.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def described_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts built, published and then read from the catalog: their
    rows, columns, documented columns, and two of the descriptions."""
    with Scratch(spark, "marts") as databases:
        database = databases["marts"]
        build_marts(spark, warehouse(spark, sf_dir), database=database)
        rows = []
        for r in list_tables(spark, database).collect():  # the three marts
            name = r["table_name"]
            columns = {c["column_name"]: c["description"]  # one row per column
                       for c in describe_table(spark, f"{database}.{name}").collect()}
            rows.append((name, spark.table(f"{database}.{name}").count(), len(columns),
                         sum(map(bool, columns.values())), r["description"], columns[MART_KEYS[name]]))
    return spark.createDataFrame(rows, "table_name string, n_rows long, n_columns long, n_documented long, "
                                       "description string, key_description string")


def landed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tables landed as parquet datasets and scanned by the raw reader."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-raw-{uuid.uuid4().hex[:12]}"
    write_parquet_tables(warehouse(spark, sf_dir).raw, root)
    return union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        for name, df in read_parquet_tables(spark, root).items()])


def _fingerprint(df: DataFrame, name: str, of: str) -> DataFrame:
    """One row: number of rows and the sum of their hashes (averages to 6 places)."""
    columns = [F.round(F.col(f.name), 6) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema]
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")), F.lit(0)).alias("hash")).select(
        F.lit(name).alias("view_name"), F.lit(of).alias("of"), "n_rows", "hash")


def stored_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tables in the catalog, the stored views over them, and whether
    each view's rows are its model's."""
    with Scratch(spark, "raw", "staging", "intermediate") as databases, shuffles_released(spark):
        wh = warehouse(spark, sf_dir)
        spark.sql(f"CREATE DATABASE {databases['raw']}")
        for table, df in wh.raw.items():
            df.write.option("compression", "zstd").saveAsTable(f"{databases['raw']}.{table}")
        create_views(spark, **databases, as_of=AS_OF)
        models = Warehouse(read_catalog_tables(spark, databases["raw"]), as_of=AS_OF, run_ts=RUN_TS)
        # the staging views move no rows and are read together; of the others one query's
        # shuffles lie on disk at a time
        together = [LAYERS["staging"], *[(n,) for n in LAYERS["intermediate"]]]
        rows = []
        for names in together:
            both = union_all([_fingerprint(df, n, of) for n in names for of, df in
                              (("view", spark.table(f"{databases[MODELS[n].layer]}.{n}")), ("model", models.model(n)))])
            rows += (both.groupBy("view_name").agg(
                F.max(F.when(F.col("of") == "view", F.col("n_rows"))).alias("n_rows"),
                (F.count_distinct("n_rows", "hash") == 1).alias("same")).collect())  # a row per view
    return spark.createDataFrame([tuple(r) for r in rows], "view_name string, n_rows long, same boolean")


SERVED_LISTS = {
    "accounts_by_risk": lambda s: s.list_high_risk_accounts(RISK_BAND, ROW_LIMIT),
    "accounts_by_health": lambda s: s.list_accounts_by_revenue_health(HEALTH_BAND, ROW_LIMIT),
    "leads_by_outcome": lambda s: s.list_leads_by_outcome(LEAD_OUTCOME, ATTRIBUTION, ROW_LIMIT),
    "leads_any_attribution": lambda s: s.list_leads_by_outcome("in_pipeline", "all", MAX_ROWS),
    "highest_risk": lambda s: s.highest_risk_accounts(),
    "poor_collection": lambda s: s.poor_collection_accounts(),
    "won_deals": lambda s: s.top_won_deals(),
}


def served_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked lists (Q2, Q4, Q6, R3, R6, R11) read from the tables built with
    the marts: list, place and key."""
    with Scratch(spark, "marts") as databases:
        build_marts(spark, warehouse(spark, sf_dir), database=databases["marts"])
        serving, rows = Serving(spark, databases["marts"]), []
        for name, of in SERVED_LISTS.items():   # at most 200 rows each
            rows += [(name, k, r[0]) for k, r in enumerate(of(serving).collect(), 1)]
    return spark.createDataFrame(rows, "list_name string, place int, key string")


def served_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPIs (R1, R4, R7) observed while the marts were written, by name."""
    with Scratch(spark, "marts") as databases:
        build_marts(spark, warehouse(spark, sf_dir), database=databases["marts"])
        serving = Serving(spark, databases["marts"])
        rows = [(page, n, None if v is None else float(v))
                for page, df in (("churn", serving.churn_kpis()), ("revenue", serving.revenue_kpis()),
                                 ("funnel", serving.funnel_kpis()))
                for n, v in comparable(df).first().asDict().items()]
    return spark.createDataFrame(rows, "page string, kpi string, value double")


QUERIES["s3_served_lists"] = served_lists
QUERIES["s3_served_kpis"] = served_kpis
QUERIES["s1_raw_tables"] = landed_tables
QUERIES["s2_stored_views"] = stored_views
QUERIES["s5_described_marts"] = described_tables
