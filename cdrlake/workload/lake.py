"""Silver, Gold and score frames over one set of test tables, built lazily."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import churn, gold, silver, views
from ..session import scratch_dir
from ..sinks.tables import write_table
from ..streaming import events as stream_events
from . import bronze


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return bronze.table(self.spark, self.sf_dir, name)

    @cached_property
    def bronze_cdr(self) -> DataFrame:
        return bronze.cdr(self.spark, self.sf_dir)

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return bronze.customers(self.spark, self.sf_dir)

    @cached_property
    def bronze_recharges(self) -> DataFrame:
        return bronze.recharges(self.spark, self.sf_dir)

    @cached_property
    def cdr(self) -> DataFrame:
        return silver.silver_cdr(self.bronze_cdr)

    @cached_property
    def customers(self) -> DataFrame:
        return silver.silver_customers(self.bronze_customers)

    @cached_property
    def recharges(self) -> DataFrame:
        return silver.silver_recharges(self.bronze_recharges)

    @cached_property
    def raw_events(self) -> DataFrame:
        return bronze.events(self.spark, self.sf_dir)

    @cached_property
    def parsed_events(self) -> DataFrame:
        return stream_events.parse_events(self.raw_events)

    @cached_property
    def events(self) -> DataFrame:
        return stream_events.silver_events(self.parsed_events)

    @cached_property
    def usage(self) -> DataFrame:
        return gold.usage_rows(self.cdr)

    @cached_property
    def cdr_monthly(self) -> DataFrame:
        return gold.cdr_monthly(self.usage)

    @cached_property
    def recharge_monthly(self) -> DataFrame:
        return gold.recharge_monthly(self.recharges)

    @cached_property
    def arpu(self) -> DataFrame:
        return gold.gold_arpu(self.cdr_monthly, self.recharge_monthly, self.customers)

    @cached_property
    def summary(self) -> DataFrame:
        return gold.customer_summary(self.customers, self.usage, self.recharges)

    @cached_property
    def regional(self) -> DataFrame:
        return gold.regional_kpis(self.customers, self.usage)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily_trend(self.usage)

    @cached_property
    def features(self) -> DataFrame:
        return gold.churn_features(self.customers, self.usage, self.recharges)

    @cached_property
    def trend(self) -> DataFrame:
        return views.vw_arpu_monthly_trend(self.arpu)

    @cached_property
    def core_360(self) -> DataFrame:
        return views.customer_360_core(self.summary)

    def store_facts(self, path: str) -> DataFrame:
        """Store what summary and features are made of, for queries that need both: the CDRs are read once for them."""
        profile = self.customers.select(*dict.fromkeys([*gold.SUMMARY_PROFILE, *gold.FEATURE_PROFILE]))
        facts = gold.customer_facts(profile, self.usage, self.recharges)
        write_table(facts, path)
        return self.spark.read.schema(facts.schema).parquet(path)

    @cached_property
    def stored_facts(self) -> DataFrame:
        return self.store_facts(f"{scratch_dir(self.spark, 'facts')}/customer_facts")

    @cached_property
    def stored_summary(self) -> DataFrame:
        return gold.facts_summary(self.stored_facts)

    @cached_property
    def stored_rule_scores(self) -> DataFrame:
        return self._by_rule(gold.facts_features(self.stored_facts))

    @cached_property
    def rule_scores(self) -> DataFrame:
        """Scores by a fixed rule over the features, to check the readers of scores against SQL."""
        return self._by_rule(self.features)

    @staticmethod
    def _by_rule(features: DataFrame) -> DataFrame:
        key = F.expr("cast(substring(customer_id, 5) as bigint)")
        activity = F.col("total_calls") * 7 + F.col("active_days") * 3 + F.col("total_recharges") * 11
        p = (((key * 37 + activity) % 101).cast("decimal(3,0)") * F.lit("0.0099").cast("decimal(5,4)")).cast("decimal(12,9)")
        scored = churn.with_bands(features.withColumn("churn_probability", p))
        return scored.select(*churn.SCORE_COLUMNS)

    @cached_property
    def rule_360(self) -> DataFrame:
        return views.vw_customer_360(self.stored_summary, self.stored_rule_scores)
