"""Billing rows: usage query, exported files, normalised cost lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costalloc.functions.ids import last_path_part, normalize_resource_id, path_part_after
from costalloc.functions.meters import cost_type, model_family, token_type
from costalloc.functions.numbers import ratio_or_zero
from costalloc.functions.timeparts import billing_timestamp
from costalloc.operators.skew import salted_join
from costalloc.schemas import BILLING_EXPORT

# The services whose cost is split.
SERVICES = ["Azure OpenAI", "Cognitive Services"]


def model_services(billing: DataFrame) -> DataFrame:
    """The billing rows whose cost is split; other services on the same bill have no calls to go by."""
    return billing.where(F.col("ServiceName").isin(SERVICES)) if "ServiceName" in billing.columns else billing


def query_cost_usage(billing: DataFrame, start=None, end=None) -> DataFrame:
    """Daily cost and usage of the model services per resource and meter."""
    rows = model_services(billing)
    if start is not None:
        rows = rows.where(F.col("UsageDate") >= F.lit(str(start)).cast("timestamp"))
    if end is not None:
        rows = rows.where(F.col("UsageDate") < F.lit(str(end)).cast("timestamp"))
    return rows.groupBy(
        F.to_date("UsageDate").alias("UsageDate"), "ResourceId", "ResourceType", "ServiceName", "Meter"
    ).agg(
        F.sum("PreTaxCost").alias("PreTaxCost"),
        F.sum("UsageQuantity").alias("UsageQuantity"),
        F.min("Currency").alias("Currency"),
    )


def read_cost_json(spark: SparkSession, path: str, one_array: bool = False) -> DataFrame:
    """Exported billing rows. JSON lines split over tasks; one_array reads a file
    that holds a single JSON array, which Spark has to read in one task per file."""
    reader = spark.read.schema(BILLING_EXPORT).option("multiLine", one_array)
    return reader.json(path)


def categorize_cost(rows: DataFrame, extended: bool = False) -> DataFrame:
    """Cost type, token type, model family and unit cost from the meter name."""
    token = token_type("MeterName", extended)
    return rows.withColumns(
        {
            "CostType": cost_type("MeterName", extended),
            "TokenType": token,
            "ModelFamily": model_family("MeterName"),
            "IsTokenBased": token.isNotNull(),
            "CostPerUnit": ratio_or_zero(F.col("Cost"), F.col("UsageQuantity")),
        }
    )


def normalize_cost(billing: DataFrame, extended: bool = False) -> DataFrame:
    """Raw billing rows to cost lines: defaults, path parts, meter categories.

    Both spellings of the amount columns are read (PreTaxCost or totalCost,
    UsageQuantity or usageQuantity); every other column is kept as it is.
    """
    names = set(billing.columns)

    def pick(options: list[str], default: Column) -> Column:
        return F.coalesce(*[F.col(o) for o in options if o in names], default)

    path = pick(["ResourceId"], F.lit(""))
    amount = [o for o in ("PreTaxCost", "totalCost") if o in names]
    quantity = [o for o in ("UsageQuantity", "usageQuantity") if o in names]
    lines = billing.select(
        path.alias("ResourceId"),
        pick(["ResourceType"], F.lit("Unknown")).alias("ResourceType"),
        pick(["ServiceName"], F.lit(SERVICES[0])).alias("ServiceName"),
        pick(["Meter", "MeterName"], F.lit("Unknown")).alias("MeterName"),
        billing_timestamp(billing, "UsageDate").alias("UsageDate"),
        F.coalesce(*[F.col(c).try_cast("double") for c in amount], F.lit(0.0)).alias("Cost"),
        F.coalesce(*[F.col(c).try_cast("double") for c in quantity], F.lit(0.0)).alias("UsageQuantity"),
        pick(["Currency"], F.lit("USD")).alias("Currency"),
        pick(["BillingPeriod"], F.lit("")).alias("BillingPeriod"),
        path_part_after(path, "subscriptions").alias("SubscriptionId"),
        path_part_after(path, "resourceGroups").alias("ResourceGroup"),
        last_path_part(path).alias("ResourceName"),
        *[F.col(c) for c in ("cost_seq",) if c in names],
    )
    return categorize_cost(lines, extended)


def filter_costs_by_resources(costs: DataFrame, resources: list[str] | DataFrame) -> DataFrame:
    """Cost lines of the listed resources; an empty list keeps them all.

    A table may name a resource by path, address or plain name: both sides are normalised.
    """
    if isinstance(resources, DataFrame):
        others = [c for c in costs.columns if c != "ResourceId"]
        wanted = resources.select(normalize_resource_id(F.col("ResourceId")).alias("_resource")).distinct()
        named = costs.withColumn("_resource", normalize_resource_id(F.col("ResourceId")))
        return salted_join(named, wanted, ["_resource"], others, "left_semi").drop("_resource")
    return costs.where(F.col("ResourceId").isin(list(resources))) if resources else costs
