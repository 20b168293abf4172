"""The raw operational tables, derived by Spark from the given retail tables.

A region is a city, an order is a crew shift and a safety observation, a line
item is an outage, an event is a meter reading and a part is a generator. Every
frame covers all rows of its source, so it grows with the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.functions import calendar, energy, field
from opsmart.functions.core import lookup
from opsmart.operators.reshape import melt_with_units, stack_by_name
from opsmart.session import materialize_bucketed

# Fixed values of the analogy between retail and utility columns.
CREW_BY_SEGMENT = {"AUTOMOBILE": "Lineman", "BUILDING": "Engineer", "FURNITURE": "Inspector", "HOUSEHOLD": "Safety Officer", "MACHINERY": "Lineman"}
JOB_BY_DIGIT = {1: "Emergency Response", 2: "Storm Restoration", 3: "Maintenance", 4: "Inspection", 5: "Training"}
OBSERVATION_BY_DIGIT = {1: "Incident", 2: "Near Miss", 3: "Unsafe Condition", 4: "Positive Observation", 5: "Property Damage"}
SEVERITY_BY_SEGMENT = {"AUTOMOBILE": "Low", "BUILDING": "Medium", "FURNITURE": "High", "HOUSEHOLD": "Critical", "MACHINERY": "Unrated"}
ROOT_CAUSE_BY_STATUS = {"F": "Human Error", "O": "Heat Stress", "P": "Flooding"}
ASSET_BY_SEGMENT = {"AUTOMOBILE": "Transformer", "BUILDING": "Substation", "FURNITURE": "Underground Cable", "HOUSEHOLD": "Power Line", "MACHINERY": "Smart Meter"}
CATEGORY_BY_STATUS = {"F": "Labor", "O": "Materials", "P": "Contractor"}
CAUSE_BY_FLAGS = {"AF": "Wind Damage", "AO": "Tree Contact", "NF": "Equipment Failure", "NO": "Planned Maintenance", "RF": "Lightning Strike", "RO": "Unknown"}
FUEL_BY_WORD = {"blue": "WAT", "cold": "WND", "hot": "NG", "large": "COL", "new": "SUN", "old": "DFO", "red": "MWH", "small": "LIG"}
SECTOR_BY_DIGIT = {1: "RES", 2: "COM", 3: "IND", 4: "TRA", 5: "ALL"}


# Columns of the given tables. A stated schema spares Spark a look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _digit() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def places(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.translate("r_name", " ", "_").alias("city")
    )


def placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = read(spark, folder, "orders"), read(spark, folder, "customer")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({"day": F.to_date("o_orderdate"), "digit": _digit()})
    )


def written_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The placed orders as a table in buckets of day and city, for queries that derive several facts from them."""
    columns = ("o_orderkey", "day", "city", "digit", "o_totalprice", "o_orderstatus", "c_acctbal", "c_mktsegment")
    return materialize_bucketed(placed_orders(spark, folder).select(*columns), "day", "city")


def weather(spark: SparkSession, folder: str, placed: DataFrame | None = None) -> DataFrame:
    price = F.col("o_totalprice")
    return (placed or placed_orders(spark, folder)).groupBy(F.col("day").alias("date"), "city").agg(
        F.round(F.max(price) / 4500, 1).alias("temp_max_f"),
        F.round(F.min(price) / 4500, 1).alias("temp_min_f"),
        F.round(F.nullif(F.max(price) - F.min(price), F.lit(0.0)) / 400000, 2).alias("precipitation_inches"),
        F.round(F.max("c_acctbal") / 200, 1).alias("wind_speed_max_mph"),
        (F.min("digit") * F.max("digit") * 4 - 4).cast("double").alias("weather_code"),
    )


def outages(spark: SparkSession, folder: str) -> DataFrame:
    lines, supplier = read(spark, folder, "lineitem"), read(spark, folder, "supplier")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_orderkey").alias("outage_id"),
            F.to_date("l_shipdate").alias("outage_date"),
            "city",
            F.concat(F.lit("C"), F.col("l_suppkey")).alias("circuit"),
            lookup(F.concat("l_returnflag", "l_linestatus"), CAUSE_BY_FLAGS).alias("cause"),
            (F.col("l_quantity") / 2).alias("duration_hours"),
            F.floor(F.col("l_extendedprice") / 10).cast("int").alias("customers_affected"),
            F.floor(F.col("l_discount") * 40).cast("int").alias("weather_risk_score"),
        )
    )


def workforce(spark: SparkSession, folder: str, placed: DataFrame | None = None) -> DataFrame:
    shifts = (placed or placed_orders(spark, folder)).withColumns(
        {
            "hours_worked": F.round(F.col("o_totalprice") / 50000 + 4, 1),
            "hourly_rate": F.round(F.abs("c_acctbal") / 250 + 45, 2),
        }
    ).withColumn("is_overtime", F.when(F.col("hours_worked") > 8, 1).otherwise(0))
    return shifts.select(
        F.col("o_orderkey").alias("record_id"),
        F.col("day").alias("work_date"),
        "city",
        field.crew_id("city", "digit").alias("crew_id"),
        lookup("c_mktsegment", CREW_BY_SEGMENT).alias("crew_type"),
        lookup("digit", JOB_BY_DIGIT).alias("job_type"),
        "hours_worked",
        "is_overtime",
        "hourly_rate",
        field.labor_cost("hours_worked", "hourly_rate", "is_overtime").alias("labor_cost"),
        (F.col("digit") - 1).alias("risk_score"),
    )


def safety(spark: SparkSession, folder: str, placed: DataFrame | None = None) -> DataFrame:
    return (placed or placed_orders(spark, folder)).select(
        F.col("o_orderkey").alias("obs_id"),
        F.col("day").alias("obs_date"),
        "city",
        field.crew_id("city", "digit").alias("crew_id"),
        lookup("c_mktsegment", CREW_BY_SEGMENT).alias("crew_type"),
        lookup("digit", OBSERVATION_BY_DIGIT).alias("observation_type"),
        lookup("c_mktsegment", SEVERITY_BY_SEGMENT).alias("severity"),
        lookup("o_orderstatus", ROOT_CAUSE_BY_STATUS).alias("root_cause"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("days_to_close"),
        (F.col("digit") - 1).alias("weather_risk_score"),
        calendar.season(F.month("day")).alias("season"),
    )


def spend(spark: SparkSession, folder: str, placed: DataFrame | None = None) -> DataFrame:
    return (placed or placed_orders(spark, folder)).select(
        F.col("o_orderkey").alias("spend_id"),
        F.year("day").alias("spend_year"),
        F.month("day").alias("spend_month"),
        "city",
        lookup("c_mktsegment", ASSET_BY_SEGMENT).alias("asset_type"),
        lookup("o_orderstatus", CATEGORY_BY_STATUS).alias("cost_category"),
        F.round(F.col("o_totalprice") / 10, 2).alias("amount_usd"),
        (5 - F.col("digit")).cast("double").alias("avg_risk_score"),
    )


def meter_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with the value as text, as an API would deliver it."""
    return read(spark, folder, "events").select("ts", (F.col("value") * 15).cast("string").alias("value"))


def generators(spark: SparkSession, folder: str) -> DataFrame:
    code = lookup(F.substring_index("p_name", " ", 1), FUEL_BY_WORD)
    return read(spark, folder, "part").select(
        F.add_months(F.lit("2024-01-01").cast("date"), F.floor((F.col("p_size") - 1) / 5).cast("int")).alias("period"),
        F.lit("CO").alias("state"),
        F.col("p_brand").alias("plant_name"),
        F.col("p_partkey").cast("string").alias("generator_id"),
        code.alias("energy_source_code"),
        energy.fuel_type(code).alias("fuel_type"),
        F.col("p_type").alias("technology"),
        F.round((F.col("p_retailprice") - 900) * 7, 1).alias("net_summer_capacity_mw"),
        ((F.col("p_size") - 1) * 15).cast("double").alias("nameplate_capacity_mw"),
    )


def sales_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Months by priority, one column per metric and a unit column for three of them."""
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    months = read(spark, folder, "orders").groupBy(calendar.month_to_period("o_orderdate").alias("period"), "o_orderpriority").agg(
        F.count("*").alias("customers"),
        F.round(total / 1000000, 4).alias("revenue"),
        F.round(total / 50000, 3).alias("sales"),
        F.round(total / F.count("*") / 20000, 2).alias("price"),
    )
    return months.select(
        "period",
        F.lit("CO").alias("stateid"),
        lookup(F.substring("o_orderpriority", 1, 1).cast("int"), SECTOR_BY_DIGIT).alias("sectorid"),
        F.col("o_orderpriority").alias("sectorName"),
        "customers", "revenue", "sales", "price",
        F.lit("million dollars").alias("revenue-units"),
        F.lit("million kWh").alias("sales-units"),
        F.lit("cents").alias("price-units"),
    )


def sales_long(spark: SparkSession, folder: str) -> DataFrame:
    wide = sales_wide(spark, folder)
    ids = ["period", F.col("stateid").alias("state_id"), F.lit("Colorado").alias("state_name"),
           F.col("sectorid").alias("sector"), F.col("sectorName").alias("sector_name")]
    return melt_with_units(wide, ids, ["sales", "revenue", "customers", "price"])


def grid_nodes(spark: SparkSession, folder: str) -> DataFrame:
    nation, region, supplier = (read(spark, folder, n) for n in ("nation", "region", "supplier"))
    homes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    fixed = lambda kind, kv, mw: [
        F.lit(kind).alias("node_type"), F.col("r_name").alias("city"),
        F.lit(kv).cast("long").alias("voltage_kv"), F.lit(mw).cast("long").alias("capacity_mw"),
    ]
    return stack_by_name([
        region.select(F.concat(F.lit("R"), "r_regionkey").alias("node_id"), *fixed("Transmission Hub", 345, 2500)),
        homes.select(F.concat(F.lit("N"), "n_nationkey").alias("node_id"), *fixed("Substation", 230, 1200)),
        supplier.join(homes, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.concat(F.lit("S"), "s_suppkey").alias("node_id"),
            F.lit("Power Plant").alias("node_type"), F.col("r_name").alias("city"),
            F.when(F.col("s_acctbal") >= 0, 138).otherwise(69).cast("long").alias("voltage_kv"),
            F.floor(F.abs("s_acctbal") / 10).cast("long").alias("capacity_mw"),
        ),
    ])


def grid_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers hang on their nation, nations on their region, and each nation on the next one."""
    nation, supplier = read(spark, folder, "nation"), read(spark, folder, "supplier")
    following = nation.select((F.col("n_nationkey") - 1).alias("before"), F.col("n_nationkey").alias("after"))
    long = lambda value, name: (value if isinstance(value, Column) else F.lit(value)).cast("long").alias(name)
    return stack_by_name([
        nation.select(
            F.concat(F.lit("N"), "n_nationkey").alias("source_node"), F.concat(F.lit("R"), "n_regionkey").alias("target_node"),
            long(F.col("n_nationkey") + 10, "distance_miles"), long(1500, "capacity_mw"), F.lit("Transmission").alias("line_type"),
        ),
        nation.join(following, F.col("n_nationkey") == F.col("before")).select(
            F.concat(F.lit("N"), "n_nationkey").alias("source_node"), F.concat(F.lit("N"), "after").alias("target_node"),
            long(25, "distance_miles"), long(900, "capacity_mw"), F.lit("Transmission").alias("line_type"),
        ),
        supplier.select(
            F.concat(F.lit("S"), "s_suppkey").alias("source_node"), F.concat(F.lit("N"), "s_nationkey").alias("target_node"),
            long(F.floor(F.abs("s_acctbal") / 250) + 1, "distance_miles"), long(F.floor(F.abs("s_acctbal") / 8), "capacity_mw"),
            F.lit("Distribution").alias("line_type"),
        ),
    ])


def grid_network(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    edges = grid_edges(spark, folder).select(
        F.col("source_node").alias("src"), F.col("target_node").alias("dst"), F.col("distance_miles").alias("weight")
    )
    return grid_nodes(spark, folder).select(F.col("node_id").alias("node")), edges


def supply_network(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers (negative ids) and parts, linked by every line item; the weight is the smallest quantity."""
    edges = read(spark, folder, "lineitem").select(
        (-1 - F.col("l_suppkey")).alias("src"), F.col("l_partkey").alias("dst"), F.col("l_quantity").cast("long").alias("weight")
    )
    nodes = read(spark, folder, "supplier").select((-1 - F.col("s_suppkey")).alias("node")).unionByName(
        read(spark, folder, "part").select(F.col("p_partkey").alias("node"))
    )
    return nodes, edges


def shipment_network(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders and shipments (negative ids): a shipment is all a supplier sends on one day."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    shipment = -1 - (F.col("l_suppkey") * 1000000 + day)
    edges = read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("src"), shipment.alias("dst"), F.lit(1).alias("weight"))
    nodes = read(spark, folder, "orders").select(F.col("o_orderkey").alias("node")).unionByName(
        edges.select(F.col("dst").alias("node")).distinct()
    )
    return nodes, edges
