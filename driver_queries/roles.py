"""The driver tables in the roles the operators need, in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinedeck.functions.axes import RegularAxis
from brinedeck.operators.grid import melt_array


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(value: Column | str, digits: int = 6) -> Column:
    """Rounded double; adding 0 turns a negative zero into zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Orders as sampling trips."""
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("trip"), F.col("o_orderdate").alias("date"))


def taxa(spark: SparkSession, d: str) -> DataFrame:
    """Line items with their part as counted taxa.

    The line number marks some records as unidentified, unknown or null, so that the
    missing-value rules have something to do.
    """
    line = table(spark, d, "lineitem")
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    part = table(spark, d, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type",
        F.concat(second, F.lit(" small")).alias("p_species"), F.concat(F.lit("cf. "), second).alias("p_unsure"),
    )
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("trip"),
        F.col("p_name").alias("taxon"),
        F.when(n == 6, None).otherwise(F.col("p_brand")).alias("genus"),
        F.when((n == 7) & (q > 25), "spp.").when(n == 7, F.col("p_unsure"))
        .when((n == 5) & (q > 40), None).otherwise(F.col("p_species")).alias("species"),
        F.col("p_type").alias("grp"),
        F.when(q < 49, q).alias("cells"),
        F.when(F.col("l_discount") < 0.1, F.floor("l_extendedprice").cast("double")).alias("biovol"),
    )


TAXA = """(
  select l_orderkey as trip, p_name as taxon,
         case when l_linenumber = 6 then null else p_brand end as genus,
         case when l_linenumber = 7 and l_quantity > 25 then 'spp.'
              when l_linenumber = 7 then 'cf. ' || split_part(p_name, ' ', 2)
              when l_linenumber = 5 and l_quantity > 40 then null
              else split_part(p_name, ' ', 2) || ' small' end as species,
         p_type as grp,
         case when l_quantity < 49 then l_quantity end as cells,
         case when l_discount < 0.1 then floor(l_extendedprice) end as biovol
  from lineitem join part on l_partkey = p_partkey
)"""
SAMPLES = "(select o_orderkey as trip, o_orderdate as date from orders)"
IDENTIFIED = "(species is not null and species <> 'spp.' and not regexp_matches(species, 'cf.') and not regexp_matches(species, 'grp'))"


def change_log(spark: SparkSession, d: str) -> DataFrame:
    """Change log from the part names: longer names were told apart later."""
    names = table(spark, d, "part").select(F.col("p_name").alias("taxon")).distinct()
    return names.select(
        "taxon",
        F.add_months(F.lit("1995-01-01"), F.length("taxon") * 3).cast("timestamp_ntz").alias("start"),
        F.concat(F.lit("blue "), F.split_part("taxon", F.lit(" "), F.lit(2))).alias("parent"),
    )


LOG = """(
  select taxon, cast(date '1995-01-01' + to_months(cast(length(taxon) * 3 as integer)) as timestamp) as start,
         'blue ' || split_part(taxon, ' ', 2) as parent
  from (select distinct p_name as taxon from part)
)"""


def traits(spark: SparkSession, d: str) -> DataFrame:
    """Mean size of the parts of a name, and a diet by name length."""
    return table(spark, d, "part").groupBy(F.col("p_name").alias("taxon")).agg(
        F.avg("p_size").alias("size"),
        F.when(F.length("p_name") % 3 == 0, F.lit("CC")).otherwise(F.lit("CO")).alias("DIET"),
    )


TRAITS = """(
  select p_name as taxon, avg(p_size) as size, case when length(p_name) % 3 = 0 then 'CC' else 'CO' end as diet
  from part group by p_name
)"""

GRID_AXIS = RegularAxis(0.0, 1.0, 8)
NORTH_FIRST = RegularAxis(7.0, -1.0, 8)


def grid(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as 8 x 8 grid layers: the label is the period, the vector number the layer."""
    long = melt_array(table(spark, d, "embeddings"), ["vec_id", "label"], "embedding", 8)
    return long.withColumns({"lon": GRID_AXIS.coord(F.col("lon_idx")), "lat": GRID_AXIS.coord(F.col("lat_idx"))})


GRID = """(
  select vec_id, label, cast((p - 1) // 8 as integer) as lat_idx, cast((p - 1) % 8 as integer) as lon_idx,
         cast((p - 1) % 8 as double) as lon, cast((p - 1) // 8 as double) as lat, cast(embedding[p] as double) as value
  from (select vec_id, label, embedding, unnest(range(1, 65)) as p from embeddings)
)"""


def layers(spark: SparkSession, d: str) -> DataFrame:
    """One mean layer per period and product; the product is the parity of the layer."""
    return grid(spark, d).groupBy(
        F.col("label").alias("period"), F.when(F.col("vec_id") % 2 == 0, "sst").otherwise("chl").alias("product"), "lon_idx", "lat_idx",
    ).agg(F.avg(F.when(F.col("value") > -0.2, F.col("value"))).alias("value"))


LAYERS = f"""(
  select label as period, case when vec_id % 2 = 0 then 'sst' else 'chl' end as product, lon_idx, lat_idx,
         avg(case when value > -0.2 then value end) as value
  from {GRID} group by all
)"""


def points(spark: SparkSession, d: str) -> DataFrame:
    """Customers as points in and around the grid; some periods have no layer."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("pid"),
        ((F.col("c_custkey") % 90) / 10.0).alias("x"),
        F.round((F.col("c_acctbal") + 1000.0) / 1375.0, 2).alias("y"),
        (F.col("c_custkey") % 12).cast("int").alias("period"),
    )


POINTS = """(
  select c_custkey as pid, (c_custkey % 90) / 10.0 as x, round((c_acctbal + 1000.0) / 1375.0, 2) as y,
         cast(c_custkey % 12 as integer) as period
  from customer
)"""


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def community(spark: SparkSession, d: str) -> DataFrame:
    """Nations as samples, brands as taxa."""
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("c_nationkey").alias("site"), F.col("p_brand").alias("taxon"), F.col("l_quantity").alias("n"), "year")
    )


COMMUNITY = """(
  select c_nationkey as site, p_brand as taxon, l_quantity as n, year(o_orderdate) as year
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey
)"""
