"""Master data: the property dimension and the alias maps of all sources
(C2-C4, J10, J11, S13, Q9).

The strings that sources use for a property, product, category or account are
derived from the tables by fixed rules, one statement of SQL that Spark and
DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aliases import coverage, exact_keys, resolve
from ..operators.lookup import alias_seeds, contains_match, token_overlap_match
from ..session import written_table
from ..sources.io import seed_dim
from .roles import FNB_REGION, Star

# Product categories, in the order of their ids.
CATEGORY_NAMES = ["Standard", "Medium", "Economy", "Large", "Promo"]
#: Tokens that a product's or an account's name and a string must share.
PRODUCT_TOKENS, ACCOUNT_TOKENS = 2, 1

#: map -> SQL of the strings (``raw``) that its sources use.
OBSERVED = {
    "property": """
WITH seen AS (
  SELECT c_nationkey AS n, o_orderkey AS k FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  UNION ALL
  SELECT s_nationkey, l_orderkey + l_linenumber FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey)
SELECT CASE k % 9 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) || ' ' WHEN 2 THEN 'MG ' || n_name WHEN 3 THEN 'MG ' || r_name
         WHEN 4 THEN 'Branch of ' || replace(n_name, '_', ' ') || ' desk' WHEN 5 THEN '  ' || replace(n_name, '_', '-')
         WHEN 6 THEN replace(n_name, '_', '') || ' annex' WHEN 7 THEN 'Closed House ' || CAST(k % 11 AS STRING) END AS raw
FROM seen JOIN {nation} ON n = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "product": """
WITH seen AS (SELECT p_name, l_orderkey + l_linenumber AS k FROM {lineitem} JOIN {part} ON l_partkey = p_partkey)
SELECT CASE k % 6 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) || ' special' WHEN 2 THEN replace(p_name, ' ', '-')
         WHEN 3 THEN split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
         WHEN 4 THEN split_part(p_name, ' ', 2) || ' deluxe' ELSE 'chef ' || CAST(k % 7 AS STRING) END AS raw
FROM seen""",
    "category": """
WITH seen AS (SELECT p_type, l_orderkey + l_linenumber AS k FROM {lineitem} JOIN {part} ON l_partkey = p_partkey)
SELECT CASE k % 4 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) || ' ' WHEN 2 THEN '*' || p_type || '*' ELSE p_type || ' misc' END AS raw
FROM seen""",
    "account": """
WITH seen AS (SELECT account_name, o_orderkey AS k FROM {orders} JOIN {accounts} ON o_orderpriority = priority)
SELECT CASE k % 6 WHEN 0 THEN account_name WHEN 1 THEN upper(account_name) WHEN 2 THEN 'Total ' || account_name
         WHEN 3 THEN split_part(account_name, ' ', 2) || ' (misc)' WHEN 4 THEN replace(account_name, ' ', '-')
         ELSE 'Sundry ' || CAST(k % 5 AS STRING) END AS raw
FROM seen""",
}


def property_dim(star: Star) -> DataFrame:
    """Hotels and F&B units as one dimension; units have no rooms."""
    n = star.t("nation").join(F.broadcast(star.t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    names = [F.col("n_nationkey").alias("property_id"), F.col("n_name").alias("property_name"), F.col("n_name").alias("city"),
             F.col("r_name").alias("region")]
    hotels = n.where(F.col("r_name") != FNB_REGION).select(
        *names, F.lit("Hotel").alias("business_type"), (100 + 4 * F.col("n_nationkey")).cast("int").alias("rooms"),
        F.lit("Midscale").alias("property_class"))
    units = n.where(F.col("r_name") == FNB_REGION).select(
        *names, F.lit("F&B").alias("business_type"), F.lit(None).cast("int").alias("rooms"), F.lit("F&B").alias("property_class"))
    return hotels.unionByName(units)


def observed(star: Star, name: str) -> DataFrame:
    text = OBSERVED[name]
    used = {t: star.t(t) for t in ("orders", "customer", "lineitem", "supplier", "nation", "region", "part") if f"{{{t}}}" in text}
    if "{accounts}" in text:
        used["accounts"] = star.dim_account
    return star.spark.sql(text, **used)


def property_map(star: Star) -> DataFrame:
    """Seeded aliases (of a key that several properties claim, hotels come
    first), else the first property whose city the string contains."""
    dim = property_dim(star).withColumn("priority", (F.col("business_type") != "Hotel").cast("int"))
    seeds = alias_seeds(dim, "property_id", "property_name", ["city", "region"], "MG", "priority")
    return resolve(observed(star, "property"), "raw", {"seed": seeds}, (
        "contains", lambda rest: contains_match(rest, "raw", dim, "city", "property_id", "property_id", "id")))


def product_map(star: Star) -> DataFrame:
    """The product's name, else the name that shares most tokens, two at
    least. Of products of one name the least id stands for all."""
    dim = star.t("part").select("p_partkey", "p_name")
    names = dim.groupBy("p_name").agg(F.min("p_partkey").alias("p_partkey"))
    return resolve(observed(star, "product"), "raw", {"exact": exact_keys(dim, "p_name", "p_partkey")}, (
        "tokens", lambda rest: token_overlap_match(rest, "raw", names, "p_name", "p_partkey", "p_partkey", PRODUCT_TOKENS, "id")))


def category_map(star: Star) -> DataFrame:
    """The observed strings that normalize onto a category; no others."""
    dim = seed_dim(star.spark, CATEGORY_NAMES, "C", 3)
    return resolve(observed(star, "category"), "raw", {"exact": exact_keys(dim, "name", "id")}).where("id IS NOT NULL")


def account_map(star: Star) -> DataFrame:
    """C4: the account's name, else the name that shares most tokens."""
    dim = star.dim_account.select("account_id", "account_name")
    return resolve(observed(star, "account"), "raw", {"exact": exact_keys(dim, "account_name", "account_id")}, (
        "tokens", lambda rest: token_overlap_match(rest, "raw", dim, "account_name", "account_id", "account_id", ACCOUNT_TOKENS, "id")))


MAPS = {"property": property_map, "product": product_map, "category": category_map, "account": account_map}


def map_coverage(star: Star) -> DataFrame:
    """Q9 for the four maps, each built once."""
    out = None
    for name, build in MAPS.items():
        c = coverage(written_table(build(star), f"map-{name}"), name)
        out = c if out is None else out.unionByName(c)
    return out
