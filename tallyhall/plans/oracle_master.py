"""DuckDB SQL of the property dimension and the alias maps."""

from __future__ import annotations

from .master import ACCOUNT_TOKENS, CATEGORY_NAMES, OBSERVED, PRODUCT_TOKENS
from .oracle import STAR_CTES, sql_norm_key
from .roles import FNB_REGION

_TABLES = ("orders", "customer", "lineitem", "supplier", "nation", "region", "part")


def _observed(name: str) -> str:
    text = OBSERVED[name].replace("{accounts}", "dim_account")
    for t in _TABLES:
        text = text.replace(f"{{{t}}}", t)
    return f"obs AS (SELECT DISTINCT raw, {sql_norm_key('raw')} AS alias_key FROM ({text}) WHERE raw IS NOT NULL)"


def _tokens(text: str) -> str:
    return f"unnest(list_distinct(string_split({sql_norm_key(text)}, ' ')))"


def _by_tokens(names: str, least: int) -> str:
    """CTE ``late``: the best of ``names`` (id, name) for each string that has
    no direct hit."""
    return f"""
late AS (
  SELECT raw, arg_min(id, (-n, id)) AS id FROM (
    SELECT raw, id, COUNT(*) AS n
    FROM (SELECT raw, {_tokens('raw')} AS tok FROM obs WHERE alias_key NOT IN (SELECT alias_key FROM direct)) s
         JOIN (SELECT id, {_tokens('name')} AS tok FROM {names}) d USING (tok)
    WHERE tok <> '' GROUP BY ALL HAVING COUNT(*) >= {least})
  GROUP BY raw)"""


def _map(ctes: str, direct: str, late: str, out: str) -> str:
    return f"""WITH {ctes}
SELECT obs.raw, obs.alias_key, COALESCE(direct.id, late.id) AS {out},
       CASE WHEN direct.id IS NOT NULL THEN '{direct}' WHEN late.id IS NOT NULL THEN '{late}' ELSE 'unmapped' END AS method,
       CASE WHEN direct.id IS NOT NULL THEN direct.n_ids WHEN late.id IS NOT NULL THEN 1 ELSE 0 END AS n_ids
FROM obs LEFT JOIN direct USING (alias_key) LEFT JOIN late ON late.raw = obs.raw"""


MASTER_ORACLE: dict[str, str] = {}

MASTER_ORACLE["property_dim"] = f"WITH {STAR_CTES['dim_property'][1]} SELECT * FROM dim_property"

MASTER_ORACLE["property_map"] = _map(f"""{STAR_CTES["dim_property"][1]}, {_observed("property")},
seeds AS (SELECT property_id AS id, if(business_type = 'Hotel', 0, 1) AS priority, {sql_norm_key('alias')} AS alias_key
  FROM (SELECT *, unnest([property_name, replace(property_name, ' ', '-'), string_split(property_name, ' ')[-1],
                          city, 'MG ' || city, region, 'MG ' || region]) AS alias FROM dim_property)),
direct AS (SELECT alias_key, arg_min(id, (priority, id)) AS id, COUNT(DISTINCT id) AS n_ids FROM seeds WHERE alias_key <> '' GROUP BY 1),
late AS (SELECT raw, MIN(property_id) AS id FROM obs JOIN dim_property
           ON contains(replace(alias_key, ' ', ''), replace({sql_norm_key('city')}, ' ', '')) GROUP BY raw)""",
                                     "seed", "contains", "property_id")

MASTER_ORACLE["product_map"] = _map(f"""{_observed("product")},
direct AS (SELECT {sql_norm_key('p_name')} AS alias_key, MIN(p_partkey) AS id, COUNT(DISTINCT p_partkey) AS n_ids FROM part GROUP BY 1),
names AS (SELECT p_name AS name, MIN(p_partkey) AS id FROM part GROUP BY 1),{_by_tokens("names", PRODUCT_TOKENS)}""",
                                    "exact", "tokens", "product_id")

_CATEGORY_ROWS = ", ".join(f"('C{i:03d}', '{n}')" for i, n in enumerate(CATEGORY_NAMES, start=1))
MASTER_ORACLE["category_map"] = f"""WITH {_observed("category")}, dim(id, name) AS (VALUES {_CATEGORY_ROWS})
SELECT raw, alias_key, id AS category_id, 'exact' AS method, 1::BIGINT AS n_ids FROM obs JOIN dim ON alias_key = {sql_norm_key('name')}"""

MASTER_ORACLE["account_map"] = _map(f"""{STAR_CTES["dim_account"][1]}, {_observed("account")},
names AS (SELECT account_id AS id, account_name AS name FROM dim_account),
direct AS (SELECT {sql_norm_key('name')} AS alias_key, MIN(id) AS id, COUNT(DISTINCT id) AS n_ids FROM names GROUP BY 1),{_by_tokens("names", ACCOUNT_TOKENS)}""",
                                    "exact", "tokens", "account_id")

MASTER_ORACLE["map_coverage"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS map_name, COUNT(*) AS observed, COUNT(*) FILTER (method <> 'unmapped') AS mapped,
       COUNT(*) FILTER (method = 'unmapped') AS unmapped, COUNT(*) FILTER (n_ids > 1) AS collisions,
       COALESCE(array_to_string(list_slice(list_sort(list(raw) FILTER (method = 'unmapped')), 1, 8), ' | '), '') AS unmapped_sample
FROM ({MASTER_ORACLE[name + "_map"]})""" for name in ("property", "product", "category", "account"))
