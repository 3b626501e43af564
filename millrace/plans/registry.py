"""Named queries and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The sales table and its cleaning steps as SQL.
SALES_SQL = """sales as (
select l_orderkey*8+l_linenumber as order_id, cast(o_orderdate as date) as order_date,
  case when (l_orderkey*8+l_linenumber)%100=17 then null else n_name end as region,
  case when (l_orderkey*8+l_linenumber)%125=29 then null else p_type end as category,
  p_name as product_name, l_quantity as quantity, p_retailprice as unit_price,
  o_orderpriority as payment_method, cast(18+c_custkey%62 as int) as customer_age,
  case when c_custkey%2=0 then 'F' else 'M' end as customer_gender,
  case when (l_orderkey*8+l_linenumber)%200=41 then null
       when (l_orderkey*8+l_linenumber)%50=7 then round(l_quantity*p_retailprice*10,2)
       else round(l_quantity*p_retailprice,2) end as amount
from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey
  join nation on c_nationkey=n_nationkey join part on l_partkey=p_partkey)"""
PRESENT_SQL = SALES_SQL + """,
present as (select * from sales where region is not null and category is not null and amount is not null)"""
FENCE_SQL = PRESENT_SQL + """,
quartiles as (select quantile_cont(amount,0.25) as q1, quantile_cont(amount,0.75) as q3 from present),
fence as (select q1, q3, q3-q1 as iqr, q1-1.5*(q3-q1) as lower, q3+1.5*(q3-q1) as upper from quartiles)"""
CLEAN_SQL = FENCE_SQL + """,
cleaned as (select present.* from present, fence where amount between lower and upper)"""
LABELED_SQL = PRESENT_SQL + """,
labeled as (select *, cast(case when amount >
  (select cast(sum(cast(amount as decimal(18,2))) as double)/count(amount) from present)
  then 1 else 0 end as int) as high_value from present)"""

SUM_SQL = "cast(sum(cast(amount as decimal(18,2))) as double)"
AVG_SQL = "cast(sum(cast(amount as decimal(18,2))) as double)/count(amount)"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without an oracle only its rows can be checked."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
