"""Registered queries: one per inventory id, each (spark, sf_dir) -> DataFrame, with an
equivalent DuckDB SQL string where SQL can express the operator.

Doubles that come out of aggregations are rounded to 6 decimals on *both* sides, so
summation order (which differs between engines) cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --------------------------------------------------------------------------
# Subject views as SQL (same definitions as riskframe.plans.subjects)
# --------------------------------------------------------------------------
DOC_SUBJECT_SQL = """
doc_subject AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars,
         CAST(strlen(d.text) - strlen(replace(d.text, ' ', '')) AS BIGINT) AS n_spaces,
         CAST(strlen(d.text) - strlen(replace(d.text, chr(10), '')) AS BIGINT) AS n_newlines,
         CAST(l.toxic AS INTEGER) AS toxic, CAST(1 - l.quality AS INTEGER) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

ORDER_SUBJECT_SQL = """
order_subject AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         CASE WHEN substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '0' THEN NULL ELSE c.c_acctbal END AS c_acctbal,
         CASE WHEN substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '1' THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
         CAST(c.c_nationkey AS INTEGER) AS c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

LINE_SUBJECT_SQL = """
line_subject AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS line_key, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_linenumber, l.l_returnflag, l.l_linestatus,
         CASE WHEN substr(md5(CAST(l.l_orderkey AS VARCHAR)), 1, 1) = '2' THEN NULL ELSE o.o_orderpriority END AS o_orderpriority,
         o.o_totalprice, c.c_acctbal, c.c_mktsegment, p.p_size, p.p_retailprice, p.p_type,
         CAST(l.l_returnflag = 'R' AND l.l_linestatus = 'F' AS INTEGER) AS label
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views)
