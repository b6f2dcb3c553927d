"""Card transactions derived from the star-schema test tables.

Only the parent tables that own a wanted column are joined: every foreign key of the test
tables finds exactly one parent row, so a join whose columns are not wanted neither drops
nor repeats transactions. Join strategies are left to the size checks of the optimizer.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import require_utc

_SLOT = "(l.l_partkey * 7 + l.l_suppkey * 13 + l.l_linenumber) % 24"

# One SQL expression per transaction column, valid in Spark and in DuckDB.
CUSTOMER_COLUMNS = {
    "ssn": "CONCAT('900-', LPAD(CAST({k} % 10000 AS STRING), 4, '0'))",
    "cc_num": "4000000000000000 + {k}",
    "first": "CONCAT('Given', CAST({k} % 97 AS STRING))",
    "last": "c.c_name",
    "gender": "CASE WHEN {k} % 2 = 0 THEN 'F' ELSE 'M' END",
    "street": "CONCAT(CAST({k} % 999 AS STRING), ' Main St')",
    "city": "n.n_name",
    "state": "n.n_name",
    "zip": "CAST(10000 + {k} % 89999 AS INT)",
    "lat": "25.0e0 + ({k} * 7919 % 2400) / 100.0e0",
    "long": "-124.0e0 + ({k} * 104729 % 5700) / 100.0e0",
    "city_pop": "CAST(100 + {k} * 977 % 1000000 AS INT)",
    "job": "c.c_mktsegment",
    "dob": "CAST(DATE '1930-01-01' + CAST({k} * 37 % 20000 AS INT) AS STRING)",
    "acct_num": "700000000000 + {k}",
    "profile": "'adults'",
}
TRANSACTION_COLUMNS = {
    "row_id": "l.l_orderkey * 8 + l.l_linenumber",
    **{name: sql.format(k="o.o_custkey") for name, sql in CUSTOMER_COLUMNS.items()},
    "trans_num": "CONCAT(CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING))",
    "trans_date": "CAST(CAST(l.l_shipdate AS DATE) AS STRING)",
    "trans_time": f"CONCAT(LPAD(CAST({_SLOT} AS STRING), 2, '0'), ':',"
    " LPAD(CAST(l.l_partkey % 60 AS STRING), 2, '0'), ':',"
    " LPAD(CAST(l.l_suppkey % 60 AS STRING), 2, '0'))",
    "unix_time": "1000000000 + l.l_partkey",
    "category": "p.p_type",
    "amt": "l.l_extendedprice / 100.0e0",
    "is_fraud": "CASE WHEN l.l_returnflag = 'R' AND l.l_discount >= 0.08e0"
    f" AND {_SLOT} < 6 THEN 1 ELSE 0 END",
    "merchant": "s.s_name",
    "merch_lat": "25.0e0 + (o.o_custkey * 7919 % 2400) / 100.0e0"
    " + (l.l_partkey * 31 % 200 - 100) / 100.0e0",
    "merch_long": "-124.0e0 + (o.o_custkey * 104729 % 5700) / 100.0e0"
    " + (l.l_suppkey * 17 % 200 - 100) / 100.0e0",
}
# Lineitem goes through as few shuffles as there are keys, and narrow: orders get their customer first.
_PARENTS = {
    "p": "JOIN {part} p ON l.l_partkey = p.p_partkey",
    "s": "JOIN {supplier} s ON l.l_suppkey = s.s_suppkey",
}
_OWNERS = {
    "o": "{orders} o",
    "c": "JOIN {customer} c ON o.o_custkey = c.c_custkey",
    "n": "JOIN {nation} n ON c.c_nationkey = n.n_nationkey",
}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_NEEDS = {"o": "o", "c": "oc", "n": "ocn", "p": "p", "s": "s"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _dealt(df: DataFrame) -> DataFrame:
    """The test tables are single files of one row group, which one task would read and work on."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def transactions(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Bronze transactions with the given columns (all 27 when none is given)."""
    require_utc(spark)
    wanted = columns or tuple(TRANSACTION_COLUMNS)
    fields = [f"{TRANSACTION_COLUMNS[name]} AS `{name}`" for name in wanted]
    used = set("".join(_NEEDS.get(a, "") for a in re.findall(r"\b([a-z])\.", " ".join(fields))))
    joins = [sql for alias, sql in _PARENTS.items() if alias in used]
    owners = [sql for alias, sql in _OWNERS.items() if alias in used]
    if owners:
        joins.append(f"JOIN ({' '.join(owners)}) ON l.l_orderkey = o.o_orderkey")
    text = f"SELECT {', '.join(fields)} FROM {{lineitem}} l {' '.join(joins)}"
    names = set(re.findall(r"\{(\w+)\}", text))
    frames = {name: table(spark, folder, name) for name in names}
    frames["lineitem"] = _dealt(frames["lineitem"])
    return spark.sql(text, **frames)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze customers, 16 columns."""
    fields = [f"{sql.format(k='c.c_custkey')} AS `{n}`" for n, sql in CUSTOMER_COLUMNS.items()]
    return spark.sql(
        f"SELECT {', '.join(fields)} FROM {{customer}} c"
        " JOIN {nation} n ON c.c_nationkey = n.n_nationkey",
        customer=table(spark, folder, "customer"),
        nation=table(spark, folder, "nation"),
    )
