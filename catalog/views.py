"""Tables the queries run on.

The given tables hold almost no defects, so some queries read views that add
them by fixed arithmetic on the key: every row of the given table is kept, some
cells are spoiled and some rows occur more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

CUSTOMER_RULES = {
    "c_acctbal": {"min": -999, "max": 10000},
    "c_nationkey": {"min": 0, "max": 20},
    "c_mktsegment": {"allowed": list(SEGMENTS)},
}
PART_RULES = {"p_size": {"min": 1, "max": 45}}
ORDER_RULES = {
    "o_totalprice": {"min": 1500, "max": 450000.5},
    "o_orderstatus": {"allowed": ["o", " F "]},
}
LINEITEM_RULES = {
    "l_quantity": {"min": 2, "max": 48},
    "l_discount": {"max": 0.09},
    "l_returnflag": {"allowed": ["A", "N"]},
}
EVENT_RULES = {"value": {"min": 0.5, "max": 100}, "event_type": {"allowed": ["view", "click", "purchase", "signup"]}}
TEXT_NUMBER_RULES = {
    "quantity": {"min": 3, "max": 47.5},
    "line": {"allowed": [1, 2, 3, 4, 5]},
    "price": {"max": 80000},
}
DOCUMENT_RULES = {"lang": {"allowed": ["en", "fr", "de"]}, "n_chars": {"min": 100}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_copies(df: DataFrame, key: str, *every: int) -> DataFrame:
    """Every row once as `copy` 0; rows whose key is a multiple of every[i - 1] again as copy i."""
    copies = "".join(f", if({key} % {n} = 0, {i}, NULL)" for i, n in enumerate(every, start=1))
    return df.selectExpr("*", f"{key} AS k", f"explode(array_compact(array(0{copies}))) AS copy")


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(table(spark, sf_dir, "customer"), "c_custkey", 67, 131).selectExpr(
        "k * 10 + copy AS row_id",
        "if(k % 401 = 0, NULL, k) AS c_custkey",
        "c_name",
        "c_nationkey",
        """CASE WHEN k % 17 = 0 THEN NULL
                WHEN k % 101 = 0 THEN -99999.0D
                WHEN copy = 2 THEN c_acctbal + 1.0D
                ELSE c_acctbal END AS c_acctbal""",
        """CASE WHEN k % 33 = 0 THEN NULL
                WHEN k % 211 = 0 THEN 'UNKNOWN'
                WHEN k % 50 = 0 THEN concat(c_mktsegment, '  ')
                WHEN k % 97 = 0 THEN lower(c_mktsegment)
                ELSE c_mktsegment END AS c_mktsegment""",
    )


def dirty_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS row_id",
        "p_partkey",
        "p_name",
        "p_brand",
        """CASE WHEN p_partkey % 400 = 0 THEN lower(p_type)
                WHEN p_partkey % 90 = 0 THEN concat(' ', p_type)
                ELSE p_type END AS p_type""",
        "if(p_partkey % 25 = 0, NULL, p_size) AS p_size",
        "p_retailprice",
    )


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day as the batch."""
    return table(spark, sf_dir, "events").selectExpr(
        "to_date(ts) AS batch_date",
        "if(event_id % 83 = 0, NULL, event_id) AS event_id",
        "user_id",
        """CASE WHEN event_id % 59 = 0 THEN NULL
                WHEN event_id % 41 = 0 THEN concat(event_type, ' ')
                WHEN event_id % 997 = 0 THEN upper(event_type)
                ELSE event_type END AS event_type""",
        """CASE WHEN event_id % 19 = 0 THEN NULL
                WHEN event_id % 53 = 0 THEN -value
                ELSE value END AS value""",
    )


def loan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an application of its customer, every 67th one twice.

    All cells come from given columns of orders, customer, nation and region; what
    is out of range, unlisted, missing or oddly written is so by their values.
    """
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = _with_copies(table(spark, sf_dir, "orders"), "o_orderkey", 67)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").selectExpr(
        "k * 10 + copy AS row_id",
        "if(c_nationkey = 7 AND o_orderstatus = 'F', NULL, o_custkey) AS customer_id",
        "if(o_orderpriority LIKE '4%', NULL, floor(c_acctbal / 90) + 0.0D) AS age",
        "if(c_mktsegment = 'BUILDING' AND o_orderstatus = 'P', NULL, c_acctbal * 12.0D) AS annual_income",
        "if(c_nationkey = 3, NULL, floor(o_totalprice / 450) + 0.0D) AS credit_score",
        "o_totalprice - 4000.0D AS loan_amount",
        "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS existing_loans",
        """CASE o_orderstatus WHEN 'P' THEN concat(r_name, ' ')
                WHEN 'F' THEN lower(r_name) ELSE r_name END AS region""",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Self-Employed' WHEN 'FURNITURE' THEN 'Retired'
                WHEN 'HOUSEHOLD' THEN 'Unemployed' WHEN 'MACHINERY' THEN concat('employed', chr(9))
                ELSE c_mktsegment END AS employment_status""",
        "concat(o_orderstatus, if(c_nationkey % 6 = 5, chr(160), '')) AS gender",
        "if(c_nationkey < 20, 'Married', initcap(n_name)) AS marital_status",
        """CASE substr(o_orderpriority, 1, 1)
                WHEN '1' THEN date_format(o_orderdate, 'dd-MMM-yyyy')
                WHEN '2' THEN date_format(o_orderdate, 'MM/dd/yyyy')
                WHEN '3' THEN date_format(o_orderdate, 'yyyy-MM-dd')
                WHEN '4' THEN date_format(o_orderdate, 'yyyyMMdd')
                ELSE date_format(o_orderdate, 'dd/MM/yyyy') END AS application_date""",
        "if(o_orderstatus = 'F', 1L, 0L) AS default_flag",
    )


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of orders as text; some with a day or month that no calendar has, some not at all."""
    return table(spark, sf_dir, "orders").selectExpr(
        """CASE o_orderstatus
                WHEN 'F' THEN concat(date_format(o_orderdate, 'yyyy-MM-'), lpad(CAST(o_custkey % 40 AS STRING), 2, '0'))
                WHEN 'P' THEN concat_ws('/', lpad(CAST(o_custkey % 35 AS STRING), 2, '0'),
                                        lpad(CAST(o_orderkey % 15 AS STRING), 2, '0'), date_format(o_orderdate, 'yyyy'))
                WHEN 'O' THEN if(o_totalprice < 250000, NULL, o_orderpriority) END AS written"""
    )


def text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with numbers as text, odd blanks around codes, and NaN among the prices."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "if(l_returnflag = 'N', concat(' ', CAST(l_quantity AS STRING)), CAST(l_quantity AS STRING)) AS quantity",
        "CAST(l_linenumber AS BIGINT) AS line",
        """CASE l_returnflag WHEN 'A' THEN concat(l_linestatus, chr(9))
                WHEN 'R' THEN concat(chr(160), l_linestatus) ELSE l_linestatus END AS code""",
        "if(l_discount > 0.085, double('NaN'), l_extendedprice) AS price",
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which cells of documents and their labels are present; many have no label."""
    from plumbline import presence

    documents = presence(table(spark, sf_dir, "documents"), keep=["doc_id"])
    labels = presence(table(spark, sf_dir, "labels"), keep=["doc_id"])
    return documents.join(labels, "doc_id", "left")
