"""Raw-shaped feeds from general star-schema tables, for checks and benchmarks.

The expressions are SQL that Spark and other ANSI engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FDA_FROM = "orders JOIN customer ON o_custkey = c_custkey"
FSIS_FROM = "part"

FDA_FIELDS = {
    "recall_number": """
        CASE WHEN o_orderkey % 101 = 0 THEN NULL
             WHEN o_orderkey % 10 = 9 THEN 'F-' || CAST(o_orderkey - 1 AS STRING)
             ELSE 'F-' || CAST(o_orderkey AS STRING) END""",
    "classification": """
        CASE o_orderpriority
             WHEN '1-URGENT' THEN 'Class I'
             WHEN '2-HIGH' THEN 'Class II'
             WHEN '3-MEDIUM' THEN 'Class III'
             WHEN '4-NOT SPECIFIED' THEN 'Not Yet Classified'
             ELSE 'Class II' END""",
    "reason_for_recall": """
        CASE o_orderkey % 23
             WHEN 0 THEN 'Product may be contaminated with Salmonella.'
             WHEN 1 THEN 'Potential LISTERIA contamination'
             WHEN 2 THEN 'l.  monocytogenes found'
             WHEN 3 THEN 'possible E. coli O157:H7'
             WHEN 4 THEN 'Escherichia found'
             WHEN 5 THEN 'may help the colic'
             WHEN 6 THEN 'Undeclared milk'
             WHEN 7 THEN 'contains  milk'
             WHEN 8 THEN 'peanut undeclared'
             WHEN 9 THEN 'undeclared soy lecithin'
             WHEN 10 THEN 'undeclared veggie mix'
             WHEN 11 THEN 'labelled gluten free'
             WHEN 12 THEN 'undeclared cashew'
             WHEN 13 THEN 'undeclared tree nuts'
             WHEN 14 THEN 'allergen undeclared'
             WHEN 15 THEN 'foreign matter'
             WHEN 16 THEN 'packed in glass jars'
             WHEN 17 THEN 'metal shaving fragment'
             WHEN 18 THEN 'Misbranded'
             WHEN 19 THEN 'Undeclared allergen: milk; also Salmonella; wrong label'
             WHEN 20 THEN 'undeclared' || chr(10) || 'egg'
             WHEN 21 THEN NULL
             ELSE '  ' END""",
    "recall_initiation_date": """
        CASE WHEN o_orderkey % 97 = 0 THEN '20040230'
             WHEN o_orderkey % 89 = 0 THEN ''
             ELSE replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') END""",
    "report_date": """
        replace(CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT)
                     AS STRING), '-', '')""",
    "recalling_firm": "c_name",
    "state": """
        CASE c_nationkey % 12
             WHEN 0 THEN 'California'
             WHEN 1 THEN ' texas '
             WHEN 2 THEN 'NY'
             WHEN 3 THEN 'ny'
             WHEN 4 THEN ' wa '
             WHEN 5 THEN 'District of Columbia'
             WHEN 6 THEN 'Puerto Rico'
             WHEN 7 THEN 'Ontario'
             WHEN 8 THEN ''
             WHEN 9 THEN NULL
             WHEN 10 THEN 'NEW HAMPSHIRE'
             ELSE '  ' END""",
    "city": "'City ' || CAST(c_nationkey AS STRING)",
    "product_description": "c_mktsegment || ' product'",
    "status": """
        CASE o_orderstatus WHEN 'O' THEN 'Ongoing'
                           WHEN 'F' THEN 'Completed'
                           ELSE 'Terminated' END""",
    "voluntary_mandated": "'Voluntary: Firm initiated'",
    "distribution_pattern": "'Nationwide'",
    "product_quantity": "CAST(o_orderkey % 500 AS STRING) || ' cases'",
}

FSIS_FIELDS = {
    "field_title": "p_name || ' recall'",
    "field_recall_classification": """
        CASE p_size % 4 WHEN 0 THEN 'Class I'
                        WHEN 1 THEN 'Class II'
                        WHEN 2 THEN 'Class III'
                        ELSE 'Public Health Alert' END""",
    "field_recall_reason": """
        CASE p_partkey % 6
             WHEN 0 THEN 'Product Contamination - Listeria'
             WHEN 1 THEN 'Unreported Allergens'
             WHEN 2 THEN 'Misbranding, Undeclared Allergen'
             WHEN 3 THEN 'Foreign Material'
             WHEN 4 THEN 'Processing Defect'
             ELSE NULL END""",
    "field_recall_date": """
        CAST(DATE '2005-01-01' + CAST((p_partkey * 7) % 7000 AS INT) AS STRING)""",
    "field_establishment": """
        CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_brand || ' Foods' END""",
    "field_states": """
        CASE p_partkey % 7
             WHEN 0 THEN 'Texas, Ohio'
             WHEN 1 THEN 'Nationwide'
             WHEN 2 THEN ' Iowa ,Utah'
             WHEN 3 THEN 'CA'
             WHEN 4 THEN ''
             WHEN 5 THEN NULL
             ELSE ',Maine' END""",
    "field_closed_date": """
        CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '2020-01-01' END""",
}


def _select(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in fields.items()])


def fda_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return _select(joined, FDA_FIELDS)


def fsis_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark.read.parquet(f"{sf_dir}/part.parquet"), FSIS_FIELDS)
