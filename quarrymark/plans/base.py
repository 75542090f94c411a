"""Registry of queries, tables and SQL pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with DuckDB SQL for the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("long")


def count_n() -> Column:
    return F.count("*").alias("n")


# DuckDB pieces over pages
HOST = "regexp_extract(coalesce(url,''),'^[^:/?#]+://([^/?#]*)',1)"
TEXT = r"trim(regexp_replace(regexp_replace(regexp_replace(html,'<(script|style)[^>]*>.*?</(script|style)>','','gis'),'<[^>]+>',' ','g'),'\s+',' ','g'))"
STRIP = (
    r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,"""
    r"""'<script[^>]*>.*?</script>','','gis'),'<style[^>]*>.*?</style>','','gis'),'<svg[\s>].*?</svg>','','gis'),'<link[^>]*/?>','','gi'),"""
    r"""'\s+data-[a-zA-Z][a-zA-Z0-9_:-]*(?:="[^"]*")?','','g'),'\s+class="[^"]*"','','g'),'\s+style="[^"]*"','','g'),'\n\s*\n+',chr(10),'g')"""
)
STRIP = f"regexp_replace({STRIP},'^\\s+|\\s+$','','g')"
KINDS = ("LocalBusiness", "Product", "Article", "Event", "FAQPage", "Recipe", "Organization", "Service", "Person", "WebSite", "BreadcrumbList", "JobPosting", "Course", "SoftwareApplication", "HowTo")
KIND = "(['" + "','".join(KINDS) + "'])[(page_id % 15)::INT + 1]"


def with_kind(pages: DataFrame) -> DataFrame:
    """pages with a type of markup dealt by page_id."""
    return pages.withColumn("schema_type", F.element_at(F.array(*(F.lit(k) for k in KINDS)), (F.col("page_id") % 15 + 1).cast("int")))


#: JSON-LD of parts, with defects by key; the same text in both dialects.
PART_JSON = (
    """CASE WHEN p_partkey % 11 = 0 THEN concat('{"@context":"https://schema.org","@type":"Product","name":"', p_name) ELSE concat('{', """
    """CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '"@context":"https://schema.org",' END, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '"@type":"Product",' END, """
    """'"name":"', p_name, '","brand":"', p_brand, '"', CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat(',"sku":"', CAST(p_partkey AS VARCHAR(20)), """
    """'","offers":{"@type":"Offer","price":"', CAST(p_size AS VARCHAR(20)), '","availability":"', CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'https://schema.org/' END, 'InStock"}') END, '}') END"""
)


def parts_jsonld(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").selectExpr("p_partkey", f"{PART_JSON} AS jsonld")
