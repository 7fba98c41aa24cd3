"""The driver tables read as publications.

An order is an article (its key the DOI, its priority the journal, its quantities the citations), a
supplier an author, a nation an affiliation; region > nation > supplier is the taxonomy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doi, tc)."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("doi")).agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("long").alias("tc"))


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(suppkey, author, affiliation, top)."""
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("author"), F.col("n_name").alias("affiliation"), F.col("r_name").alias("top")
    )


def authorships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doi, author, affiliation, top), distinct."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doi")).agg(F.collect_set("l_suppkey").alias("suppkeys"))
    return lines.select("doi", F.explode("suppkeys").alias("suppkey")).join(authors(spark, sf_dir), "suppkey").select("doi", "author", "affiliation", "top")


def facts(spark: SparkSession, sf_dir: str, category: str = "top") -> DataFrame:
    """One row per article, author and category.

    An article's lines are shuffled once, for its citations and its authors; the rows are then dealt by author.
    """
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doi"), F.col("o_orderpriority").alias("journal"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    articles = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doi")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("long").alias("tc"), F.collect_set("l_suppkey").alias("suppkeys")
    )
    return (
        articles.join(orders, "doi").select("doi", "tc", "journal", "month", F.explode("suppkeys").alias("suppkey")).join(authors(spark, sf_dir), "suppkey")
        .select(
            F.col(category).alias("category"), "doi", F.concat(F.lit("Article "), F.col("doi").cast("string")).alias("title"), "tc",
            "author", "affiliation", "journal", "month", F.col("doi").alias("ordinal"),
        )
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records.articles`` of ``works``, by one grouping of narrow rows.

    Lines go to their parts and, apart from that, to their suppliers with nothing but what an article takes from there. What comes back is
    dealt by article once, with the orders as further rows; names of nations and regions, a fixed few, are looked up after that. No sets or wide rows are shuffled.
    The session's number of partitions is given, as adaptive execution would otherwise join them to ones too large to be sorted in memory.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "doi").where("doi IS NOT NULL")
    of_parts = lines.select("doi", "l_partkey", "l_quantity", F.to_date("l_shipdate").alias("shipped")).join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    of_people = lines.select("doi", "l_suppkey").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doi"), F.col("o_orderpriority").alias("journal"), F.to_date("o_orderdate").alias("printed"), "o_orderstatus", F.lit(True).alias("ordered")
    )
    rows = of_parts.drop("l_partkey", "p_partkey").unionByName(of_people.drop("l_suppkey", "s_suppkey"), allowMissingColumns=True).unionByName(orders, allowMissingColumns=True)
    placed = (
        rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doi").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    person = F.struct(F.col("s_name").alias("author"), F.col("n_name").alias("affiliation"), F.col("r_name").alias("top"))
    whole = placed.groupBy("doi").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("long").alias("tc"), F.min("p_name").alias("abstract"), F.collect_set("p_type").alias("themes"), F.min("shipped").alias("shipped"),
        F.max("journal").alias("journal"), F.max("printed").alias("printed"), F.max("o_orderstatus").alias("status"), F.max("ordered").alias("ordered"),
        F.collect_set(F.when(F.col("r_regionkey").isNotNull(), person)).alias("people"),
    )
    name = F.col("doi").cast("string")
    return whole.where(F.col("ordered") & (F.size("people") > 0)).select(
        "doi", F.concat(F.lit("Article "), name).alias("title"), "tc", "journal", "abstract", F.concat(F.lit("https://license.example/"), "status").alias("license_url"),
        F.date_format("printed", "yyyy-MM-dd").alias("date_published_print"), F.date_format("shipped", "yyyy-MM-dd").alias("date_published_online"),
        F.concat(F.lit("https://doi.org/"), name, F.lit(".pdf")).alias("download_url"), "themes", "people",
        F.col("people")["top"].alias("top"), F.col("people")["affiliation"].alias("mid"), F.col("people")["author"].alias("low"),
    )


def works(spark: SparkSession, sf_dir: str, by_article: bool = False) -> DataFrame:
    """One row per article and author with all fields of a record; a part's type is a theme, region, nation and supplier are the levels.

    With ``by_article`` these are the people of ``articles``, each once, and rows stay dealt by article.
    """
    if by_article:
        each = articles(spark, sf_dir).drop("top", "mid", "low").withColumns({"themes": F.sort_array("themes"), "person": F.explode("people")}).select("*", "person.*").drop("person", "people")
    else:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
        lines = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        grouped = lines.groupBy(F.col("l_orderkey").alias("doi")).agg(
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("long").alias("tc"), F.min("p_name").alias("abstract"),
            F.sort_array(F.collect_set("p_type")).alias("themes"), F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("date_published_online"),
            F.collect_set("l_suppkey").alias("found"),
        )
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("doi"), F.col("o_orderpriority").alias("journal"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_published_print"),
            F.concat(F.lit("https://license.example/"), "o_orderstatus").alias("license_url"),
        )
        name = F.col("doi").cast("string")
        whole = grouped.join(orders, "doi").withColumns({"title": F.concat(F.lit("Article "), name), "download_url": F.concat(F.lit("https://doi.org/"), name, F.lit(".pdf"))})
        each = whole.withColumn("suppkey", F.explode("found")).join(authors(spark, sf_dir), "suppkey").drop("suppkey", "found")
    return each.withColumns({"mid": F.col("affiliation"), "low": F.col("author")})


#: The same in SQL, as common table expressions.
FACTS_SQL = """
cites AS (SELECT l_orderkey AS doi, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS BIGINT) AS tc FROM lineitem GROUP BY 1),
people AS (SELECT s_suppkey, s_name AS author, n_name AS affiliation, r_name AS top FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ships AS (SELECT doi, author, affiliation, top FROM (SELECT DISTINCT l_orderkey AS doi, l_suppkey FROM lineitem) l JOIN people ON l_suppkey = s_suppkey),
facts AS (SELECT top AS category, ships.doi, 'Article ' || CAST(ships.doi AS VARCHAR) AS title, tc, author, affiliation, o_orderpriority AS journal, strftime(o_orderdate, '%Y-%m') AS month
  FROM ships JOIN cites USING (doi) JOIN orders ON ships.doi = o_orderkey)
"""
#: ``works`` in SQL, after ``FACTS_SQL``.
WORKS_SQL = """
lines AS (SELECT * FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
articles AS (SELECT l_orderkey AS doi, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS BIGINT) AS tc, min(p_name) AS abstract, strftime(min(l_shipdate), '%Y-%m-%d') AS date_published_online FROM lines GROUP BY 1),
themes AS (SELECT DISTINCT l_orderkey AS doi, p_type AS theme FROM lines WHERE p_type IS NOT NULL),
works AS (SELECT a.*, o_orderpriority AS journal, strftime(o_orderdate, '%Y-%m-%d') AS date_published_print, 'https://license.example/' || o_orderstatus AS license_url,
  'Article ' || CAST(a.doi AS VARCHAR) AS title, 'https://doi.org/' || CAST(a.doi AS VARCHAR) || '.pdf' AS download_url, author, affiliation, top, affiliation AS mid, author AS low
  FROM articles a JOIN orders ON a.doi = o_orderkey JOIN ships ON a.doi = ships.doi)
"""
