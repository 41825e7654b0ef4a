"""Write-side request tables derived from the driver tables (FIXTURES.md §6).

The reference applies its data rules one HTTP request at a time. Here each rule
takes a whole table of requests, so the rules need request tables; they are
derived from the driver tables by their natural attributes:

* client inserts  — every customer; by segment a bad, a new, a shared, a NULL or a taken e-mail
* client deletes  — negative balance, or without purchases; unknown ids
* client patches  — two per customer by segment: good ones, bad values, bad JSON; unknown ids
* seller inserts  — every supplier, some without last name or with too long a company name
* seller deletes  — negative or high balance; unknown ids
* seller patches  — by balance: a new company name, NULL, a bad e-mail, a JSON list
* product inserts — every part; seller ids range past the last supplier, PROMO parts get a
  negative price, small ones quantity 0, large ones none
* product patches — two per part by type: good ones, bad values, bad JSON; unknown ids
* product deletes — parts of type ECONOMY; unknown ids
* purchase requests — every line item, client 0 as NULL, quantity 50 as 0; purchase deletes — returned items (flag R)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.fixtures import CLIENT_ORPHANS, EMAIL_DOMAIN
from tillroll.sources.tables import read_table

# Fixed values of the request definitions.
RICH_SELLER_BALANCE = 5000
SELLER_SUFFIX = " Group"
UNKNOWN_SELLER_SPAN = 3
NEGATIVE_PRICE_TYPE = "PROMO"
NEGATIVE_PRICE_SHIFT = 1000
DELETED_PRODUCT_TYPE = "ECONOMY"
RETURNED_FLAG = "R"
NOT_JSON = "not json"


def _first(c):
    return F.split_part(c, F.lit("#"), F.lit(1))


def _last(c):
    return F.split_part(c, F.lit("#"), F.lit(2))


def _unknown(key: str):
    """An id that no table has."""
    return (-1 - F.col(key)).cast("bigint")


def _patch(field: str, value) -> F.Column:
    return F.to_json(F.create_map(F.lit(field), value))


def client_inserts(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    base, seg = F.lower(F.regexp_replace("c_name", "#", ".")), F.col("c_mktsegment")
    email = (F.when(seg == "FURNITURE", base).when(seg == "HOUSEHOLD", F.concat(base, F.lit(".new" + EMAIL_DOMAIN)))
             .when(seg == "BUILDING", _shared_email()).when(seg == "MACHINERY", F.lit(None))
             .otherwise(F.concat(base, F.lit(EMAIL_DOMAIN))))
    return c.select(F.col("c_custkey").cast("bigint").alias("request_id"), _first("c_name").alias("first_name"),
                    _last("c_name").alias("last_name"), email.alias("email"))


def _shared_email():
    return F.concat(F.lit("shared"), F.floor(F.col("c_custkey") / 10).cast("string"), F.lit(EMAIL_DOMAIN))


def client_deletes(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    key = F.col("c_custkey").cast("bigint").alias("client_id")
    own = c.where((F.col("c_acctbal") < 0) | (F.col("c_custkey") % CLIENT_ORPHANS == 0)).select(key)
    return own.unionByName(c.where(F.col("c_acctbal") < -500).select(_unknown("c_custkey").alias("client_id")))


def client_patches(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    seg = F.col("c_mktsegment")
    first = (F.when(seg == "HOUSEHOLD", _patch("first_name", F.upper(_first("c_name"))))
             .when(seg == "MACHINERY", F.lit('{"email":null}')).when(seg == "BUILDING", _patch("last_name", F.lit("Renamed")))
             .when(seg == "FURNITURE", _patch("email", _shared_email())).otherwise(F.lit("{}")))
    second = (F.when(seg == "HOUSEHOLD", _patch("last_name", F.lit("Second")))
              .when(seg == "MACHINERY", F.lit('{"first_name":null}')).when(seg == "BUILDING", F.lit(NOT_JSON))
              .when(seg == "FURNITURE", _patch("email", F.lit("nobody"))).otherwise(_patch("last_name", F.lit("x" * 101))))
    return _numbered(c, "c_custkey", "client_id", [first, second]).unionByName(
        c.where(F.col("c_acctbal") < 0).select(_unknown("c_custkey").alias("client_id"),
                                               F.lit('{"first_name":"Nobody"}').alias("patch"),
                                               (F.col("c_custkey") * 10 + 2).cast("bigint").alias("seq")))


def _numbered(df: DataFrame, key: str, name: str, patches: list) -> DataFrame:
    """Each row's patches in order (``seq`` = key * 10 + position)."""
    each = F.posexplode(F.array(*patches)).alias("i", "patch")
    return df.select(key, each).select(F.col(key).cast("bigint").alias(name), "patch",
                                       (F.col(key) * 10 + F.col("i")).cast("bigint").alias("seq"))


def seller_inserts(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("request_id"), _first("s_name").alias("first_name"),
        F.when(F.col("s_acctbal") >= 1000, _last("s_name")).alias("last_name"),
        F.when(F.col("s_acctbal") > 9000, F.repeat("s_name", 20)).otherwise(F.col("s_name")).alias("company_name"),
        F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit(".new"), F.lit(EMAIL_DOMAIN)).alias("email"),
    )


def seller_deletes(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    own = s.where((F.col("s_acctbal") < 0) | (F.col("s_acctbal") > 8000)).select(F.col("s_suppkey").cast("bigint").alias("seller_id"))
    return own.unionByName(s.where(F.col("s_acctbal") > 9000).select(_unknown("s_suppkey").alias("seller_id")))


def seller_patches(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    balance = F.col("s_acctbal")
    patch = (F.when(balance > RICH_SELLER_BALANCE, _patch("company_name", F.concat("s_name", F.lit(SELLER_SUFFIX))))
             .when(balance < 1000, F.lit('{"company_name":null}')).when(balance < 2000, F.lit('{"email":"no address"}'))
             .when(balance < 3000, F.lit('["list"]')).otherwise(F.lit("{}")))
    return s.select(F.col("s_suppkey").cast("bigint").alias("seller_id"), patch.alias("patch"),
                    F.col("s_suppkey").cast("bigint").alias("seq"))


def product_inserts(spark: SparkSession, d: str) -> DataFrame:
    span = read_table(spark, d, "supplier").select(F.count(F.lit(1)) + UNKNOWN_SELLER_SPAN).scalar()
    p = read_table(spark, d, "part")
    price = F.col("p_retailprice").cast("decimal(12,2)") - F.when(
        F.col("p_type") == NEGATIVE_PRICE_TYPE, F.lit(NEGATIVE_PRICE_SHIFT)).otherwise(F.lit(0))
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("request_id"),
        (F.col("p_partkey") % span).cast("bigint").alias("seller_id"),
        F.col("p_name").alias("name"),
        price.cast("decimal(12,2)").alias("price"),
        F.when(size < 4, F.lit(0)).when(size <= 40, size).cast("bigint").alias("quantity"),
    )


def product_patches(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    t = F.col("p_type")
    first = (F.when(t == "STANDARD", _patch("price", (F.col("p_retailprice").cast("decimal(12,2)") + 1).cast("string")))
             .when(t == "SMALL", _patch("name", F.concat("p_name", F.lit(" v2"))))
             .when(t == "LARGE", _patch("quantity", (F.col("p_size") + 10).cast("string"))).otherwise(F.lit("{}")))
    second = (F.when(t == "STANDARD", F.lit('{"quantity":"-5"}')).when(t == "SMALL", F.lit('{"quantity":7}'))
              .when(t == "LARGE", F.lit('{"quantity":"abc"}')).when(t == "PROMO", F.lit('{"price":"0.00"}'))
              .when(t == "MEDIUM", F.lit('{"quantity":null}')).otherwise(F.lit(NOT_JSON)))
    return _numbered(p, "p_partkey", "product_id", [first, second]).unionByName(
        p.where(t == "PROMO").select(_unknown("p_partkey").alias("product_id"), F.lit('{"name":"nothing"}').alias("patch"),
                                     (F.col("p_partkey") * 10 + 2).cast("bigint").alias("seq")))


def product_deletes(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    own = p.where(F.col("p_type") == DELETED_PRODUCT_TYPE).select(F.col("p_partkey").cast("bigint").alias("product_id"))
    return own.unionByName(p.where(F.col("p_type") == NEGATIVE_PRICE_TYPE).select(_unknown("p_partkey").alias("product_id")))


def purchase_requests(spark: SparkSession, d: str) -> DataFrame:
    from tillroll.sources.fixtures import purchase_events

    e = purchase_events(spark, d)
    quantity = F.when(F.col("quantity") == 50, F.lit(0)).otherwise(F.col("quantity")).cast("bigint")
    return e.select(F.col("purchase_id").alias("request_id"), F.nullif(F.col("client_id"), F.lit(0)).alias("client_id"),
                    "product_id", quantity.alias("quantity"), F.col("purchased_at").alias("requested_at"))


def purchase_deletes(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").where(F.col("l_returnflag") == RETURNED_FLAG)
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("purchase_id")).distinct()
