"""Queries for cleaning and validation."""

from pyspark.sql import functions as F

from ..operators.cleaning import (
    add_constant,
    convert_types,
    fill_nulls,
    filter_rows,
    flag_outliers,
    project,
    remove_duplicates,
    remove_nulls,
    remove_outliers,
    rename_columns,
    standardize_text,
)
from ..operators.validation import format_rules, split_valid, validate
from . import planted as p
from .registry import query, table


@query(
    "remove_nulls_any",
    f"SELECT * FROM {p.ORDERS_WITH_NULLS} "
    "WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL",
)
def remove_nulls_any(spark, sf_dir):
    return remove_nulls(
        p.orders_with_nulls(spark, sf_dir), ["o_totalprice", "o_orderpriority"], "any"
    )


@query(
    "remove_nulls_all",
    f"SELECT * FROM {p.ORDERS_WITH_NULLS} "
    "WHERE o_totalprice IS NOT NULL OR o_orderpriority IS NOT NULL",
)
def remove_nulls_all(spark, sf_dir):
    return remove_nulls(
        p.orders_with_nulls(spark, sf_dir), ["o_totalprice", "o_orderpriority"], "all"
    )


@query(
    "fill_nulls_map",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus,
        coalesce(o_totalprice, -1.0) AS o_totalprice,
        coalesce(o_orderpriority, 'unknown') AS o_orderpriority
    FROM {p.ORDERS_WITH_NULLS}""",
)
def fill_nulls_map(spark, sf_dir):
    return fill_nulls(
        p.orders_with_nulls(spark, sf_dir),
        {"o_totalprice": -1.0, "o_orderpriority": "unknown"},
    )


@query(
    "fill_nulls_default",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus,
        coalesce(o_totalprice, 0.0) AS o_totalprice, o_orderpriority
    FROM {p.ORDERS_WITH_NULLS}""",
)
def fill_nulls_default(spark, sf_dir):
    return fill_nulls(p.orders_with_nulls(spark, sf_dir))


@query(
    "convert_types",
    """
    SELECT o_orderkey,
           TRY_CAST(o_orderkey::VARCHAR || CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE '' END
                    AS BIGINT) AS whole,
           o_custkey::INTEGER AS cut,
           TRY_CAST(o_totalprice::VARCHAR AS DOUBLE) AS price,
           CASE WHEN o_orderkey % 6 = 0 THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
           o_custkey::VARCHAR AS text
    FROM orders
    """,
)
def convert_types_query(spark, sf_dir):
    key = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(key, F.when(key % 4 == 0, "x").otherwise("")).alias("whole"),
        F.concat("o_custkey", F.lit(".75")).alias("cut"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(key % 6 == 0, "no date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("day"),
        F.col("o_custkey").alias("text"),
    )
    converted = convert_types(
        raw,
        {
            "whole": "bigint", "cut": "int", "price": "double", "day": "date",
            "text": "string", "not_there": "int",
        },
    )
    return converted.withColumn("day", F.col("day").cast("string"))


@query(
    "standardize_text",
    f"""SELECT p_partkey,
        regexp_replace(lower(trim(name)), '[^a-zA-Z0-9\\s]', '', 'g') AS name,
        regexp_replace(lower(trim(kind)), '[^a-zA-Z0-9\\s]', '', 'g') AS kind
    FROM {p.PARTS_WITH_DIRT}""",
)
def standardize_text_query(spark, sf_dir):
    return standardize_text(
        p.parts_with_dirt(spark, sf_dir),
        ["name", "kind"],
        ["remove_special", "lower", "trim"],
    )


@query(
    "standardize_text_upper",
    f"SELECT p_partkey, name, upper(trim(kind)) AS kind FROM {p.PARTS_WITH_DIRT}",
)
def standardize_text_upper(spark, sf_dir):
    return standardize_text(p.parts_with_dirt(spark, sf_dir), ["kind"], ["upper", "trim"])


@query(
    "standardize_documents",
    r"""
    SELECT doc_id, length(t)::INTEGER AS length, md5(t) AS digest
    FROM (SELECT doc_id,
                 regexp_replace(lower(trim(text)), '[^a-zA-Z0-9\s\x0B]', '', 'g') AS t
          FROM documents)
    """,
)
def standardize_documents(spark, sf_dir):
    clean = standardize_text(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        ["text"],
        ["trim", "lower", "remove_special"],
    )
    return clean.select(
        "doc_id", F.length("text").alias("length"), F.md5(F.col("text")).alias("digest")
    )


_FENCES = f"""
    WITH t AS {p.LINES_WITH_OUTLIERS},
    q AS (SELECT quantile_disc(price, 0.25) AS p1, quantile_disc(price, 0.75) AS p3,
                 quantile_disc(l_quantity, 0.25) AS q1, quantile_disc(l_quantity, 0.75) AS q3
          FROM t),
    f AS (SELECT t.*,
                 price >= p1 - 1.5 * (p3 - p1) AND price <= p3 + 1.5 * (p3 - p1) AS price_in,
                 l_quantity >= q1 - 1.5 * (q3 - q1)
                     AND l_quantity <= q3 + 1.5 * (q3 - q1) AS quantity_in
          FROM t, q)
"""


@query(
    "remove_outliers",
    _FENCES
    + """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(price, 2) AS price
         FROM f WHERE price_in AND quantity_in""",
)
def remove_outliers_query(spark, sf_dir):
    kept = remove_outliers(
        p.lines_with_outliers(spark, sf_dir), ["price", "l_quantity"], exact=True
    )
    return kept.withColumn("price", F.round("price", 2))


@query(
    "flag_outliers",
    _FENCES
    + """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(price, 2) AS price,
                NOT price_in AS is_outlier_price
         FROM f""",
)
def flag_outliers_query(spark, sf_dir):
    flagged = flag_outliers(p.lines_with_outliers(spark, sf_dir), ["price"], exact=True)
    return flagged.withColumn("price", F.round("price", 2))


@query("remove_outliers_approximate")
def remove_outliers_approximate(spark, sf_dir):
    return remove_outliers(p.lines_with_outliers(spark, sf_dir), ["price", "l_quantity"])


@query(
    "filter_expr",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_quantity > 25 AND l_discount BETWEEN 0.05 AND 0.07""",
)
def filter_expr(spark, sf_dir):
    lines = filter_rows(
        table(spark, sf_dir, "lineitem"),
        "l_quantity > 25 AND l_discount BETWEEN 0.05 AND 0.07",
    )
    return project(
        lines, ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount"]
    )


@query(
    "project_rename",
    """SELECT l_orderkey AS order_id, l_quantity AS quantity, l_returnflag AS flag,
              'lineitem' AS origin
       FROM lineitem""",
)
def project_rename(spark, sf_dir):
    chosen = project(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity", "l_returnflag"]
    )
    named = rename_columns(
        chosen, {"l_orderkey": "order_id", "l_quantity": "quantity", "l_returnflag": "flag"}
    )
    return add_constant(named, "origin", "lineitem")


_RULES = {
    "price_positive": "o_totalprice > 100000",
    "priority_known": "o_orderpriority LIKE '%-%' AND o_orderpriority <> '5-LOW'",
    "closed": "o_orderstatus IN ('F', 'O')",
}


@query(
    "validate_rules",
    f"""SELECT *, is_price_positive AND is_priority_known AND is_closed AS is_valid_record
    FROM (SELECT *, o_totalprice > 100000 AS is_price_positive,
                 o_orderpriority LIKE '%-%' AND o_orderpriority <> '5-LOW' AS is_priority_known,
                 o_orderstatus IN ('F', 'O') AS is_closed
          FROM {p.ORDERS_WITH_NULLS})""",
)
def validate_rules(spark, sf_dir):
    return validate(p.orders_with_nulls(spark, sf_dir), _RULES)


_SPLIT = f"""SELECT *, coalesce(o_totalprice > 100000, false) AS is_price_positive,
        coalesce(o_orderpriority LIKE '%-%' AND o_orderpriority <> '5-LOW', false)
            AS is_priority_known,
        coalesce(o_orderstatus IN ('F', 'O'), false) AS is_closed
    FROM {p.ORDERS_WITH_NULLS}"""


@query(
    "split_rejected",
    f"""SELECT *, false AS is_valid_record FROM ({_SPLIT})
        WHERE NOT (is_price_positive AND is_priority_known AND is_closed)""",
)
def split_rejected(spark, sf_dir):
    return split_valid(p.orders_with_nulls(spark, sf_dir), _RULES)[1]


@query(
    "split_accepted",
    f"""SELECT *, true AS is_valid_record FROM ({_SPLIT})
        WHERE is_price_positive AND is_priority_known AND is_closed""",
)
def split_accepted(spark, sf_dir):
    return split_valid(p.orders_with_nulls(spark, sf_dir), _RULES)[0]


@query(
    "validate_formats",
    r"""
    SELECT *, is_email_email AND is_phone_phone AND is_day_iso_date AS is_valid_record
    FROM (SELECT *,
            regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$')
                AS is_email_email,
            regexp_matches(phone, '^\+?[0-9][0-9 ().x-]{5,}[0-9]$') AS is_phone_phone,
            regexp_matches(day, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AS is_day_iso_date
          FROM (SELECT c_custkey,
                  lower(c_mktsegment) || c_custkey
                      || CASE WHEN c_custkey % 10 = 0 THEN '.example.com'
                              WHEN c_custkey % 10 = 1 THEN '@example'
                              ELSE '@mail.example.com' END AS email,
                  CASE WHEN c_custkey % 9 = 0 THEN 'call me' ELSE '+1 (555) 010-' || c_custkey END
                      AS phone,
                  CASE WHEN c_custkey % 8 = 0 THEN '2024/01/01' ELSE '2024-01-01' END AS day
                FROM customer))
    """,
)
def validate_formats(spark, sf_dir):
    key = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(
            F.lower("c_mktsegment"),
            key,
            F.when(key % 10 == 0, ".example.com")
            .when(key % 10 == 1, "@example")
            .otherwise("@mail.example.com"),
        ).alias("email"),
        F.when(key % 9 == 0, "call me")
        .otherwise(F.concat(F.lit("+1 (555) 010-"), key))
        .alias("phone"),
        F.when(key % 8 == 0, "2024/01/01").otherwise("2024-01-01").alias("day"),
    )
    return validate(
        people, format_rules({"email": "email", "phone": "phone", "day": "iso_date"})
    )


@query(
    "validate_urls",
    r"""SELECT page_id, url, regexp_matches(url, '^https?://[^\s/]+(/\S*)?$') AS is_url_url,
               regexp_matches(url, '^https?://[^\s/]+(/\S*)?$') AS is_valid_record
        FROM pages""",
)
def validate_urls(spark, sf_dir):
    return validate(
        table(spark, sf_dir, "pages").select("page_id", "url"), format_rules({"url": "url"})
    )


@query("dedup_all", f"SELECT DISTINCT * FROM {p.ORDERS_WITH_COPIES}")
def dedup_all(spark, sf_dir):
    return remove_duplicates(p.orders_with_copies(spark, sf_dir))


@query("dedup_key", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def dedup_key(spark, sf_dir):
    # Any row of a key may survive, so only the key is compared.
    return remove_duplicates(
        p.orders_with_copies(spark, sf_dir), ["o_custkey", "o_orderstatus"]
    ).select("o_custkey", "o_orderstatus")


@query(
    "dedup_key_latest",
    f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM {p.ORDERS_WITH_COPIES}) WHERE rn = 1""",
)
def dedup_key_latest(spark, sf_dir):
    return remove_duplicates(
        p.orders_with_copies(spark, sf_dir),
        ["o_custkey"],
        order_by=[("o_totalprice", "desc"), "o_orderkey"],
    )
