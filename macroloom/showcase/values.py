"""Scalar functions and projections."""

from pyspark.sql import functions as F

from macroloom.functions import dates, labels, numbers, text
from macroloom.operators import observations, profile
from macroloom.schema import CONTRACT_COLUMNS
from macroloom.showcase.registry import query

EXPONENT = {1: 0, 2: 6, 3: 9, 4: 3}
EXPONENT_SQL = "CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 6 WHEN 3 THEN 9 WHEN 4 THEN 3 END"


def exponent(line_number):
    chosen = F.lit(None).cast("int")
    for number, e in EXPONENT.items():
        chosen = F.when(line_number == number, e).otherwise(chosen)
    return chosen


@query("""
    SELECT l_orderkey, l_linenumber, l_linestatus AS "REF_AREA_CODE", l_returnflag AS "CONCEPT_CODE",
           CAST(year(l_shipdate) AS INTEGER) AS "TIME_PERIOD", l_extendedprice AS "OBS_VALUE"
    FROM lineitem
    WHERE l_linestatus = 'O' AND l_returnflag = 'R' AND year(l_shipdate) BETWEEN 1996 AND 1998
""")
def q_obs_filter(spark, table):
    df = table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_linestatus").alias("REF_AREA_CODE"),
        F.col("l_returnflag").alias("CONCEPT_CODE"),
        F.year("l_shipdate").alias("TIME_PERIOD"),
        F.col("l_extendedprice").alias("OBS_VALUE"),
    )
    return observations.observation_slice(df, "O", "R", (1996, 1998))


@query("""
    SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS "OBS_VALUE"
    FROM events WHERE event_type <> 'error' AND value IS NOT NULL
""")
def q_drop_empty(spark, table):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return observations.drop_empty(table("events").select("event_id", "user_id", value.alias("OBS_VALUE")))


@query("""
    SELECT l_returnflag AS "UNIT_CODE", 'C' || l_suppkey AS "CONCEPT_CODE", 'P' || l_partkey AS "REF_AREA_CODE",
           CAST(l_linenumber AS INTEGER) AS "REF_AREA_IMF_CODE", l_linestatus AS "FREQ_CODE",
           CAST(NULL AS INTEGER) AS "LASTACTUALDATE", CAST(1 AS BIGINT) AS "SCALE_CODE",
           CAST(NULL AS VARCHAR) AS "NOTES", CAST(year(l_shipdate) AS INTEGER) AS "TIME_PERIOD",
           l_extendedprice AS "OBS_VALUE", CAST(NULL AS VARCHAR) AS "UNIT_LABEL",
           CAST(NULL AS VARCHAR) AS "CONCEPT_LABEL", CAST(NULL AS VARCHAR) AS "REF_AREA_LABEL",
           CAST(NULL AS VARCHAR) AS "FREQ_LABEL", 'Units' AS "SCALE_LABEL",
           CAST(NULL AS TIMESTAMP) AS "COUNTRY_UPDATE_DATE"
    FROM lineitem
""")
def q_contract_select(spark, table):
    feed = table("lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("COUNTRY"),
        F.concat(F.lit("C"), "l_suppkey").alias("INDICATOR"),
        F.col("l_returnflag").alias("UNIT"),
        F.col("l_linestatus").alias("FREQUENCY"),
        F.lit(0).alias("SCALE"),
        F.year("l_shipdate").alias("TIME_PERIOD"),
        F.col("l_extendedprice").cast("string").alias("OBS_VALUE"),
        F.col("l_linenumber").alias("REF_AREA_IMF_CODE"),
    )
    renamed = feed.withColumnsRenamed({
        "COUNTRY": "REF_AREA_CODE", "INDICATOR": "CONCEPT_CODE", "UNIT": "UNIT_CODE",
        "FREQUENCY": "FREQ_CODE", "SCALE": "SCALE_CODE",
    })
    none = F.lit(None).cast("string")
    typed = renamed.withColumns({
        "SCALE_LABEL": numbers.scale_name(F.col("SCALE_CODE")),
        "SCALE_CODE": numbers.scale_multiplier(F.col("SCALE_CODE")),
        "OBS_VALUE": numbers.real(F.col("OBS_VALUE")),
        "UNIT_LABEL": none, "CONCEPT_LABEL": none, "REF_AREA_LABEL": none, "FREQ_LABEL": none,
    })
    return observations.contract(observations.with_null_metadata(typed), CONTRACT_COLUMNS)


@query(f"""
    WITH t AS (SELECT *, {EXPONENT_SQL} AS e FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN e > 0 THEN l_extendedprice / pow(10.0, e) ELSE l_extendedprice END AS scaled,
           CAST(CASE e WHEN 0 THEN 1 WHEN 6 THEN 1000000 WHEN 9 THEN 1000000000 END AS BIGINT) AS multiplier,
           CASE e WHEN 0 THEN 'Units' WHEN 6 THEN 'Millions' WHEN 9 THEN 'Billions' END AS scale_name
    FROM t
""")
def q_scale(spark, table):
    e = exponent(F.col("l_linenumber"))
    return table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.scaled(F.col("l_extendedprice"), e).alias("scaled"),
        numbers.scale_multiplier(e).alias("multiplier"),
        numbers.scale_name(e).alias("scale_name"),
    )


# Every order with one of five spellings of its year.
YEAR_TOKEN_SQL = """
    CASE o_orderpriority
        WHEN '1-URGENT' THEN 'FY' || year(o_orderdate) || '/' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2)
        WHEN '2-HIGH' THEN CAST(year(o_orderdate) AS VARCHAR)
        WHEN '3-MEDIUM' THEN 'n/a'
        WHEN '4-NOT SPECIFIED' THEN 'about ' || year(o_orderdate)
    END"""


def year_token():
    year, p = F.year("o_orderdate"), F.col("o_orderpriority")
    return (
        F.when(p == "1-URGENT", F.concat(F.lit("FY"), year, F.lit("/"), F.right((year + 1).cast("string"), F.lit(2))))
        .when(p == "2-HIGH", year.cast("string"))
        .when(p == "3-MEDIUM", F.lit("n/a"))
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("about "), year))
    )


@query(f"""
    SELECT o_orderkey, {YEAR_TOKEN_SQL} AS token,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(year(o_orderdate) AS INTEGER) END AS actual_year,
           CASE WHEN o_orderpriority <> '3-MEDIUM' THEN {YEAR_TOKEN_SQL} END AS known
    FROM orders
""")
def q_fy_parse(spark, table):
    df = table("orders").select("o_orderkey", year_token().alias("token"))
    token = F.col("token")
    return df.withColumns({"actual_year": dates.actual_year(token), "known": text.null_if_not_applicable(token)})


@query(f"""
    SELECT {YEAR_TOKEN_SQL} AS token, count(*) AS n FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' GROUP BY 1
""")
def q_unparsed_years(spark, table):
    return profile.unparsed_years(table("orders").select(year_token().alias("token")), "token")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS updated FROM orders
""")
def q_us_date(spark, table):
    written = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy"))
    padded = written.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM/dd/yyyy"))
    other = padded.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table("orders").select("o_orderkey", dates.us_date(other).alias("updated"))


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS announced FROM orders
""")
def q_long_date(spark, table):
    return table("orders").select("o_orderkey", dates.long_date(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("announced"))


@query("""
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS value,
           CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem
""")
def q_numeric_clean(spark, table):
    flag = F.col("l_returnflag")
    written = (
        F.when(flag == "A", "--").when((flag == "N") & (F.col("l_linestatus") == "F"), "n/a").otherwise(F.format_number("l_extendedprice", 2))
    )
    return table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.grouped_real(written).alias("value"),
        numbers.whole(numbers.grouped_real(F.format_number("l_quantity", 1))).alias("quantity"),
    )


@query("SELECT count(*) FILTER (WHERE l_returnflag = 'A') AS n_below_precision FROM lineitem")
def q_below_precision(spark, table):
    written = F.when(F.col("l_returnflag") == "A", "--").otherwise(F.format_number("l_extendedprice", 2))
    return profile.count_of_token(table("lineitem").select(written.alias("v")), "v", "--", "n_below_precision")


@query("SELECT c_custkey, abs(c_acctbal) AS amount FROM customer")
def q_strip_numeric(spark, table):
    written = F.concat(F.lit("SDR "), F.format_number("c_acctbal", 2), F.lit(" m"))
    return table("customer").select("c_custkey", numbers.digits_only_real(written).alias("amount"))


@query("""
    SELECT p_partkey, trim(piece) AS piece FROM (
        SELECT p_partkey, unnest(string_split(p_type || '; ' || p_brand || ';' || p_name, ';')) AS piece FROM part)
""")
def q_multivalue(spark, table):
    joined = F.concat("p_type", F.lit("; "), "p_brand", F.lit(";"), "p_name")
    return table("part").select("p_partkey", F.explode_outer(text.multi_value(joined)).alias("piece"))


@query("""
    SELECT o_orderkey,
           CASE WHEN month(o_orderdate) BETWEEN 4 AND 9 THEN 'April' ELSE 'October' END AS expected_month,
           CAST(CASE WHEN month(o_orderdate) < 4 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS INTEGER) AS expected_year,
           CASE WHEN month(o_orderdate) < 7 THEN 'April' ELSE 'October' END AS published_in,
           CAST(last_day(o_orderdate) AS DATE) AS month_end,
           year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(last_day(o_orderdate)) AS month_end_text
    FROM orders
""")
def q_expected_release(spark, table):
    day = F.col("o_orderdate")
    month, year = dates.expected_release(day)
    return table("orders").select(
        "o_orderkey",
        month.alias("expected_month"),
        year.alias("expected_year"),
        dates.release_month(day).alias("published_in"),
        dates.month_end(F.year(day), F.month(day)).alias("month_end"),
        dates.month_end_text(F.year(day), F.month(day)).alias("month_end_text"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN month(o_orderdate) < 7 THEN 'April' WHEN month(o_orderdate) < 12 THEN 'October' END AS month,
           CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders
""")
def q_release_argument(spark, table):
    """Release labels as people type them, tidied."""
    name = F.when(F.month("o_orderdate") < 7, " aPRil ").when(F.month("o_orderdate") < 12, "october").otherwise("December")
    typed_year = F.concat(F.lit(" "), F.year("o_orderdate").cast("string"))
    return table("orders").select(
        "o_orderkey", dates.tidy_month(name).alias("month"), dates.tidy_year(typed_year).alias("year")
    )


@query("""
    SELECT s_suppkey, 'G' || CASE WHEN s_suppkey < 1000 THEN lpad(CAST(s_suppkey AS VARCHAR), 3, '0') ELSE CAST(s_suppkey AS VARCHAR) END AS code
    FROM supplier
""")
def q_aggregate_code(spark, table):
    return table("supplier").select("s_suppkey", text.aggregate_code(F.col("s_suppkey")).alias("code"))


@query("""
    SELECT s_suppkey, 'acctbal' AS indicator, s_acctbal AS value FROM supplier
    UNION ALL SELECT s_suppkey, 'nationkey', CAST(s_nationkey AS DOUBLE) FROM supplier
""")
def q_melt(spark, table):
    wide = table("supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").cast("double").alias("nationkey")
    )
    return observations.melt(wide, ["s_suppkey"], ["acctbal", "nationkey"])


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(year(l_shipdate) AS INTEGER) AS release_year,
           CASE WHEN year(l_shipdate) < 1998 THEN l_discount END AS l_discount
    FROM lineitem
""")
def q_concat(spark, table):
    """Two slices of the table as releases of which the later one lacks a column."""
    df = table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.year("l_shipdate").alias("release_year"), "l_discount")
    early = df.filter("release_year < 1998")
    late = df.filter("release_year >= 1998").drop("l_discount").select("release_year", "l_extendedprice", "l_orderkey", "l_linenumber")
    return observations.concat_releases([early, late])


@query("""
    SELECT DISTINCT month, year, position, path FROM (
        SELECT month, year, unnest([1, 2, 3]) - 1 AS position,
               unnest(CASE WHEN year >= 2000 THEN [by_month, plain, by_number] ELSE [plain, by_month, by_number] END) AS path
        FROM (SELECT month, year, '/' || year || '/' || name AS plain, '/' || year || '/' || lower(month) || '/' || name AS by_month,
                     '/' || year || CASE month WHEN 'April' THEN '/01/' ELSE '/02/' END || name AS by_number
              FROM (SELECT month, year, 'weo' || CASE month WHEN 'April' THEN 'apr' ELSE 'oct' END || year || '-sdmxdata.zip' AS name
                    FROM (SELECT CASE WHEN month(o_orderdate) < 7 THEN 'April' ELSE 'October' END AS month,
                                 CAST(year(o_orderdate) + 24 AS INTEGER) AS year FROM orders))))
""".replace("year >= 2000", "year >= 2024"))
def q_archive_paths(spark, table):
    releases = table("orders").select(
        dates.release_month(F.col("o_orderdate")).alias("month"), (F.year("o_orderdate") + 24).alias("year")
    ).distinct()
    return releases.select("month", "year", F.posexplode(labels.archive_paths(F.col("month"), F.col("year"))).alias("position", "path"))
