"""Line feeds and ordinal pairing. Whole tables become feeds of a few files, so files are large."""

from pyspark.sql import functions as F

from macroloom.functions.text import field, fields
from macroloom.operators import positional
from macroloom.plans import reserves_feeds
from macroloom.showcase.registry import query


def minute(column):
    """Chunk of a zone-less time stamp: the minute it lies in, as text so that no time zone matters."""
    return F.substring(F.col(column).cast("string"), 1, 16)


@query("""
    WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS seen_at FROM events GROUP BY 1, 2),
    d AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id ORDER BY seen_at) - 1 AS ordinal FROM days),
    p AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ordinal FROM events WHERE event_type = 'purchase')
    SELECT coalesce(d.user_id, p.user_id) AS user_id, coalesce(d.ordinal, p.ordinal) AS ordinal, day, value
    FROM d FULL JOIN p ON d.user_id = p.user_id AND d.ordinal = p.ordinal
""")
def q_positional_outer(spark, table):
    """The k-th distinct day of a user beside the user's k-th purchase."""
    events = table("events")
    seen = events.select("user_id", F.to_date("ts").alias("day"), "ts")
    days = positional.first_occurrences(seen, ["user_id"], ["day"], "ts")
    purchases = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    chunks = (F.col("ts").cast("date"), minute("ts"))
    return positional.pair_by_ordinal(days, purchases, ["user_id"], ["ts"], ["ts", "event_id"], "full", chunks=chunks)


@query("""
    WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS seen_at FROM events GROUP BY 1, 2),
    d AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id ORDER BY seen_at) - 1 AS ordinal FROM days),
    s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ordinal FROM events WHERE event_type = 'signup')
    SELECT s.user_id, s.ordinal, value, day FROM s LEFT JOIN d ON d.user_id = s.user_id AND d.ordinal = s.ordinal
""")
def q_positional_left(spark, table):
    """The k-th signup of a user beside the user's k-th distinct day."""
    events = table("events")
    seen = events.select("user_id", F.to_date("ts").alias("day"), "ts")
    days = positional.first_occurrences(seen, ["user_id"], ["day"], "ts")
    signups = events.filter("event_type = 'signup'").select("user_id", "ts", "event_id", "value")
    chunks = (minute("ts"), F.col("ts").cast("date"))
    return positional.pair_by_ordinal(signups, days, ["user_id"], ["ts", "event_id"], ["ts"], "left", chunks=chunks)


@query("""
    SELECT l_returnflag, o_orderkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY o_orderkey) - 1 AS n
    FROM (SELECT DISTINCT l_returnflag, l_orderkey AS o_orderkey FROM lineitem)
""")
def q_ordinal(spark, table):
    """Row numbers in three groups that hold a third of the rows each."""
    df = table("lineitem").select("l_returnflag", F.col("l_orderkey").alias("o_orderkey")).distinct()
    return positional.ordinal(df, ["l_returnflag"], ["o_orderkey"], "n", F.floor(F.col("o_orderkey") / 1024))


@query("""
    SELECT l_orderkey, l_linenumber, l_returnflag AS label, CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS amount
    FROM lineitem WHERE l_returnflag <> 'A'
""")
def q_footer_rows(spark, table):
    """Ragged lines: the label is the first field and every other line lacks the second one."""
    line = F.concat(F.col("l_returnflag"), F.when(F.col("l_linestatus") == "O", F.concat(F.lit("\t"), "l_extendedprice")).otherwise(F.lit("")))
    lines = table("lineitem").select("l_orderkey", "l_linenumber", line.alias("value"))
    parts = lines.select("l_orderkey", "l_linenumber", fields(F.col("value")).alias("parts"))
    kept = positional.without_labels(parts, field(F.col("parts"), 0), ["A"])
    labelled = [
        positional.rows_labelled(kept, F.col("parts"), flag, out="amount").withColumn("label", F.lit(flag)) for flag in ("N", "R")
    ]
    both = labelled[0].unionByName(labelled[1])
    return both.select("l_orderkey", "l_linenumber", "label", F.col("amount").cast("double").alias("amount"))


def as_lines(df, file, first, texts):
    """Lines of a feed: ``texts`` per row, numbered from ``first`` within ``file``."""
    entries = F.array(*[F.struct((first + i).cast("bigint").alias("line_no"), t.alias("value")) for i, t in enumerate(texts)])
    return df.select(file.alias("file"), F.inline(entries)).filter(F.col("value").isNotNull())


def with_preface(lines, *texts):
    """The first lines of every file: title and, for two of the feeds, column names."""
    files = lines.select("file").distinct()
    return lines.unionByName(as_lines(files, F.col("file"), F.lit(0), [F.lit(t) for t in texts]))


@query("""
    WITH rate AS (SELECT o_orderstatus AS file, o_totalprice / 100000 AS r, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS ordinal
                  FROM orders WHERE o_orderpriority <> '5-LOW'),
    seen AS (SELECT o_orderstatus AS file, CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS seen_at FROM orders GROUP BY 1, 2),
    d AS (SELECT file, date, row_number() OVER (PARTITION BY file ORDER BY seen_at) - 1 AS ordinal FROM seen)
    SELECT coalesce(d.file, rate.file) AS file, coalesce(d.ordinal, rate.ordinal) AS ordinal, date, r AS exchange_rate
    FROM d FULL JOIN rate ON d.file = rate.file AND d.ordinal = rate.ordinal
""")
def q_exchange_feed(spark, table):
    """An exchange-rate feed with a block of lines per order; low-priority blocks lack the rate line."""
    rate = (F.col("o_totalprice") / 100000).cast("string")
    texts = [
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("\tEuro\t0.4\t1.1")),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("\tYen\t12.1\t150")),
        F.lit("U.S.$1.00 = SDR\t0.75"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("SDR1 = US$\t"), rate)),
    ]
    lines = as_lines(table("orders"), F.col("o_orderstatus"), F.col("o_orderkey") * 4 + 2, texts)
    lines = with_preface(lines, "SDR Valuations", "Report date\tCurrency Unit\tCurrency amount\tExchange Rate")
    return reserves_feeds.exchange_rates(lines, "SDR")


@query("""
    WITH rate AS (SELECT o_orderpriority AS file, o_totalprice AS r, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS ordinal
                  FROM orders WHERE o_orderstatus <> 'P'),
    seen AS (SELECT o_orderpriority AS file, CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS seen_at FROM orders GROUP BY 1, 2),
    d AS (SELECT file, date, row_number() OVER (PARTITION BY file ORDER BY seen_at) - 1 AS ordinal FROM seen)
    SELECT rate.file, rate.ordinal, r AS interest_rate, date AS effective_from, CAST(date + INTERVAL 6 DAY AS DATE) AS effective_to
    FROM rate LEFT JOIN d ON d.file = rate.file AND d.ordinal = rate.ordinal
""")
def q_interest_feed(spark, table):
    """An interest-rate feed with a period, two lines to be skipped and (mostly) a rate per order."""
    day = lambda shift: F.date_format(F.date_add("o_orderdate", shift), "MM/dd/yyyy")
    total = F.col("o_totalprice").cast("string")
    texts = [
        F.concat(day(0), F.lit("\t"), day(6), F.lit("\tN/A\tN/A")),
        F.lit("a line without a second field"),
        F.lit("Total\t2.75"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("SDR Interest Rate\t"), total)),
    ]
    lines = as_lines(table("orders"), F.col("o_orderpriority"), F.col("o_orderkey") * 4 + 2, texts)
    lines = with_preface(lines, "SDR Interest Rate Calculation", "Effective from\tEffective to\tCurrency Unit\tCurrency amount\tExchange rate")
    return reserves_feeds.interest_rates(lines)


@query("""
    SELECT '2020-' || (1 + c_nationkey % 12) AS file, c_name AS entity, indicator,
           CASE WHEN indicator = 'holdings' THEN abs(c_acctbal) WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS DOUBLE) END AS value,
           CAST(last_day(make_date(2020, 1 + c_nationkey % 12, 1)) AS DATE) AS date
    FROM customer, (VALUES ('holdings'), ('allocations')) AS t(indicator)
""")
def q_holdings_feed(spark, table):
    """A year of month-end feeds in one job; some members have no third field."""
    month = F.col("c_nationkey") % 12 + 1
    third = F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("\t"), "c_custkey")).otherwise(F.lit(""))
    text = F.concat("c_name", F.lit("\t"), F.format_number("c_acctbal", 2), third)
    lines = as_lines(table("customer"), F.concat(F.lit("2020-"), month), F.col("c_custkey") + 4, [text])
    lines = with_preface(lines, "SDR Allocations and Holdings", "for all members", "(in SDRs)", "Members\tSDR Holdings\tSDR Allocations")
    year, part = F.substring("file", 1, 4).cast("int"), F.split_part(F.col("file"), F.lit("-"), F.lit(2)).cast("int")
    return reserves_feeds.holdings(lines, year, part)
