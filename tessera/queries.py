"""Registered queries over the test tables, each with an equivalent SQL text.

Every query reads the given tables (or data Spark derives from them) in full.
The test tables hold no NULLs, so queries that exercise NULL rules make them
with ``NULLIF`` on both sides. Every computed column is aliased identically in
the DataFrame code and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import truncate_period
from tessera.functions.nulls import all_null, any_present
from tessera.functions.timezone import at_time_zone_utc, ntz_micros, utc_wall_to_instant
from tessera.operators.aggregates import (
    conditional_count,
    counts_by_period,
    counts_by_periods,
    element_frequency,
    filtered_count,
    key_cardinality,
    numeric_range,
    population,
    value_frequencies,
    value_frequency,
)
from tessera.operators.dedup import row_number_per_key
from tessera.operators.filters import at_least, equals
from tessera.operators.heavy_hitters import heavy_hitters
from tessera.operators.mergeable import ERROR, merged_profile, profile_state
from tessera.operators.profile import profile
from tessera.operators.projection import drop_columns, rename_cast
from tessera.operators.quality import output_checks, range_check, reconciliation, schema_check
from tessera.operators.sample import sample_rows
from tessera.operators.topk import sort_asc, top_k, top_n_other
from tessera.plans.bronze import bronze_layer
from tessera.plans.marts import additions_mart, category_mart, multivalue_mart, write_product_fact
from tessera.plans.profile_job import profile_dataset
from tessera.plans.silver import silver_layer, silver_transform
from tessera.scratch import Scratch, lasting_path
from tessera.session import session_conf
from tessera.sources.footers import footer_stats
from tessera.sources.report import write_profile_json
from tessera.sources.schema import describe
from tessera.sources.parquet import write_parquet
from tessera.sources.snapshot import read_snapshots, write_snapshot
from tessera.sources.warehouse import load_table, load_view, refresh_partitions, write_bucketed_table, write_partitioned

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# events with NULLs made by NULLIF: the name columns of the curation rules
# ---------------------------------------------------------------------------

_NO_TYPE = "error"
_NO_USER = 7
_NO_PROPS = '{"k": 1}'


def _events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "ts",
        F.nullif(F.col("user_id"), F.lit(_NO_USER).cast("long")).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit(_NO_TYPE)).alias("event_type"),
        "value",
        F.nullif(F.col("props"), F.lit(_NO_PROPS)).alias("props"),
    )


_EVENTS_WITH_NULLS_SQL = f"""
    SELECT event_id, ts, NULLIF(user_id, {_NO_USER}) AS user_id,
           NULLIF(event_type, '{_NO_TYPE}') AS event_type,
           value,
           NULLIF(props, '{_NO_PROPS}') AS props
    FROM events
"""

_EVENT_NAMES = ("event_type", "props")


def q_silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the curation job on events - key user_id, newest ts wins
    (event_id breaks ties), rows without key or without any name dropped
    first, timestamps in UTC."""
    return silver_transform(
        _events_with_nulls(spark, sf_dir),
        key="user_id",
        order_by=("ts", "event_id"),
        name_columns=_EVENT_NAMES,
        keep=("user_id", "event_id", "ts", "event_type", "value", "props"),
        utc_columns=("ts",),
        utc_mode="wall",
    )


SQL_SILVER_LATEST = f"""
SELECT user_id, event_id, ts, event_type, value, props
FROM (
    SELECT *, ROW_NUMBER() OVER (
                PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM ({_EVENTS_WITH_NULLS_SQL}) e
    WHERE user_id IS NOT NULL
      AND NOT (event_type IS NULL AND props IS NULL)
) t
WHERE rn = 1
"""


def q_latest_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row number per customer, newest order first, order key breaking ties."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return row_number_per_key(orders, "o_custkey", ("o_orderdate", "o_orderkey"), descending=True, rank_col="rn")


SQL_LATEST_WITH_TIES = """
SELECT o_custkey, o_orderkey, o_orderdate,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS BIGINT) AS rn
FROM orders
"""


def q_latest_of_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row number per user in ordered pieces, with one user holding a third of
    all events: no task numbers that user's rows alone."""
    events = table(spark, sf_dir, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id"))
    rows = events.select("event_id", hot.alias("user_id"), "ts")
    return row_number_per_key(rows, "user_id", ("ts", "event_id"), strategy="pieces")


SQL_LATEST_OF_HOT_KEY = """
SELECT event_id, user_id, ts,
       CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS BIGINT) AS rn
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts FROM events) e
"""


def q_silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job file to file, on zoned timestamps: event times are wall
    times of a zone five hours behind UTC, stored as instants, and come out as
    naive UTC wall times."""
    events = _events_with_nulls(spark, sf_dir)
    zoned = events.withColumn("ts", utc_wall_to_instant(F.col("ts") + F.expr("INTERVAL 5 HOURS")))
    with Scratch(spark) as scratch:
        bronze = write_parquet(zoned, scratch.path("bronze"))
        path = silver_layer(
            spark,
            bronze,
            lasting_path(spark, "silver"),
            run_date=date(2026, 7, 1),
            key="user_id",
            order_by=("ts", "event_id"),
            name_columns=_EVENT_NAMES,
            keep=("user_id", "event_id", "ts", "event_type", "value", "props"),
            utc_columns=("ts",),
        )
    return spark.read.parquet(path)


SQL_SILVER_LAYER = f"""
WITH zoned AS (SELECT * REPLACE (ts AT TIME ZONE 'Etc/GMT+5' AS ts) FROM ({_EVENTS_WITH_NULLS_SQL}) e)
SELECT user_id, event_id, ts AT TIME ZONE 'UTC' AS ts, event_type, value, props
FROM zoned
WHERE user_id IS NOT NULL AND coalesce(event_type, props) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
"""


def q_utc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``AT TIME ZONE 'UTC'`` both ways, as epoch microseconds: naive -> instant,
    and that instant -> naive UTC wall time again."""
    ev = table(spark, sf_dir, "events")
    dtypes = dict((f.name, f.dataType) for f in ev.schema.fields)
    instant = at_time_zone_utc(F.col("ts"), dtypes["ts"])
    wall = at_time_zone_utc(instant, ev.select(instant.alias("i")).schema["i"].dataType)
    return ev.select(
        "event_id",
        F.unix_micros(instant).alias("utc_instant_us"),
        ntz_micros(wall).alias("utc_wall_us"),
    )


SQL_UTC_NORMALIZE = """
SELECT event_id,
       epoch_us(ts AT TIME ZONE 'UTC') AS utc_instant_us,
       epoch_us((ts AT TIME ZONE 'UTC') AT TIME ZONE 'UTC') AS utc_wall_us
FROM events
"""


def _write_raw_tsv(spark: SparkSession, sf_dir: str, name: str, raw_dir: str, compression: str = "gzip") -> str:
    """A table as a raw TSV snapshot folder, gzip by default."""
    (
        table(spark, sf_dir, name)
        .write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("compression", compression)
        # full microsecond precision (the writer's default keeps milliseconds)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        .csv(raw_dir)
    )
    return raw_dir


def _bronze_roundtrip(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Bronze job end to end: a table is written as gzip TSV, scanned back with
    full-file typing, written as a dated Parquet snapshot and read again."""
    with Scratch(spark) as scratch:
        raw_dir = _write_raw_tsv(spark, sf_dir, name, scratch.path(f"raw-{name}"))
        path = bronze_layer(spark, raw_dir, lasting_path(spark, "bronze"), run_date=date(2026, 7, 1))
    return spark.read.parquet(path)


def q_tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: integers come back as bigint, prices as double, names as text."""
    return _bronze_roundtrip(spark, sf_dir, "part")


def q_tsv_roundtrip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: timestamps typed from text, quoted ``{"k": n}`` fields intact."""
    return _bronze_roundtrip(spark, sf_dir, "events")


def q_tsv_roundtrip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: quoted texts with line breaks and tabs come back whole."""
    return _bronze_roundtrip(spark, sf_dir, "documents")


def q_tsv_plain_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as one plain text file with line breaks in its fields, read by
    several tasks and typed."""
    with Scratch(spark) as scratch:
        raw = _write_raw_tsv(spark, sf_dir, "documents", scratch.path("plain-documents"), compression="none")
        # splits of 256 KB, so that also the smallest table has several
        with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "256k"}):
            path = bronze_layer(spark, raw, lasting_path(spark, "bronze"), run_date=date(2026, 7, 1))
    return spark.read.parquet(path)


SQL_TSV_ROUNDTRIP_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"

SQL_TSV_ROUNDTRIP = """
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice
FROM part
"""

SQL_TSV_ROUNDTRIP_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def q_describe_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``DESCRIBE`` of the bronze table built from events as raw text: column
    names and the SQL types inferred from the whole file."""
    return describe(_bronze_roundtrip(spark, sf_dir, "events")).select("column", "type")


SQL_DESCRIBE_BRONZE = """
SELECT column_name AS "column", column_type AS type
FROM (DESCRIBE SELECT event_id, ts, user_id, event_type, value, props FROM events)
"""


def q_schema_preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze keeps the source's columns in order: position by position, the
    columns of part against those of its bronze copy."""
    expected = table(spark, sf_dir, "part").columns
    return schema_check(_bronze_roundtrip(spark, sf_dir, "part"), expected)


SQL_SCHEMA_PRESERVED = """
SELECT ordinal_position - 1 AS position, column_name AS expected, column_name AS actual, true AS matches
FROM information_schema.columns WHERE table_name = 'part'
"""


def q_schema_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of customer against those of a copy with one renamed and one
    dropped: two positions that don't match."""
    cust = table(spark, sf_dir, "customer")
    return schema_check(drop_columns(rename_cast(cust, {"c_name": ("name", None)}), ["c_mktsegment"]), cust.columns)


SQL_SCHEMA_MISMATCH = """
WITH expected AS (
    SELECT ordinal_position - 1 AS position, column_name AS expected
    FROM information_schema.columns WHERE table_name = 'customer'),
actual AS (
    SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS actual
    FROM (DESCRIBE SELECT c_custkey, c_name AS name, c_nationkey, c_acctbal FROM customer))
SELECT position, expected, actual, expected IS NOT DISTINCT FROM actual AS matches
FROM expected LEFT JOIN actual USING (position)
"""


# ---------------------------------------------------------------------------
# profiles
# ---------------------------------------------------------------------------

_LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def _sql_ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _profile_sql(source: str, columns: tuple[str, ...]) -> str:
    parts = []
    for name in columns:
        c = _sql_ident(name)
        parts.append(
            f"""SELECT {_sql_text(name)} AS "column", (SELECT typeof({c}) FROM {source} LIMIT 1) AS type,
       round(1 - count({c}) / count(*), 4) AS null_rate,
       count(DISTINCT {c}) AS distinct_values
FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


def q_profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "lineitem"))


SQL_PROFILE_TABLE = _profile_sql("lineitem", _LINEITEM_COLUMNS)

_EVENT_PROFILE_COLUMNS = ("user_id", "ts", "event_type", "value", "props")


def q_profile_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_with_nulls(spark, sf_dir).withColumn("value", F.nullif(F.col("value"), F.lit(0.01)))
    return profile(ev, columns=list(_EVENT_PROFILE_COLUMNS))


SQL_PROFILE_SUBSET = "WITH ev AS (SELECT event_id, ts, user_id, event_type, NULLIF(value, 0.01) AS value, props FROM ({})) ".format(
    _EVENTS_WITH_NULLS_SQL
) + _profile_sql("ev", _EVENT_PROFILE_COLUMNS)


def q_profile_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile job on a raw file: part as gzip TSV, typed from the whole file,
    then profiled (integers come back as bigint)."""
    with Scratch(spark) as scratch:
        raw_dir = _write_raw_tsv(spark, sf_dir, "part", scratch.path("raw-part"))
        return profile_dataset(spark, raw_dir, fmt="tsv")


SQL_PROFILE_TSV = (
    "WITH part_t AS (SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, "
    "p_retailprice FROM part) "
    + _profile_sql("part_t", ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))
)


# Customer columns under names that only work quoted (space,
# dot, double quote, back-quote, single quote).
_ODD_NAMES = (
    ("c_custkey", "customer key"),
    ("c_name", "c.name"),
    ("c_nationkey", 'nation "id"'),
    ("c_acctbal", "acct`bal"),
    ("c_mktsegment", "seg-ment's"),
)


def q_profile_quoted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dynamic, quoted column list: customer under awkward column names
    (segment 'BUILDING' made NULL), profiled by name."""
    cust = table(spark, sf_dir, "customer")
    renamed = cust.select(
        *[
            (F.nullif(F.col(src), F.lit("BUILDING")) if src == "c_mktsegment" else F.col(src)).alias(dst)
            for src, dst in _ODD_NAMES
        ]
    )
    return profile(renamed, columns=[dst for _, dst in _ODD_NAMES])


def _odd_name_source_sql(src: str) -> str:
    return "NULLIF(c_mktsegment, 'BUILDING')" if src == "c_mktsegment" else src


SQL_PROFILE_QUOTED_NAMES = (
    "WITH c AS (SELECT "
    + ", ".join(f"{_odd_name_source_sql(src)} AS {_sql_ident(dst)}" for src, dst in _ODD_NAMES)
    + " FROM customer) "
    + _profile_sql("c", tuple(dst for _, dst in _ODD_NAMES))
)


def q_profile_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Bernoulli sample of about half of lineitem, profiled (sampling is the
    feature): what is the same whatever rows are drawn."""
    sampled = profile(table(spark, sf_dir, "lineitem"), sample_fraction=0.5, seed=7)
    full = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))
    bounded = (F.col("distinct_values") > 0) & (F.col("distinct_values") <= F.col("n"))
    return sampled.join(F.broadcast(full)).select("column", "type", "null_rate", bounded.alias("distinct_in_range"))


SQL_PROFILE_SAMPLED = "SELECT \"column\", type, null_rate, true AS distinct_in_range FROM (" + _profile_sql("lineitem", _LINEITEM_COLUMNS) + ") p"


def q_profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of orders written as a JSON report (one JSON array) and
    read back."""
    out = write_profile_json(profile(table(spark, sf_dir, "orders")), lasting_path(spark, "profile-report"))
    return (
        spark.read.option("multiLine", True)
        .schema("column string, type string, null_rate double, distinct_values long")
        .json(out)
    )


_ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
SQL_PROFILE_REPORT = _profile_sql("orders", _ORDERS_COLUMNS)


# ---------------------------------------------------------------------------
# aggregates, sorts, top-k
# ---------------------------------------------------------------------------


def q_value_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_frequency(_events_with_nulls(spark, sf_dir), "event_type")


SQL_VALUE_FREQ = f"""
SELECT event_type, count(*) AS cnt FROM ({_EVENTS_WITH_NULLS_SQL}) e
GROUP BY event_type ORDER BY cnt DESC, event_type
"""


_FREQ_COLUMNS = ("event_type", "props", "user_id")


def q_value_freq_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent values of several event columns, one job."""
    return value_frequencies(_events_with_nulls(spark, sf_dir), _FREQ_COLUMNS, top=5)


SQL_VALUE_FREQ_COLUMNS = f"WITH e AS ({_EVENTS_WITH_NULLS_SQL})\n" + "\nUNION ALL\n".join(
    f"""(SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS cnt
 FROM e GROUP BY 2 ORDER BY cnt DESC, value ASC NULLS LAST LIMIT 5)"""
    for c in _FREQ_COLUMNS
)


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        F.when(third == 0, F.lit(0.0)).when(third == 1, F.lit(-0.0)).otherwise(F.round("value", 0)).alias("amount"),
        F.col("ts").cast("date").alias("day"),
        (F.col("user_id") % 2 == 0).alias("even"),
        F.when(third == 0, "Other").when(third == 1, F.col("event_type")).alias("kind"),
    )


_TYPED_EVENTS_SQL = """
    SELECT CASE WHEN event_id % 3 <> 2 THEN 0.0::DOUBLE ELSE round(value, 0) + 0.0 END AS amount, CAST(ts AS DATE) AS day,
           user_id % 2 = 0 AS even,
           CASE event_id % 3 WHEN 0 THEN 'Other' WHEN 1 THEN event_type END AS kind
    FROM events
"""


def q_value_freq_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies of typed columns: both signed zeros are one value, dates and
    booleans are counted as such, more places than a window limit's threshold."""
    return value_frequencies(_typed_events(spark, sf_dir), ("amount", "day", "even", "kind"), top=2000)


SQL_VALUE_FREQ_TYPED = f"WITH e AS ({_TYPED_EVENTS_SQL})\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", value, cnt FROM (
    SELECT CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM e GROUP BY 1
    QUALIFY row_number() OVER (ORDER BY count(*) DESC, value ASC NULLS LAST) <= 2000)"""
    for c in ("amount", "day", "even", "kind")
)


def q_topn_other_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that holds the value ``Other`` and NULLs: the value keeps its own
    row beside the bucket, and NULL takes no place."""
    return top_n_other(_typed_events(spark, sf_dir), "kind", 2, nulls="other", other_flag="folded")


SQL_TOPN_OTHER_REAL = f"""
WITH ranked AS (
    SELECT kind, count(*) AS c, row_number() OVER (ORDER BY kind IS NULL, count(*) DESC, kind) AS place
    FROM ({_TYPED_EVENTS_SQL}) e GROUP BY kind)
SELECT kind AS label, c AS cnt, false AS folded FROM ranked WHERE place <= 2 AND kind IS NOT NULL
UNION ALL
SELECT 'Other', CAST(sum(c) AS BIGINT), true FROM ranked WHERE place > 2 OR kind IS NULL
"""


def q_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = value_frequency(table(spark, sf_dir, "part"), "p_brand", ordered=False)
    return top_k(freq, "cnt", 10, descending=True, tiebreak=("p_brand",))


SQL_TOP_VALUES = """
SELECT p_brand, count(*) AS cnt FROM part GROUP BY p_brand ORDER BY cnt DESC, p_brand LIMIT 10
"""


def q_newest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = top_k(table(spark, sf_dir, "orders"), ("o_orderdate", "o_orderkey"), 3, descending=True)
    return newest.select("o_orderkey", "o_orderdate")


SQL_NEWEST_ORDERS = """
SELECT o_orderkey, o_orderdate
FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 3) t
"""


def q_first_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    return sort_asc(cust, ("segment", "c_custkey")).limit(10)


SQL_FIRST_KEYS = """
SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS segment
FROM customer ORDER BY segment ASC NULLS LAST, c_custkey LIMIT 10
"""


def q_both_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditional_count(_events_with_nulls(spark, sf_dir), {"both_null": all_null(_EVENT_NAMES)})


SQL_BOTH_NULL_COUNT = f"""
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE event_type IS NULL AND props IS NULL) AS both_null
FROM ({_EVENTS_WITH_NULLS_SQL}) e
"""


def q_range_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_range(table(spark, sf_dir, "lineitem"), "l_extendedprice", digits=4)


SQL_RANGE_STATS = """
SELECT min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value,
       round(avg(l_extendedprice), 4) AS avg_value
FROM lineitem
"""


def q_key_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_cardinality(table(spark, sf_dir, "orders"), "o_custkey")


SQL_KEY_CARD = "SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_keys FROM orders"


def q_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_with_nulls(spark, sf_dir)
    return filtered_count(ev, F.col("user_id").isNotNull() & any_present(_EVENT_NAMES))


SQL_FILTERED_COUNT = f"""
SELECT count(*) AS total_rows FROM ({_EVENTS_WITH_NULLS_SQL}) e
WHERE user_id IS NOT NULL AND NOT (event_type IS NULL AND props IS NULL)
"""


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-by-rule accounting on the input and the checks on the output of
    the flagship curation job."""
    ev = _events_with_nulls(spark, sf_dir)
    recon = reconciliation(ev, "user_id", _EVENT_NAMES)
    checks = output_checks(q_silver_latest(spark, sf_dir), "user_id", _EVENT_NAMES)
    return recon.unionByName(checks)


SQL_DQ_REPORT = f"""
WITH ev AS ({_EVENTS_WITH_NULLS_SQL}),
silver AS ({SQL_SILVER_LATEST})
SELECT 'rows_in' AS "check", count(*) AS rows FROM ev
UNION ALL SELECT 'dropped_null_key', count(*) FILTER (WHERE user_id IS NULL) FROM ev
UNION ALL SELECT 'dropped_no_name',
       count(*) FILTER (WHERE user_id IS NOT NULL AND event_type IS NULL AND props IS NULL) FROM ev
UNION ALL SELECT 'dropped_duplicate',
       count(*) FILTER (WHERE user_id IS NOT NULL AND NOT (event_type IS NULL AND props IS NULL))
       - count(DISTINCT CASE WHEN user_id IS NOT NULL AND NOT (event_type IS NULL AND props IS NULL)
                             THEN user_id END) FROM ev
UNION ALL SELECT 'rows_out',
       count(DISTINCT CASE WHEN user_id IS NOT NULL AND NOT (event_type IS NULL AND props IS NULL)
                           THEN user_id END) FROM ev
UNION ALL SELECT 'null_key', count(*) FILTER (WHERE user_id IS NULL) FROM silver
UNION ALL SELECT 'duplicate_key', count(user_id) - count(DISTINCT user_id) FROM silver
UNION ALL SELECT 'no_name', count(*) FILTER (WHERE event_type IS NULL AND props IS NULL) FROM silver
"""


def q_output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output checks on a table that fails each of them: raw events with
    NULL keys, several rows per key and rows without a name."""
    return output_checks(_events_with_nulls(spark, sf_dir), "user_id", _EVENT_NAMES)


SQL_OUTPUT_CHECKS = f"""
WITH ev AS ({_EVENTS_WITH_NULLS_SQL})
SELECT 'null_key' AS "check", count(*) FILTER (WHERE user_id IS NULL) AS rows FROM ev
UNION ALL SELECT 'duplicate_key', count(user_id) - count(DISTINCT user_id) FROM ev
UNION ALL SELECT 'no_name', count(*) FILTER (WHERE event_type IS NULL AND props IS NULL) FROM ev
"""


def q_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_check(table(spark, sf_dir, "lineitem"), "l_discount", 0.0, 0.05)


SQL_RANGE_CHECK = """
SELECT count(*) FILTER (WHERE l_discount < 0.0) AS below,
       count(*) FILTER (WHERE l_discount > 0.05) AS above,
       count(*) FILTER (WHERE l_discount < 0.0 OR l_discount > 0.05) AS out_of_range,
       min(l_discount) AS min_value, max(l_discount) AS max_value
FROM lineitem
"""


def q_placeholder_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real population of event_type and props once 'error' counts as missing."""
    ev = table(spark, sf_dir, "events")
    return population(ev, ["event_type", "props"], placeholders=(_NO_TYPE,))


SQL_PLACEHOLDER_RATE = f"""
SELECT 'event_type' AS "column", count(*) AS total_rows, count(event_type) AS non_null_rows,
       count(NULLIF(event_type, '{_NO_TYPE}')) AS populated_rows,
       round(count(NULLIF(event_type, '{_NO_TYPE}')) / count(*), 4) AS population_rate
FROM events
UNION ALL
SELECT 'props', count(*), count(props), count(NULLIF(props, '{_NO_TYPE}')),
       round(count(NULLIF(props, '{_NO_TYPE}')) / count(*), 4)
FROM events
"""


# ---------------------------------------------------------------------------
# marts
# ---------------------------------------------------------------------------


def _part_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    # p_name words as a comma-separated multi-value field
    return table(spark, sf_dir, "part").select(F.replace(F.col("p_name"), F.lit(" "), F.lit(",")).alias("tags"))


def q_unnest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return element_frequency(_part_tags(spark, sf_dir), "tags", alias="tag")


SQL_UNNEST_COUNT = """
SELECT tag, count(*) AS cnt
FROM (SELECT unnest(string_split(replace(p_name, ' ', ','), ',')) AS tag FROM part) t
GROUP BY tag
"""


def q_topn_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_other(table(spark, sf_dir, "part"), "p_brand", 5, label="label", count_col="cnt")


def _topn_other_sql(expr: str, source: str, n: int, null_takes_place: bool = True) -> str:
    nulls_last = "" if null_takes_place else "v IS NULL, "
    kept = f"place <= {n}" if null_takes_place else f"place <= {n} AND v IS NOT NULL"
    return f"""
WITH places AS (
    SELECT v, count(*) AS c, row_number() OVER (ORDER BY {nulls_last}count(*) DESC, v ASC NULLS LAST) AS place
    FROM (SELECT {expr} AS v FROM {source}) x GROUP BY v)
SELECT CAST(v AS VARCHAR) AS label, c AS cnt FROM places WHERE {kept}
UNION ALL
SELECT 'Other', CAST(sum(c) AS BIGINT) FROM places WHERE NOT ({kept}) HAVING count(*) > 0
"""


SQL_TOPN_OTHER = _topn_other_sql("p_brand", "part", 5)


def q_topn_other_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_other(table(spark, sf_dir, "documents"), "source", 5, label="label", count_col="cnt")


SQL_TOPN_OTHER_DOCS = _topn_other_sql("source", "documents", 5)


def q_country_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-value mart: tags of part names unnested, top 5 + Other."""
    return multivalue_mart(_part_tags(spark, sf_dir), "tags", n=5, label="label", count_col="products")


SQL_COUNTRY_MART = f"""
WITH elements AS (
    SELECT trim(e) AS element
    FROM (SELECT unnest(string_split(replace(p_name, ' ', ','), ',')) AS e FROM part) x
    WHERE trim(e) <> ''
)
SELECT label, cnt AS products FROM ({_topn_other_sql("element", "elements", 5)}) m
"""


def q_category_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categorical tile: events per type with 'error' counting as missing,
    top 3 + Other."""
    return category_mart(table(spark, sf_dir, "events"), "event_type", n=3, placeholders=(_NO_TYPE,))


SQL_CATEGORY_MART = f"""
SELECT label, cnt AS products
FROM ({_topn_other_sql(f"NULLIF(event_type, '{_NO_TYPE}')", "events", 3, False)}) m
"""


def q_additions_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_period(table(spark, sf_dir, "orders"), "o_orderdate", "month")


SQL_ADDITIONS_BY_MONTH = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS cnt
FROM orders GROUP BY 1 ORDER BY 1
"""


def q_additions_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_period(table(spark, sf_dir, "events"), "ts", "week")


SQL_ADDITIONS_BY_WEEK = """
SELECT CAST(date_trunc('week', ts) AS DATE) AS period, count(*) AS cnt
FROM events GROUP BY 1 ORDER BY 1
"""


def q_additions_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_period(table(spark, sf_dir, "events"), "ts", "day")


SQL_ADDITIONS_BY_DAY = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS period, count(*) AS cnt
FROM events GROUP BY 1 ORDER BY 1
"""


def q_additions_by_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temporal tile at three grains in one job: events per day, week and
    month, the longer periods rolled up from the per-day counts."""
    return counts_by_periods(table(spark, sf_dir, "events"), "ts", ("day", "week", "month"))


SQL_ADDITIONS_BY_PERIODS = "\nUNION ALL\n".join(
    f"SELECT '{unit}' AS unit, CAST(date_trunc('{unit}', ts) AS DATE) AS period, count(*) AS cnt FROM events GROUP BY 2"
    for unit in ("day", "week", "month")
)


# ---------------------------------------------------------------------------
# projections and filters
# ---------------------------------------------------------------------------


def q_equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``WHERE column = value``, pushed into the Parquet scan."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return equals(orders, "o_orderpriority", "1-URGENT")


SQL_EQUALITY_FILTER = """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def q_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return at_least(li, "l_discount", 0.05)


SQL_QUALITY_FILTER = "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.05"


def q_staging_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_cast(
        table(spark, sf_dir, "customer"),
        {
            "c_custkey": ("customer_id", None),
            "c_nationkey": ("nation_id", "bigint"),
            "c_acctbal": ("account_balance", None),
            "c_mktsegment": ("segment", None),
        },
    )


SQL_STAGING_RENAME_CAST = """
SELECT c_custkey AS customer_id, c_name, CAST(c_nationkey AS BIGINT) AS nation_id,
       c_acctbal AS account_balance, c_mktsegment AS segment
FROM customer
"""


def q_staging_cast_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cast with values that don't fit, as NULL on request."""
    odd = F.when(F.col("p_size") % 5 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", odd.alias("size_text"), (F.col("p_partkey") * 100_000_000).alias("big"))
    return rename_cast(parts, {"size_text": ("size", "int"), "big": ("small", "int")}, safe=True)


SQL_STAGING_CAST_SAFE = """
SELECT p_partkey, TRY_CAST(CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS size,
       TRY_CAST(p_partkey * 100000000 AS INTEGER) AS small
FROM part
"""


def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])


SQL_DROP_COLUMNS = "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer"


# ---------------------------------------------------------------------------
# sinks: partitioned mart, warehouse table, dated snapshots
# ---------------------------------------------------------------------------


def q_mart_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written partitioned by month and clustered by priority, then one
    year read back: the filter on the partition column prunes folders."""
    orders = table(spark, sf_dir, "orders").withColumn("order_month", truncate_period("o_orderdate", "month"))
    path = write_partitioned(orders, lasting_path(spark, "mart-orders"), ["order_month"], ["o_orderpriority"])
    back = spark.read.parquet(path)
    return back.where((F.col("order_month") >= F.lit(date(1996, 1, 1))) & (F.col("order_month") < F.lit(date(1997, 1, 1))))


SQL_MART_PARTITIONED = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month
FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'
"""


def q_warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-style load into a catalog table of the ``raw`` layer, read back."""
    name = "raw.events"
    load_table(
        table(spark, sf_dir, "events"),
        name,
        path=lasting_path(spark, "warehouse-raw-events"),
        database_location=lasting_path(spark, "warehouse-raw-db"),
    )
    return spark.table(name)


SQL_WAREHOUSE_LOAD = "SELECT * FROM events"


def q_warehouse_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw table, staging, mart table: orders loaded twice under a three-part
    name (the second load replaces the first), renamed and cast, counted per
    priority and loaded as a table of the ``mart`` layer, read back."""
    raw, mart = "spark_catalog.raw.orders", "spark_catalog.mart.priorities"
    orders, path = table(spark, sf_dir, "orders"), lasting_path(spark, "warehouse-raw-orders")
    for _ in range(2):
        load_table(orders, raw, path=path, database_location=lasting_path(spark, "warehouse-raw-db"))
    staged = rename_cast(spark.table(raw), {"o_orderpriority": ("priority", None), "o_custkey": ("customer_id", "bigint")})
    tile = category_mart(staged, "priority", n=3, count_col="orders")
    load_table(tile, mart, path=lasting_path(spark, "warehouse-mart"), database_location=lasting_path(spark, "warehouse-mart-db"))
    return spark.table(mart)


SQL_WAREHOUSE_MART = f"""
SELECT label, cnt AS orders FROM ({_topn_other_sql("o_orderpriority", "orders", 3, False)}) m
"""


def q_bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a table bucketed by customer, read back with a row count per
    customer that needs no shuffle."""
    orders = table(spark, sf_dir, "orders")
    name = "mart.orders_by_customer"
    write_bucketed_table(orders, name, 8, ["o_custkey"], ["o_custkey"], path=lasting_path(spark, "bucketed-orders"))
    return spark.table(name).groupBy("o_custkey").agg(F.count("*").alias("orders"), F.max("o_orderdate").alias("newest"))


SQL_BUCKETED_TABLE = "SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS newest FROM orders GROUP BY o_custkey"


def q_product_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table partitioned by month, clustered by priority, read back."""
    path = write_product_fact(
        table(spark, sf_dir, "orders"), lasting_path(spark, "product-fact"), "o_orderdate", cluster_by=("o_orderpriority",)
    )
    return spark.read.parquet(path)


SQL_PRODUCT_FACT = """
SELECT *, CAST(date_trunc('day', o_orderdate) AS DATE) AS created_date,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS created_month
FROM orders
"""


def q_additions_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additions_mart(table(spark, sf_dir, "orders"), "o_orderdate", "day")


SQL_ADDITIONS_MART = """
SELECT CAST(date_trunc('day', o_orderdate) AS DATE) AS period, count(*) AS products FROM orders GROUP BY 1
"""


def q_snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dated snapshots of the curated events, read back at once with the
    snapshot date taken from the path."""
    root = lasting_path(spark, "silver-history")
    silver = q_silver_latest(spark, sf_dir)
    write_snapshot(silver, root, date(2026, 7, 1))
    # the second one in versions, as on an object store, and loaded twice
    write_snapshot(silver, root, date(2026, 7, 2), versions=True)
    write_snapshot(silver.where(F.col("event_type").isNotNull()), root, date(2026, 7, 2), versions=True)
    return read_snapshots(spark, root).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"))


SQL_SNAPSHOT_HISTORY = f"""
WITH silver AS ({SQL_SILVER_LATEST})
SELECT DATE '2026-07-01' AS snapshot_date, count(*) AS rows FROM silver
UNION ALL
SELECT DATE '2026-07-02', count(*) FROM silver WHERE event_type IS NOT NULL
"""


# ---------------------------------------------------------------------------
# samples, mergeable profiles, heavy hitters, footers, refreshed partitions, views
# ---------------------------------------------------------------------------

_SAMPLE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 1,000 line items, drawn by the MD5 of their keys (the sample is
    the feature)."""
    drawn = sample_rows(table(spark, sf_dir, "lineitem"), 1000, keys=_SAMPLE_KEYS, seed=7)
    return drawn.select(*_SAMPLE_KEYS, "l_quantity", "l_shipdate")


_SAMPLE_SQL = """
SELECT * FROM lineitem
ORDER BY substr(md5(concat_ws('|', '7', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 15) LIMIT 1000
"""
SQL_SAMPLE_ROWS = f"SELECT {', '.join(_SAMPLE_KEYS)}, l_quantity, l_shipdate FROM ({_SAMPLE_SQL})"


def q_profile_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full profile of a sample of exactly 1,000 line items."""
    return profile(table(spark, sf_dir, "lineitem"), sample_rows=1000, sample_keys=_SAMPLE_KEYS, seed=7)


SQL_PROFILE_SAMPLE_ROWS = f"WITH drawn AS ({_SAMPLE_SQL}) " + _profile_sql("drawn", _LINEITEM_COLUMNS)


def q_profile_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two snapshots (orders up to 1995, and those after), each
    stored as sketches and counts, merged without reading the snapshots again."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    root = lasting_path(spark, "profile-states")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    for day, part in ((1, orders.where(early)), (2, orders.where(~early))):
        write_snapshot(profile_state(part), root, date(2026, 7, day), name="profile.parquet")
    merged = merged_profile(read_snapshots(spark, root, name="profile.parquet"))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in orders.columns])))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1), F.ceil(F.col("exact") * 4 * ERROR))
    return merged.join(exact, "column").select("column", "type", "total_rows", "non_null_rows", "null_rate", near.alias("distinct_within_error"))


SQL_PROFILE_HISTORY = (
    "WITH o AS (SELECT * REPLACE (NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders) "
    "SELECT \"column\", type, (SELECT count(*) FROM o) AS total_rows, "
    "CASE WHEN \"column\" = 'o_orderpriority' THEN (SELECT count(o_orderpriority) FROM o) ELSE (SELECT count(*) FROM o) END AS non_null_rows, "
    "null_rate, true AS distinct_within_error FROM ("
    + _profile_sql("o", ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    + ") p"
)


def q_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 parts ordered most often and the rest, from summaries and one more
    scan where those prove the list."""
    return heavy_hitters(table(spark, sf_dir, "lineitem"), "l_partkey", 20).rows


SQL_HEAVY_HITTERS = """
WITH counts AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey),
top AS (SELECT l_partkey, n FROM counts ORDER BY n DESC, l_partkey LIMIT 20)
SELECT CAST(l_partkey AS VARCHAR) AS label, n AS cnt FROM top
UNION ALL
SELECT 'Other', CAST(sum(n) AS BIGINT) FROM counts WHERE l_partkey NOT IN (SELECT l_partkey FROM top) HAVING count(*) > 0
"""


def q_heavy_hitters_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three commonest event types and the rest."""
    return heavy_hitters(table(spark, sf_dir, "events"), "event_type", 3).rows


SQL_HEAVY_HITTERS_EVENTS = """
WITH counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
top AS (SELECT event_type, n FROM counts ORDER BY n DESC, event_type LIMIT 3)
SELECT event_type AS label, n AS cnt FROM top
UNION ALL
SELECT 'Other', CAST(sum(n) AS BIGINT) FROM counts WHERE event_type NOT IN (SELECT event_type FROM top) HAVING count(*) > 0
"""


def q_footer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and ranges of the columns of orders from file footers alone."""
    found = footer_stats(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    return found.select("column", "total_rows", "non_null_rows", *[F.col(c).cast("double").alias(c) for c in ("min_value", "max_value")])


SQL_FOOTER_STATS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS total_rows, count({c}) AS non_null_rows, "
    + (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value" if ranged else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value")
    + " FROM orders"
    for c, ranged in (("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False), ("o_totalprice", False), ("o_orderdate", False), ("o_orderpriority", False))
)


def q_refresh_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order mart by month, of which March 1996 is written again (twice) with
    prices doubled; then counts and sums by month."""
    orders = table(spark, sf_dir, "orders").withColumn("order_month", truncate_period("o_orderdate", "month"))
    path = write_partitioned(orders, lasting_path(spark, "mart-refreshed"), ["order_month"], ["o_orderpriority"])
    changed = orders.where(F.col("order_month") == F.lit(date(1996, 3, 1))).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        refresh_partitions(changed, path, ["order_month"], ["o_orderpriority"])
    return spark.read.parquet(path).groupBy("order_month").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


SQL_REFRESH_PARTITIONS = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, count(*) AS orders,
       round(sum(CASE WHEN date_trunc('month', o_orderdate) = DATE '1996-03-01' THEN 2 ELSE 1 END * o_totalprice), 2) AS total
FROM orders GROUP BY 1
"""


def q_warehouse_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded behind a view, then again with other columns."""
    customers, path = table(spark, sf_dir, "customer"), lasting_path(spark, "warehouse-view")
    load_view(customers, "customer_versions", path)
    changed = customers.drop("c_mktsegment").withColumn("c_owes", F.col("c_acctbal") < 0)
    load_view(changed, "customer_versions", path)
    return spark.table("customer_versions")


SQL_WAREHOUSE_VIEW = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_acctbal < 0 AS c_owes FROM customer"


# name -> (DataFrame query, SQL text or None for a rows-only check)
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {
    "silver_latest": (q_silver_latest, SQL_SILVER_LATEST),
    "latest_with_ties": (q_latest_with_ties, SQL_LATEST_WITH_TIES),
    "utc_normalize": (q_utc_normalize, SQL_UTC_NORMALIZE),
    "tsv_roundtrip": (q_tsv_roundtrip, SQL_TSV_ROUNDTRIP),
    "tsv_roundtrip_events": (q_tsv_roundtrip_events, SQL_TSV_ROUNDTRIP_EVENTS),
    "describe_bronze": (q_describe_bronze, SQL_DESCRIBE_BRONZE),
    "schema_preserved": (q_schema_preserved, SQL_SCHEMA_PRESERVED),
    "profile_table": (q_profile_table, SQL_PROFILE_TABLE),
    "profile_subset": (q_profile_subset, SQL_PROFILE_SUBSET),
    "profile_sampled": (q_profile_sampled, SQL_PROFILE_SAMPLED),
    "profile_tsv": (q_profile_tsv, SQL_PROFILE_TSV),
    "profile_report": (q_profile_report, SQL_PROFILE_REPORT),
    "profile_quoted_names": (q_profile_quoted_names, SQL_PROFILE_QUOTED_NAMES),
    "value_freq": (q_value_freq, SQL_VALUE_FREQ),
    "value_freq_columns": (q_value_freq_columns, SQL_VALUE_FREQ_COLUMNS),
    "top_values": (q_top_values, SQL_TOP_VALUES),
    "newest_orders": (q_newest_orders, SQL_NEWEST_ORDERS),
    "first_keys": (q_first_keys, SQL_FIRST_KEYS),
    "both_null_count": (q_both_null_count, SQL_BOTH_NULL_COUNT),
    "range_stats": (q_range_stats, SQL_RANGE_STATS),
    "key_card": (q_key_card, SQL_KEY_CARD),
    "filtered_count": (q_filtered_count, SQL_FILTERED_COUNT),
    "dq_report": (q_dq_report, SQL_DQ_REPORT),
    "range_check": (q_range_check, SQL_RANGE_CHECK),
    "placeholder_rate": (q_placeholder_rate, SQL_PLACEHOLDER_RATE),
    "unnest_count": (q_unnest_count, SQL_UNNEST_COUNT),
    "topn_other": (q_topn_other, SQL_TOPN_OTHER),
    "topn_other_docs": (q_topn_other_docs, SQL_TOPN_OTHER_DOCS),
    "country_mart": (q_country_mart, SQL_COUNTRY_MART),
    "category_mart": (q_category_mart, SQL_CATEGORY_MART),
    "additions_by_day": (q_additions_by_day, SQL_ADDITIONS_BY_DAY),
    "additions_by_week": (q_additions_by_week, SQL_ADDITIONS_BY_WEEK),
    "additions_by_month": (q_additions_by_month, SQL_ADDITIONS_BY_MONTH),
    "additions_by_periods": (q_additions_by_periods, SQL_ADDITIONS_BY_PERIODS),
    "equality_filter": (q_equality_filter, SQL_EQUALITY_FILTER),
    "quality_filter": (q_quality_filter, SQL_QUALITY_FILTER),
    "staging_rename_cast": (q_staging_rename_cast, SQL_STAGING_RENAME_CAST),
    "drop_columns": (q_drop_columns, SQL_DROP_COLUMNS),
    "mart_partitioned": (q_mart_partitioned, SQL_MART_PARTITIONED),
    "warehouse_load": (q_warehouse_load, SQL_WAREHOUSE_LOAD),
    "snapshot_history": (q_snapshot_history, SQL_SNAPSHOT_HISTORY),
    "latest_of_hot_key": (q_latest_of_hot_key, SQL_LATEST_OF_HOT_KEY),
    "silver_layer": (q_silver_layer, SQL_SILVER_LAYER),
    "tsv_plain_documents": (q_tsv_plain_documents, SQL_TSV_ROUNDTRIP_DOCUMENTS),
    "tsv_roundtrip_documents": (q_tsv_roundtrip_documents, SQL_TSV_ROUNDTRIP_DOCUMENTS),
    "schema_mismatch": (q_schema_mismatch, SQL_SCHEMA_MISMATCH),
    "value_freq_typed": (q_value_freq_typed, SQL_VALUE_FREQ_TYPED),
    "topn_other_real": (q_topn_other_real, SQL_TOPN_OTHER_REAL),
    "output_checks": (q_output_checks, SQL_OUTPUT_CHECKS),
    "staging_cast_safe": (q_staging_cast_safe, SQL_STAGING_CAST_SAFE),
    "warehouse_mart": (q_warehouse_mart, SQL_WAREHOUSE_MART),
    "bucketed_table": (q_bucketed_table, SQL_BUCKETED_TABLE),
    "product_fact": (q_product_fact, SQL_PRODUCT_FACT),
    "additions_mart": (q_additions_mart, SQL_ADDITIONS_MART),
    "sample_rows": (q_sample_rows, SQL_SAMPLE_ROWS),
    "profile_sample_rows": (q_profile_sample_rows, SQL_PROFILE_SAMPLE_ROWS),
    "profile_history": (q_profile_history, SQL_PROFILE_HISTORY),
    "heavy_hitters": (q_heavy_hitters, SQL_HEAVY_HITTERS),
    "heavy_hitters_events": (q_heavy_hitters_events, SQL_HEAVY_HITTERS_EVENTS),
    "footer_stats": (q_footer_stats, SQL_FOOTER_STATS),
    "refresh_partitions": (q_refresh_partitions, SQL_REFRESH_PARTITIONS),
    "warehouse_view": (q_warehouse_view, SQL_WAREHOUSE_VIEW),
}
