"""Queries: scans, sinks and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlark.catalog.registry import on_trips, r, register, rnd, round_all
from gridlark.functions.domain import CLASSES, STOPOVERS
from gridlark.operators import cleaning as C
from gridlark.operators.columns import nan_to_null, numeric_columns, string_columns
from gridlark.plans.features import drop_leaks, outside_domain, prefixed, request_errors
from gridlark.plans.trips import trips
from gridlark.functions.calendar import temporal_features
from gridlark.sources.csv import read_csv
from gridlark.sources.fares import production_names, read_fares
from gridlark.sources.metrics import write_csv, write_json, write_split
from gridlark.sources.shared import shared_folder
from gridlark.sources.tables import read_table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
KEYS_SQL = ", ".join(KEYS)
SPLIT_HASH = "(l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + 42)"


def new_folder(spark, name: str) -> str:
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@register(
    "scan_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
)
def scan_tables(spark, d):
    counts = [
        read_table(spark, d, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in TABLES
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


CSV_COLUMNS = (*KEYS, "airline", "class", "departure_ts", "days_before", "duration_hrs", "total_fare")


@register("csv_round_trip", on_trips(f"SELECT {', '.join(CSV_COLUMNS)} FROM trips"))
def csv_round_trip(spark, d):
    """CSV sink and CSV source with a given schema."""
    rows = trips(spark, d).select(*CSV_COLUMNS)
    path = new_folder(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@register(
    "csv_dialect",
    """SELECT p_retailprice, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS kind,
      concat('a "', p_name, '", ', p_brand) AS label, p_partkey FROM part""",
)
def csv_dialect(spark, d):
    """Quotes, separators and missing marks in fields; columns in another order than the header's."""
    part = read_table(spark, d, "part").select(
        "p_partkey",
        F.concat(F.lit('a "'), "p_name", F.lit('", '), "p_brand").alias("label"),
        F.when(F.col("p_partkey") % 7 == 0, "NA").otherwise(F.col("p_type")).alias("kind"),
        "p_retailprice",
    )
    path = new_folder(spark, "csv")
    write_csv(part, path)
    return read_csv(spark, path, part.select("p_retailprice", "kind", "label", "p_partkey").schema)


@register(
    "csv_quoted_breaks",
    """SELECT o_orderkey, o_totalprice, o_orderpriority || chr(10) || '"' || CAST(o_custkey AS VARCHAR) || '"' || repeat(chr(10), CAST(o_orderkey % 4 AS BIGINT)) || '.' AS note
    FROM orders""",
)
def csv_quoted_breaks(spark, d):
    """Notes with line breaks and quotes through the CSV sink and the scan by ranges."""
    note = F.concat(
        "o_orderpriority", F.lit('\n"'), F.col("o_custkey").cast("string"), F.lit('"'),
        F.repeat(F.lit("\n"), (F.col("o_orderkey") % 4).cast("int")), F.lit("."),
    )
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", note.alias("note"))
    path = new_folder(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, multi_line=True)


@register(
    "csv_inferred_schema",
    on_trips(
        f"SELECT class, count(*) AS n, count(duration_hrs) AS n_duration, {r('sum(total_fare)', 2)} AS fare "
        "FROM trips GROUP BY class"
    ),
)
def csv_inferred_schema(spark, d):
    """CSV source that infers its types, then an aggregate."""
    path = new_folder(spark, "csv")
    write_csv(trips(spark, d).select("class", "duration_hrs", "total_fare"), path)
    return read_csv(spark, path).groupBy("class").agg(
        F.count("*").alias("n"), F.count("duration_hrs").alias("n_duration"), rnd(F.sum("total_fare"), 2).alias("fare")
    )


_FARE_COLUMNS = ("airline", "source", "destination", "departure_ts", "arrival_ts", "duration_hrs", "stopovers", "class", "booking_source", "base_fare", "tax", "total_fare")


@register(
    "production_csv",
    on_trips(
        f"""SELECT {', '.join(_FARE_COLUMNS)}, days_before::BIGINT AS days_before, NULL::VARCHAR AS source_name, NULL::VARCHAR AS destination_name,
        NULL::VARCHAR AS aircraft_type, NULL::VARCHAR AS seasonality FROM trips"""
    ),
)
def production_csv(spark, d):
    """All trips as a CSV file with the production titles, read back under short names."""
    path = new_folder(spark, "fares")
    write_csv(production_names(trips(spark, d, located=True)), path)
    return read_fares(spark, path)


@register(
    "json_round_trip",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def json_round_trip(spark, d):
    """JSON sink and source."""
    rows = read_table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    path = new_folder(spark, "json")
    write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@register(
    "split_sink",
    on_trips(f"SELECT {SPLIT_HASH} % 1000 < 200 AS is_test, count(*) AS n FROM trips GROUP BY 1"),
)
def split_sink(spark, d):
    """Train and test rows written as partitions of one table and counted again."""
    marked = trips(spark, d).withColumn("is_test", F.expr(f"{SPLIT_HASH} % 1000 < 200"))
    path = new_folder(spark, "split")
    write_split(marked, path)
    return spark.read.schema(marked.schema).parquet(path).groupBy("is_test").agg(F.count("*").alias("n"))


@register("row_gate", "SELECT count(*) AS n_rows, count(*) >= 1000 AS ok FROM lineitem")
def row_gate(spark, d):
    return C.row_gate(read_table(spark, d, "lineitem"), 1000)


DEDUP_COLUMNS = (*KEYS, "airline", "segment", "departure_ts", "total_fare")
DEDUP_SQL = ", ".join(DEDUP_COLUMNS)
WITH_COPIES = (
    f"copied AS (SELECT {DEDUP_SQL} FROM trips UNION ALL SELECT {DEDUP_SQL} FROM trips WHERE l_orderkey % 50 = 0)"
)


def with_copies(spark, d):
    rows = trips(spark, d).select(*DEDUP_COLUMNS)
    return rows.unionByName(rows.where("l_orderkey % 50 = 0"))


@register("drop_duplicates", on_trips(f"SELECT DISTINCT {DEDUP_SQL} FROM copied", WITH_COPIES))
def drop_duplicates(spark, d):
    return C.drop_duplicates(with_copies(spark, d))


@register(
    "duplicate_report",
    on_trips(
        f"""SELECT n_rows AS "rows", n_rows - n_distinct AS removed,
        {r('(n_rows - n_distinct) * 100.0 / n_rows')} AS removed_pct
        FROM (SELECT count(*) AS n_rows FROM copied), (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT * FROM copied))""",
        WITH_COPIES,
    ),
)
def duplicate_report(spark, d):
    return round_all(C.duplicate_report(with_copies(spark, d)))


FILL_COLUMNS = (*KEYS, "airline", "segment", "duration_hrs", "total_fare")


def _to_fill(spark, d):
    """Gaps in two text columns and a number, and two columns without any value."""
    return trips(spark, d).select(
        *FILL_COLUMNS, F.lit(None).cast("string").alias("no_text"), F.lit(None).cast("double").alias("no_number")
    )


def _mode_sql(column: str) -> str:
    return f"(SELECT {column} FROM trips WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _fill_sql(number: str, airline: str, segment: str, no_number: str) -> str:
    return on_trips(
        f"""SELECT DISTINCT {KEYS_SQL}, coalesce(airline, {airline}) AS airline, coalesce(segment, {segment}) AS segment,
        {r(f'coalesce(duration_hrs, {number})', 6)} AS duration_hrs, total_fare, 'Unknown' AS no_text,
        {no_number} AS no_number FROM trips"""
    )


def _fill(spark, d, numerical, categorical):
    filled = C.fill_missing(_to_fill(spark, d), {"numerical": numerical, "categorical": categorical})
    return filled.withColumn("duration_hrs", rnd("duration_hrs", 6))


@register(
    "fill_median_mode",
    _fill_sql(
        "(SELECT quantile_cont(duration_hrs, 0.5) FROM trips)", _mode_sql("airline"), _mode_sql("segment"), "CAST(NULL AS DOUBLE)"
    ),
)
def fill_median_mode(spark, d):
    return _fill(spark, d, "median", "mode")


@register(
    "fill_mean_unknown",
    _fill_sql("(SELECT avg(duration_hrs) FROM trips)", "'Unknown'", "'Unknown'", "CAST(NULL AS DOUBLE)"),
)
def fill_mean_unknown(spark, d):
    return _fill(spark, d, "mean", "constant")


@register("fill_zero_mode", _fill_sql("0.0", _mode_sql("airline"), _mode_sql("segment"), "CAST(0.0 AS DOUBLE)"))
def fill_zero_mode(spark, d):
    return _fill(spark, d, "zero", "mode")


FLOW_COLUMNS = ("class", "stopovers", "segment", "duration_hrs")
FLOW_SQL = ", ".join(FLOW_COLUMNS)
FLOW_CTES = (
    f"kept AS (SELECT DISTINCT {FLOW_SQL} FROM trips)",
    """filled AS (SELECT DISTINCT class, stopovers,
       coalesce(segment, (SELECT segment FROM kept WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS segment,
       coalesce(duration_hrs, (SELECT quantile_cont(duration_hrs, 0.5) FROM kept)) AS duration_hrs FROM kept)""",
)


@register("clean_flow", on_trips(f"SELECT {FLOW_SQL} FROM filled", *FLOW_CTES))
def clean_flow(spark, d):
    """De-duplicate, fill, de-duplicate: rows that the filling made equal go as well."""
    return C.clean(trips(spark, d).select(*FLOW_COLUMNS))


@register(
    "cleaning_report",
    on_trips(
        """SELECT 'loaded' AS step, count(*) AS "rows" FROM trips UNION ALL SELECT 'unique', count(*) FROM kept
        UNION ALL SELECT 'filled', count(*) FROM filled""",
        *FLOW_CTES,
    ),
)
def cleaning_report(spark, d):
    return C.cleaning_report(trips(spark, d).select(*FLOW_COLUMNS))


BAD_DATES = (
    "dated AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, total_fare, "
    "CASE WHEN l_orderkey % 19 = 0 THEN 'invalid' WHEN l_orderkey % 23 = 0 THEN NULL "
    "ELSE CAST(departure_ts AS VARCHAR) END AS departure_text FROM trips)"
)


def bad_dates(spark, d):
    text = (
        F.when(F.col("l_orderkey") % 19 == 0, "invalid")
        .when(F.col("l_orderkey") % 23 == 0, F.lit(None))
        .otherwise(F.col("departure_ts").cast("string"))
    )
    return trips(spark, d).select(*KEYS, "total_fare", text.alias("departure_text"))


@register(
    "parse_dates",
    on_trips(
        f"SELECT {KEYS_SQL}, total_fare, try_cast(departure_text AS TIMESTAMP) AS departure_text FROM dated", BAD_DATES
    ),
)
def parse_dates(spark, d):
    return C.parse_dates(bad_dates(spark, d), ["departure_text", "absent"])


@register(
    "date_failures",
    on_trips(
        """SELECT 'departure_text' AS "column", count(*) AS failed FROM dated
        WHERE departure_text IS NOT NULL AND try_cast(departure_text AS TIMESTAMP) IS NULL""",
        BAD_DATES,
    ),
)
def date_failures(spark, d):
    return C.date_failures(bad_dates(spark, d), ["departure_text"])


SIGNED = (
    "signed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 23 = 0 THEN -total_fare "
    "WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN total_fare * 100 ELSE total_fare END AS fare FROM trips)"
)


def signed(spark, d):
    key, fare = F.col("l_orderkey"), F.col("total_fare")
    value = (
        F.when(key % 23 == 0, -fare).when(key % 29 == 0, F.lit(None)).when(key % 31 == 0, fare * 100).otherwise(fare)
    )
    return trips(spark, d).select(*KEYS, value.alias("fare"))


@register("drop_below", on_trips("SELECT * FROM signed WHERE NOT coalesce(fare < 0, false)", SIGNED))
def drop_below(spark, d):
    return C.drop_below(signed(spark, d), "fare", 0)


_BOUNDS = "SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events"


@register(
    "outlier_bounds",
    f"SELECT {r('q1')} AS q1, {r('q3')} AS q3, {r('CASE WHEN q3 > q1 THEN q3 + 3 * (q3 - q1) END')} AS upper FROM ({_BOUNDS})",
)
def outlier_bounds(spark, d):
    return round_all(C.outlier_bounds(read_table(spark, d, "events"), "value"))


@register(
    "drop_high_outliers",
    f"""SELECT event_id, event_type, value FROM events, ({_BOUNDS})
    WHERE NOT coalesce(q3 > q1 AND value > q3 + 3 * (q3 - q1), false)""",
)
def drop_high_outliers(spark, d):
    return C.drop_high_outliers(read_table(spark, d, "events").select("event_id", "event_type", "value"), "value")


@register(
    "fix_invalid_values",
    on_trips(
        """SELECT positive.* FROM positive, (SELECT quantile_cont(fare, 0.25) AS q1, quantile_cont(fare, 0.75) AS q3 FROM positive)
        WHERE NOT coalesce(q3 > q1 AND fare > q3 + 3 * (q3 - q1), false)""",
        SIGNED,
        "positive AS (SELECT * FROM signed WHERE NOT coalesce(fare < 0, false))",
    ),
)
def fix_invalid_values(spark, d):
    return C.fix_invalid_values(signed(spark, d), "fare")


@register(
    "cap_at_quantile",
    "SELECT event_id, value FROM events WHERE value <= (SELECT quantile_cont(value, 0.999) FROM events)",
)
def cap_at_quantile(spark, d):
    return C.cap_at_quantile(read_table(spark, d, "events").select("event_id", "value"), "value")


_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(trim({0}), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
    "lambda w: upper(w[1]) || lower(w[2:])), '')"
)


@register(
    "standardize_text",
    "SELECT p_partkey, "
    + _TITLE.format("'  ' || CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name || '''s-' || p_brand END || ' '")
    + " AS dirty FROM part",
)
def standardize_text(spark, d):
    dirty = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(
        F.concat("p_name", F.lit("'s-"), F.col("p_brand"))
    )
    rows = read_table(spark, d, "part").select("p_partkey", F.concat(F.lit("  "), dirty, F.lit(" ")).alias("dirty"))
    return C.standardize_text(C.standardize_text(rows, "dirty"), "p_partkey")


@register("drop_columns", "SELECT event_id, user_id, ts, value FROM events")
def drop_columns(spark, d):
    return C.drop_columns(read_table(spark, d, "events"), ["event_type", "props", "absent"])


@register(
    "drop_leaks",
    on_trips(f"SELECT {KEYS_SQL}, class, total_fare FROM trips"),
)
def leaks_dropped(spark, d):
    return drop_leaks(trips(spark, d).select(*KEYS, "class", "base_fare", "tax", "total_fare"))


@register(
    "prefix_columns",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS "Dep_month", CAST(day(o_orderdate) AS INT) AS "Dep_day",
    CAST(isodow(o_orderdate) - 1 AS INT) AS "Dep_weekday" FROM orders""",
)
def prefix_columns(spark, d):
    parts = temporal_features(read_table(spark, d, "orders"), "o_orderdate")
    return prefixed(parts.select("o_orderkey", "month", "day", "weekday"), ["month", "day", "weekday", "absent"], "Dep_")


@register(
    "clean_names",
    on_trips(
        f'SELECT {KEYS_SQL}, departure_ts AS "Departure_Date_Time", base_fare AS "Base_Fare_BDT", '
        'total_fare AS "Total_Fare_BDT" FROM trips'
    ),
)
def clean_names(spark, d):
    rows = trips(spark, d).select(
        *KEYS,
        F.col("departure_ts").alias("Departure Date & Time"),
        F.col("base_fare").alias("_Base Fare__(BDT)"),
        F.col("total_fare").alias("Total Fare (BDT)"),
    )
    return C.with_clean_names(rows)


@register(
    "select_by_type",
    """SELECT 'number' AS kind, count(l_orderkey) AS rows_seen, 8 AS n_columns FROM lineitem
    UNION ALL SELECT 'text', count(l_returnflag), 2 FROM lineitem""",
)
def select_by_type(spark, d):
    rows = read_table(spark, d, "lineitem")
    numbers, texts = rows.select(*numeric_columns(rows)), rows.select(*string_columns(rows))
    return numbers.agg(F.count(numbers.columns[0]).alias("rows_seen")).select(
        F.lit("number").alias("kind"), "rows_seen", F.lit(len(numbers.columns)).alias("n_columns")
    ).unionByName(
        texts.agg(F.count(texts.columns[0]).alias("rows_seen")).select(
            F.lit("text").alias("kind"), "rows_seen", F.lit(len(texts.columns)).alias("n_columns")
        )
    )


@register(
    "nan_to_null",
    """SELECT event_type, count(*) AS n, count(value) FILTER (event_id % 7 <> 0) AS present,
    (round(avg(value) FILTER (event_id % 7 <> 0), 4) + 0.0) AS mean FROM events GROUP BY event_type""",
)
def nan_nulled(spark, d):
    rows = read_table(spark, d, "events").withColumn(
        "value", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    )
    return nan_to_null(rows).groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("value").alias("present"), rnd(F.avg("value")).alias("mean")
    )


@register(
    "request_errors",
    on_trips(
        f"""SELECT {KEYS_SQL}, concat_ws('; ', CASE WHEN source = destination THEN 'source equals destination' END,
        CASE WHEN arrival_ts <= departure_ts THEN 'arrival not after departure' END,
        CASE WHEN departure_ts < TIMESTAMP '1998-01-01' THEN 'departure in the past' END) AS errors FROM trips"""
    ),
)
def request_checks(spark, d):
    rows = trips(spark, d, located=True).select(*KEYS, "source", "destination", "departure_ts", "arrival_ts")
    checked = request_errors(rows, F.lit("1998-01-01").cast("timestamp_ntz"))
    return checked.select(*KEYS, F.array_join("errors", "; ").alias("errors"))


@register(
    "domain_membership",
    on_trips(
        f"""SELECT {KEYS_SQL}, coalesce(class IN ('Economy', 'Business', 'First Class'), false) AS class_known,
        coalesce(stopovers IN ('Direct', '1 Stop', '2 Stops'), false) AS stopovers_known FROM trips"""
    ),
)
def domain_membership(spark, d):
    checked = outside_domain(trips(spark, d), {"class": CLASSES, "stopovers": STOPOVERS})
    return checked.select(*KEYS, "class_known", "stopovers_known")


@register(
    "features_and_label",
    on_trips(f"SELECT {KEYS_SQL}, class, total_fare AS label FROM trips"),
)
def features_and_label(spark, d):
    return C.features_and_label(trips(spark, d).select(*KEYS, "total_fare", "class"), "total_fare")
