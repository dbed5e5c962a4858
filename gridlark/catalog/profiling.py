"""Queries: profiling, correlations, chart data, insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlark.catalog.cleaning import new_folder
from gridlark.catalog.registry import on_trips, r, register, rnd, round_all
from gridlark.operators import association as A
from gridlark.operators import charts as H
from gridlark.operators import profiling as P
from gridlark.operators import states as S
from gridlark.operators.columns import long_form
from gridlark.operators.insights import insights
from gridlark.operators.lookup import in_top_categories
from gridlark.operators.ranking import approximate_quantiles
from gridlark.plans.trips import trips
from gridlark.sources.shared import materialize
from gridlark.sources.tables import read_table

# All columns of the trips, and a boolean one.
NUMBERS = {
    "l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint", "src_lat": "double", "src_lon": "double",
    "dst_lat": "double", "dst_lon": "double", "days_before": "int", "duration_hrs": "double", "base_fare": "double", "tax": "double", "total_fare": "double",
}
DATES = {"departure_ts": "timestamp_ntz", "arrival_ts": "timestamp_ntz"}
TEXTS = {c: "string" for c in ("airline", "source", "destination", "stopovers", "class", "booking_source", "segment")} | {"direct": "boolean"}
COLUMNS = NUMBERS | DATES | TEXTS
DIRECT_SQL = "everything AS (SELECT *, stopovers = 'Direct' AS direct FROM trips)"


def everything(spark, d):
    return trips(spark, d, located=True).withColumn("direct", F.col("stopovers") == "Direct")


def _null_row(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", '{COLUMNS[column]}' AS dtype, count(*) AS n_rows, {len(COLUMNS)} AS n_columns, "
        f"count(*) - count({column}) AS nulls, {r(f'(count(*) - count({column})) * 100.0 / count(*)')} AS null_pct FROM everything"
    )


INFO_SQL = " UNION ALL ".join(_null_row(c) for c in COLUMNS)


@register("dataset_info", on_trips(INFO_SQL, DIRECT_SQL))
def dataset_info(spark, d):
    return round_all(P.dataset_info(everything(spark, d)))


@register(
    "missing_report",
    on_trips(f'SELECT "column", nulls AS missing, null_pct AS missing_pct FROM ({INFO_SQL}) WHERE nulls > 0', DIRECT_SQL),
)
def missing_report(spark, d):
    return round_all(P.missing_report(everything(spark, d)))


def _number_row(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS "count", {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
      {r(f'min({c})::DOUBLE')} AS min, {r(f'quantile_cont({c}::DOUBLE, 0.25)')} AS q25, {r(f'quantile_cont({c}::DOUBLE, 0.5)')} AS median,
      {r(f'quantile_cont({c}::DOUBLE, 0.75)')} AS q75, {r(f'max({c})::DOUBLE')} AS max FROM everything"""


def _date_row(c: str) -> str:
    quarters = ", ".join(f"quantile_cont({c}, {p}) AS {name}_at" for name, p in P.QUARTERS.items())
    return f"""SELECT '{c}' AS "column", count({c}) AS "count", make_timestamp(CAST(round(avg(epoch_us({c})) / 1e6) AS BIGINT) * 1000000) AS mean_at,
      min({c}) AS min_at, {quarters}, max({c}) AS max_at FROM everything"""


def _text_row(c: str) -> str:
    return f"""SELECT '{c}' AS "column", (SELECT count({c}) FROM everything) AS "count", (SELECT count(DISTINCT {c}) FROM everything) AS "unique",
      CAST({c} AS VARCHAR) AS top, n AS freq FROM (SELECT {c}, count(*) AS n FROM everything WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"""


_DESCRIBE = (
    DIRECT_SQL,
    "numbers AS (" + " UNION ALL ".join(_number_row(c) for c in NUMBERS) + ")",
    "dates AS (" + " UNION ALL ".join(_date_row(c) for c in DATES) + ")",
    "texts AS (" + " UNION ALL ".join(_text_row(c) for c in TEXTS) + ")",
)


@register("describe_numeric", on_trips("SELECT * FROM numbers", *_DESCRIBE))
def describe_numeric(spark, d):
    return round_all(P.describe_numeric(everything(spark, d)))


@register("describe_dates", on_trips("SELECT * FROM dates", *_DESCRIBE))
def describe_dates(spark, d):
    return P.describe_dates(everything(spark, d))


@register("describe_text", on_trips("SELECT * FROM texts", *_DESCRIBE))
def describe_text(spark, d):
    return P.describe_text(everything(spark, d))


_NUMBER_FIELDS = ("mean", "std", "min", "q25", "median", "q75", "max")


@register(
    "basic_statistics",
    on_trips(
        f"""SELECT coalesce(n."column", d."column", t."column") AS "column", coalesce(n."count", d."count", t."count") AS "count",
        {", ".join(_NUMBER_FIELDS)}, {", ".join(P.DATE_FIELDS)}, "unique", top, freq
        FROM numbers n FULL JOIN dates d ON n."column" = d."column" FULL JOIN texts t ON t."column" = n."column" """,
        *_DESCRIBE,
    ),
)
def basic_statistics(spark, d):
    # Numbers, dates and texts are read one after the other: the join is made once.
    return round_all(P.basic_statistics(materialize(everything(spark, d))))


_DISTINCT = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"unique\" FROM everything" for c in COLUMNS)


@register("distinct_counts", on_trips(_DISTINCT, DIRECT_SQL))
def distinct_counts(spark, d):
    return P.distinct_counts(everything(spark, d))


@register(
    "descriptive_statistics",
    on_trips(
        f"""SELECT i."column", i.dtype, i.nulls AS missing, (round_even(i.nulls * 100.0 / i.n_rows, 2) + 0.0) AS missing_pct,
        coalesce(n."count", e."count", t."count", 0) AS "count", {", ".join(f"n.{f}" for f in _NUMBER_FIELDS)},
        {", ".join(f"e.{f}" for f in P.DATE_FIELDS)}, t.top, t.freq, u."unique"
        FROM ({INFO_SQL}) i LEFT JOIN numbers n ON n."column" = i."column" LEFT JOIN dates e ON e."column" = i."column"
        LEFT JOIN texts t ON t."column" = i."column" LEFT JOIN ({_DISTINCT}) u ON u."column" = i."column" """,
        *_DESCRIBE,
    ),
)
def descriptive_statistics(spark, d):
    return round_all(P.descriptive_statistics(materialize(everything(spark, d))))


STATE_NUMBERS = ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
STATE_TEXTS = ("l_returnflag",)


def _state_row(c: str, number: bool) -> str:
    facts = (f"{r(f'avg({c})')}", f"{r(f'stddev_samp({c})')}", f"{r(f'min({c})::DOUBLE')}", f"{r(f'max({c})::DOUBLE')}") if number else ("NULL::DOUBLE",) * 4
    return f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS nulls, count({c}) AS "count", {facts[0]} AS mean,
      {facts[1]} AS std, {facts[2]} AS min, {facts[3]} AS max, {'true' if number else 'NULL::BOOLEAN'} AS quartiles_within, true AS distinct_within FROM lines"""


@register(
    "incremental_profile",
    "WITH lines AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity) FROM lineitem) "
    + " UNION ALL ".join(_state_row(c, c in STATE_NUMBERS) for c in (*STATE_NUMBERS, *STATE_TEXTS)),
)
def incremental_profile(spark, d):
    """Profiles of four parts, stored one by one and merged; the sketches are held against the whole table."""
    lines = read_table(spark, d, "lineitem").select(*STATE_NUMBERS, *STATE_TEXTS)
    lines = lines.withColumn("l_quantity", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")))
    folder = new_folder(spark, "profile")
    for part in range(4):
        S.write_state(S.profile_state(lines.where(F.col("l_orderkey") % 4 == part)), folder, str(part))
    merged = S.merged_profile(S.read_states(spark, folder))
    # One row per column and quartile.
    quarters = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(name).alias("q")) for name, p in P.QUARTERS.items()]))
    asked = merged.where("min IS NOT NULL").select("column", "count", quarters.alias("at")).select("column", "count", "at.*")
    values = long_form(lines, STATE_NUMBERS, "double").where("value IS NOT NULL")
    ranks = values.join(F.broadcast(asked), "column").groupBy("column", "count", "p", "q").agg(
        F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto")
    )
    slack = S.RANK_ERROR * F.col("count") + 1
    near = (F.col("below") <= F.col("p") * F.col("count") + slack) & (F.col("upto") >= F.col("p") * F.col("count") - slack)
    within = ranks.groupBy("column").agg(F.min(near).alias("quartiles_within"))
    distinct = P.distinct_counts(lines).withColumnRenamed("unique", "exact")
    out = merged.join(F.broadcast(within), "column", "left").join(F.broadcast(distinct), "column")
    close = F.abs(F.col("distinct") - F.col("exact")) <= 0.03 * F.col("exact") + 1
    return round_all(out.select("column", "n_rows", "nulls", "count", "mean", "std", "min", "max", "quartiles_within", close.alias("distinct_within")))


@register(
    "distribution",
    f"""SELECT {r('avg(value)')} AS mean, {r('quantile_cont(value, 0.5)')} AS median, {r('stddev_samp(value)')} AS std,
    {r('min(value)')} AS min, {r('max(value)')} AS max, {r('quantile_cont(value, 0.25)')} AS q25, {r('quantile_cont(value, 0.75)')} AS q75,
    {r('quantile_cont(value, 0.75) - quantile_cont(value, 0.25)')} AS iqr, {r('skewness(value)')} AS skewness,
    {r('kurtosis(value)')} AS kurtosis FROM events""",
)
def distribution(spark, d):
    return round_all(P.distribution(read_table(spark, d, "events"), "value"))


@register(
    "category_frequency",
    on_trips(
        f"""SELECT airline AS category, count(*) AS "count", {r('count(*) * 100.0 / (SELECT count(*) FROM trips)')} AS percentage
        FROM trips WHERE airline IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    ),
)
def category_frequency(spark, d):
    return P.category_frequency(trips(spark, d), "airline", 10, digits=4)


@register(
    "value_counts",
    "SELECT event_type AS category, count(*) AS \"count\" FROM events WHERE event_type IS NOT NULL GROUP BY 1",
)
def value_counts(spark, d):
    return P.category_counts(read_table(spark, d, "events"), "event_type")


@register(
    "top_counts",
    on_trips("SELECT airline AS category, count(*) AS \"count\" FROM trips WHERE airline IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"),
)
def top_counts(spark, d):
    return H.top_counts(trips(spark, d), "airline")


@register(
    "in_top_categories",
    on_trips(
        """SELECT l_orderkey, l_linenumber, airline, total_fare FROM trips WHERE airline IN
        (SELECT airline FROM trips WHERE airline IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"""
    ),
)
def top_semi_join(spark, d):
    rows = trips(spark, d).select("l_orderkey", "l_linenumber", "airline", "total_fare")
    return in_top_categories(rows, "airline", P.top_categories(rows, "airline", 10))


def _group_stats(group: str, name: str, extremes: bool = True, value: str = "total_fare") -> str:
    ends = f", {r(f'min({value})')} AS min, {r(f'max({value})')} AS max" if extremes else ""
    return f"""SELECT {group} AS {name}, count({value}) AS "count", {r(f'avg({value})')} AS mean,
      {r(f'quantile_cont({value}, 0.5)')} AS median, {r(f'stddev_samp({value})')} AS std{ends} FROM trips
      WHERE {group} IS NOT NULL GROUP BY 1"""


def target_by_class(spark, d):
    """Flagship: fares by travel class."""
    return round_all(P.target_by_category(trips(spark, d), "total_fare", "class", digits=None, few_groups=True))


register("target_by_class", on_trips(_group_stats("class", "class")))(target_by_class)


@register("target_by_airline", on_trips(_group_stats("airline", "airline")))
def target_by_airline(spark, d):
    return round_all(P.target_by_category(trips(spark, d), "total_fare", "airline", digits=None))


_SEASON = (
    "CASE WHEN month(departure_ts) IN (12, 1, 2) THEN 'Winter' WHEN month(departure_ts) IN (3, 4, 5) THEN 'Spring' "
    "WHEN month(departure_ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
)


@register("trend_by_month", on_trips(_group_stats("CAST(month(departure_ts) AS INT)", '"group"', False)))
def trend_by_month(spark, d):
    return round_all(P.temporal_trend(trips(spark, d), "total_fare", "departure_ts", "month", digits=None))


@register("trend_by_weekday", on_trips(_group_stats("CAST(isodow(departure_ts) - 1 AS INT)", '"group"', False)))
def trend_by_weekday(spark, d):
    return round_all(P.temporal_trend(trips(spark, d), "total_fare", "departure_ts", "weekday", digits=None))


@register("trend_by_season", on_trips(_group_stats(_SEASON, '"group"', False)))
def trend_by_season(spark, d):
    return round_all(P.temporal_trend(trips(spark, d), "total_fare", "departure_ts", "season", digits=None))


@register(
    "lead_time_profile",
    on_trips(
        f"""SELECT CASE WHEN days_before <= 7 THEN '0-7' WHEN days_before <= 14 THEN '8-14' ELSE '15+' END AS lead,
        count(total_fare) AS "count", {r('avg(total_fare)')} AS mean,
        {r('avg(total_fare) / (SELECT avg(total_fare) FROM trips)')} AS ratio FROM trips GROUP BY 1"""
    ),
)
def lead_time_profile(spark, d):
    return round_all(P.lead_time_profile(trips(spark, d), "total_fare", "days_before", digits=4))


def _premium(expression: str, name: str) -> str:
    return on_trips(
        f"""SELECT {expression} AS {name}, count(total_fare) AS "count", {r('avg(total_fare)')} AS mean,
        {r('avg(total_fare) / (SELECT avg(total_fare) FROM trips)')} AS ratio FROM trips WHERE {expression} IS NOT NULL GROUP BY 1"""
    )


@register("premium_by_class", _premium("class", "class"))
def premium_by_class(spark, d):
    return P.premium_by(trips(spark, d), "total_fare", "class", digits=4)


@register("premium_by_airline", _premium("airline", "airline"))
def premium_by_airline(spark, d):
    return P.premium_by(trips(spark, d), "total_fare", "airline", digits=4)


@register("premium_by_weekend", _premium("CAST(isodow(departure_ts) >= 6 AS INT)", "weekend"))
def premium_by_weekend(spark, d):
    weekend = (F.weekday("departure_ts") >= 5).cast("int")
    return P.premium_by(trips(spark, d).withColumn("weekend", weekend), "total_fare", "weekend", digits=4)


@register("premium_by_season", _premium(_SEASON, "season"))
def premium_by_season(spark, d):
    from gridlark.functions.calendar import season

    rows = trips(spark, d).withColumn("season", season(F.month("departure_ts")))
    return P.premium_by(rows, "total_fare", "season", digits=4)


CORRELATED = ("duration_hrs", "base_fare", "tax", "total_fare")


def _pair_rows(formula) -> str:
    rows = []
    for i, a in enumerate(CORRELATED):
        for b in CORRELATED[i + 1 :]:
            rows.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(formula(a, b), 6)} AS r FROM trips")
    return " UNION ALL ".join(rows)


_PEARSON = f"pairs AS ({_pair_rows(lambda a, b: f'corr({a}, {b})')})"
_MATRIX = (
    "matrix AS (SELECT column_a, column_b, r FROM pairs UNION ALL SELECT column_b, column_a, r FROM pairs UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in CORRELATED)
    + ")"
)


@register("correlation_matrix", on_trips("SELECT * FROM matrix", _PEARSON, _MATRIX))
def correlation_matrix(spark, d):
    return round_all(A.correlation_matrix(trips(spark, d), "pearson", CORRELATED), 6)


@register("strong_pairs", on_trips("SELECT * FROM pairs WHERE abs(r) > 0.8", _PEARSON))
def strong_pairs(spark, d):
    return round_all(A.strong_pairs(trips(spark, d), columns=CORRELATED), 6)


def _heat_cell(c: str) -> str:
    return f"(round_even(max(r) FILTER (column_b = '{c}'), 2) + 0.0) AS {c}"


@register(
    "heatmap",
    on_trips(
        f"SELECT column_a AS \"column\", {', '.join(_heat_cell(c) for c in CORRELATED)} FROM matrix GROUP BY 1", _PEARSON, _MATRIX
    ),
)
def heatmap(spark, d):
    return A.heatmap(trips(spark, d), CORRELATED)


def _spearman(a: str, b: str) -> str:
    def rank(x: str) -> str:
        return f"rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0"

    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, {r('corr(u, v)', 6)} AS r FROM
      (SELECT {rank(a)} AS u, {rank(b)} AS v FROM trips WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


SPEARMAN = ("days_before", "duration_hrs", "total_fare")
_SPEARMAN = " UNION ALL ".join(_spearman(a, b) for i, a in enumerate(SPEARMAN) for b in SPEARMAN[i + 1 :])


@register("spearman_pairs", on_trips(_SPEARMAN))
def spearman_pairs(spark, d):
    return round_all(A.correlation_pairs(trips(spark, d), "spearman", SPEARMAN), 6)


def _kendall(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, {r('sum(sa * sb) / sqrt(sum(sa * sa) * sum(sb * sb))', 6)} AS r FROM
      (SELECT sign(x.{a} - y.{a})::DOUBLE AS sa, sign(x.{b} - y.{b})::DOUBLE AS sb FROM part x, part y)"""


KENDALL = ("p_partkey", "p_size", "p_retailprice")
_KENDALL = " UNION ALL ".join(_kendall(a, b) for i, a in enumerate(KENDALL) for b in KENDALL[i + 1 :])


@register("kendall_pairs", _KENDALL)
def kendall_pairs(spark, d):
    return round_all(A.correlation_pairs(read_table(spark, d, "part"), "kendall", KENDALL), 6)


_LIMITS = "(SELECT min(value) AS lo, max(value) AS hi FROM {t})"


def _binned(table: str, bins: int) -> str:
    """Rows per bin; a value on an edge belongs to the bin that starts there."""
    return f"""(SELECT CASE WHEN value < lo + step * g THEN g - 1 WHEN g < {bins - 1} AND value >= lo + step * (g + 1) THEN g + 1 ELSE g END AS bin,
      count(*) AS n FROM (SELECT value, lo, step, least(floor((value - lo) / step), {bins - 1})::INT AS g FROM {table},
      (SELECT min(value) AS lo, (max(value) - min(value)) / {bins} AS step FROM {table}) WHERE value IS NOT NULL) GROUP BY 1)"""


def _histogram(table: str, bins: int) -> str:
    return f"""SELECT b.bin, {r(f'lo + (hi - lo) / {bins} * b.bin')} AS low, {r(f'lo + (hi - lo) / {bins} * (b.bin + 1)')} AS high,
      coalesce(n, 0) AS "count" FROM (SELECT unnest(range({bins}))::INT AS bin) b, {_LIMITS.format(t=table)}
      LEFT JOIN {_binned(table, bins)} c ON c.bin = b.bin"""


@register("histogram", _histogram("events", 30))
def histogram(spark, d):
    return round_all(H.histogram(read_table(spark, d, "events"), "value", 30))


@register(
    "center_lines",
    f"SELECT {r('avg(value)')} AS mean, {r('quantile_cont(value, 0.5)')} AS median FROM events",
)
def center_lines(spark, d):
    return round_all(H.center_lines(read_table(spark, d, "events"), "value"))


POINT_HASH = "(l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 1299709)"
# A prediction every table has: the fare without its tax.
SCORED = "scored AS (SELECT l_orderkey, l_linenumber, l_partkey, total_fare AS label, base_fare AS prediction FROM trips)"


def scored(spark, d):
    return trips(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("total_fare").alias("label"), F.col("base_fare").alias("prediction")
    )


@register("residuals", on_trips("SELECT *, label - prediction AS residual FROM scored", SCORED))
def residuals(spark, d):
    return H.residuals(scored(spark, d))


@register(
    "residual_histogram",
    on_trips(_histogram("rest", 50), SCORED, "rest AS (SELECT label - prediction AS value FROM scored)"),
)
def residual_histogram(spark, d):
    return round_all(H.residual_histogram(scored(spark, d)))


@register(
    "identity_line",
    on_trips(
        "SELECT least(min(label), min(prediction)) AS low, greatest(max(label), max(prediction)) AS high FROM scored", SCORED
    ),
)
def identity_line(spark, d):
    return H.identity_line(scored(spark, d))


@register(
    "scatter_sample",
    on_trips(f"SELECT * FROM scored WHERE {POINT_HASH} % 1000000 < 50000", SCORED),
)
def scatter_sample(spark, d):
    """A twentieth of the points of the chart, chosen by a hash."""
    return H.sample_points(scored(spark, d), 0.05, F.expr(POINT_HASH))


@register(
    "box_statistics",
    on_trips(
        f"""SELECT airline, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3, count(*) AS "count",
        {r('min(total_fare) FILTER (total_fare BETWEEN lo AND hi)')} AS whisker_low,
        {r('max(total_fare) FILTER (total_fare BETWEEN lo AND hi)')} AS whisker_high,
        count(*) FILTER (NOT (total_fare BETWEEN lo AND hi)) AS outliers
        FROM trips JOIN (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM boxes) USING (airline)
        GROUP BY airline, q1, median, q3""",
        """boxes AS (SELECT airline, quantile_cont(total_fare, 0.25) AS q1, quantile_cont(total_fare, 0.5) AS median,
        quantile_cont(total_fare, 0.75) AS q3 FROM trips WHERE airline IN
        (SELECT airline FROM trips WHERE airline IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10) GROUP BY 1)""",
    ),
)
def box_statistics(spark, d):
    return round_all(H.box_statistics(trips(spark, d), "airline", "total_fare", 10))


@register(
    "box_order",
    f"SELECT event_type, {r('quantile_cont(value, 0.5)')} AS median FROM events GROUP BY 1",
)
def box_order(spark, d):
    return round_all(H.box_order(read_table(spark, d, "events"), "event_type", "value"))


@register(
    "density",
    f"""WITH f AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h, min(value) AS lo, max(value) AS hi FROM events),
    grid AS (SELECT lo + (hi - lo) / 199 * i AS x, n, h FROM f, (SELECT unnest(range(200)) AS i))
    SELECT {r('x')} AS x, {r('sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / max(n * h) / sqrt(2 * pi())', 7)} AS density
    FROM grid, events WHERE value IS NOT NULL GROUP BY x""",
)
def density(spark, d):
    curve = H.density(read_table(spark, d, "events"), "value")
    return curve.select(rnd("x").alias("x"), rnd("density", 7).alias("density"))


INSIGHT_SQL = """SELECT 'skewed_target' AS rule, 'value' AS "column", skewness(value) AS v FROM events HAVING abs(skewness(value)) > 1
 UNION ALL SELECT 'high_variance', 'value', stddev_samp(value) / avg(value) FROM events HAVING stddev_samp(value) / avg(value) > 0.5
 UNION ALL SELECT 'high_cardinality', 'user_id', count(DISTINCT user_id) FROM events HAVING count(DISTINCT user_id) > 50
 UNION ALL SELECT 'high_cardinality', 'event_type', count(DISTINCT event_type) FROM events HAVING count(DISTINCT event_type) > 50
 UNION ALL SELECT 'dominant_category', 'user_id', max(n) / sum(n) FROM (SELECT count(*) AS n FROM events GROUP BY user_id) HAVING max(n) / sum(n) > 0.5
 UNION ALL SELECT 'dominant_category', 'event_type', max(n) / sum(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_type) HAVING max(n) / sum(n) > 0.5
 UNION ALL SELECT 'strong_group_effect', 'user_id', max(m) - min(m) FROM (SELECT round_even(avg(value), 2) AS m FROM events GROUP BY user_id)
   HAVING (max(m) - min(m)) / (SELECT avg(value) FROM events) > 0.5
 UNION ALL SELECT 'strong_group_effect', 'event_type', max(m) - min(m) FROM (SELECT round_even(avg(value), 2) AS m FROM events GROUP BY event_type)
   HAVING (max(m) - min(m)) / (SELECT avg(value) FROM events) > 0.5"""


@register(
    "insights",
    f'SELECT rule, "column", {r("v")} AS value FROM ({INSIGHT_SQL})',
)
def insight_rules(spark, d):
    rows = read_table(spark, d, "events").withColumn("user_id", F.col("user_id").cast("string"))
    found = insights(rows, "value", ["user_id", "event_type"], ["value", "event_id"])
    return found.select("rule", "column", rnd("value").alias("value"))


@register(
    "multicollinearity_insight",
    on_trips(
        "SELECT 'multicollinearity' AS rule, '*' AS \"column\", count(*)::DOUBLE AS value, "
        "format('{} column pairs move together', count(*)) AS message "
        "FROM pairs WHERE abs(r) > 0.8 HAVING count(*) > 0",
        _PEARSON,
    ),
)
def multicollinearity_insight(spark, d):
    from gridlark.operators.insights import correlation_insights

    return correlation_insights(trips(spark, d), CORRELATED)


@register("approximate_quantiles")
def sketch_quantiles(spark, d):
    """One-pass sketch per class (bounded rank error, so no SQL counterpart)."""
    return approximate_quantiles(trips(spark, d), "total_fare", {"q25": 0.25, "median": 0.5, "q75": 0.75}, ["class"])
