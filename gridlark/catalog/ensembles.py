"""Queries: trees, forests, boosting, search and splits where SQL can give the exact answer.

On features with few values a tree of any depth predicts the mean of each combination, and
so does a forest without bootstrap. On one such feature boosting closes a known share of the
distance from the overall mean to each value's mean. A few best-first splits can be found in
SQL by trying all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.catalog.cleaning import KEYS, KEYS_SQL
from gridlark.catalog.models import PARTS
from gridlark.catalog.registry import on_trips, r, register, rnd, round_all
from gridlark.operators import regression as M
from gridlark.operators.ranking import approximate_quantiles
from gridlark.operators.splitting import hash_folds, with_split
from gridlark.plans.trips import trips
from gridlark.sources.shared import materialize
from gridlark.sources.tables import read_table

# Few rounds: what is left of a residual after them shows in the result.
ROUNDS = 5
GROUPED = {
    "Decision Tree": lambda: M.decision_tree(10),
    "Random Forest": lambda: M.random_forest(10, None, bootstrap=False),
    "Gradient Boosting (by depth)": lambda: M.boosted_trees(ROUNDS),
    "Gradient Boosting (by leaves)": lambda: M.boosted_leaves(ROUNDS),
}


def _lines(spark, d) -> DataFrame:
    """Prices by line number: one feature of seven values."""
    return read_table(spark, d, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("x"), F.col("l_extendedprice").alias("label")
    )


def _grouped_models(spark, d):
    rows = _lines(spark, d)
    return rows, M.train(rows, ["x"], {name: make() for name, make in GROUPED.items()})


# The share of its distance that a value of n rows has still to go after all rounds: each round
# closes the rate, less what the ridge holds back.
_SHARES = {
    "Decision Tree": "0.0::DOUBLE",
    "Random Forest": "0.0::DOUBLE",
    "Gradient Boosting (by depth)": f"pow(1 - 0.3 * n / (n + 1.0), {ROUNDS})",
    "Gradient Boosting (by leaves)": f"pow(0.9, {ROUNDS})",
}
_LEARNED = "learned AS (SELECT l_linenumber, n, g, m, model, CASE model " + " ".join(
    f"WHEN '{name}' THEN g + (m - g) * {share}" for name, share in _SHARES.items()
) + f""" END AS p FROM (SELECT l_linenumber, count(*) AS n, avg(l_extendedprice) AS g FROM lineitem GROUP BY 1),
    (SELECT avg(l_extendedprice) AS m FROM lineitem), (SELECT unnest([{", ".join(f"'{name}'" for name in GROUPED)}]) AS model))"""


@register("tree_predictions", f"WITH {_LEARNED} SELECT model, CAST(l_linenumber AS DOUBLE) AS x, n, {r('p')} AS prediction FROM learned")
def tree_predictions(spark, d):
    """What each kind of tree model predicts for each line number."""
    rows, models = _grouped_models(spark, d)
    counts = rows.groupBy("x").agg(F.count("*").alias("n"))
    predicted = [m.transform(counts).select(F.lit(name).alias("model"), "x", "n", rnd("prediction").alias("prediction")) for name, m in models.items()]
    return reduce(DataFrame.unionByName, predicted)


@register(
    "tree_training_metrics",
    f"""WITH {_LEARNED}, p AS (SELECT model, l_extendedprice AS y, p FROM lineitem JOIN learned USING (l_linenumber)),
    scores AS (SELECT model, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2_score, sqrt(avg((y - p) * (y - p))) AS rmse,
    avg(abs(y - p)) AS mae FROM p GROUP BY 1)
    SELECT model, metric, round(value, 4) + 0.0 AS value FROM (SELECT model, unnest(['r2_score', 'rmse', 'mae']) AS metric,
    unnest([r2_score, rmse, mae]) AS value FROM scores)""",
)
def tree_training_metrics(spark, d):
    """Metrics of the tree models on their own training rows."""
    rows, models = _grouped_models(spark, d)
    return round_all(M.training_metrics(models, rows))


# Four features of few values, of which none alone tells the price.
_CELLS = {"line": "l_linenumber", "tax": "l_tax", "discount": "l_discount", "month": "month(l_shipdate)"}


def _cells(spark, d) -> DataFrame:
    lines = read_table(spark, d, "lineitem")
    return lines.select(*[F.expr(e).cast("double").alias(c) for c, e in _CELLS.items()], F.col("l_extendedprice").alias("label"))


_CELLS_SQL = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _CELLS.items())


@register(
    "forest_of_combinations",
    f"""SELECT {", ".join(_CELLS)}, count(*) AS n, {r('avg(label)', 6)} AS prediction
    FROM (SELECT {_CELLS_SQL}, l_extendedprice AS label FROM lineitem) GROUP BY ALL""",
)
def forest_of_combinations(spark, d):
    """An unlimited forest without bootstrap predicts the mean of every combination of four features."""
    rows = _cells(spark, d)
    model = M.train(rows, list(_CELLS), {"m": M.random_forest(4, None, bootstrap=False)})["m"]
    groups = rows.groupBy(*_CELLS).agg(F.count("*").alias("n"))
    # Six digits: no mean of fewer than 32 prices lies half way between two of them.
    return model.transform(groups).select(*_CELLS, "n", rnd("prediction", 6).alias("prediction"))


LEAVES = 5


def _best_first_sql(leaves: int) -> str:
    """Leaves named by the step that made them; every step tries all cuts of all leaves and takes the best gain."""
    steps = ["t0 AS (SELECT line, tax, count(*) AS n, sum(label - m) AS s, 0 AS leaf FROM base, (SELECT avg(label) AS m FROM base) GROUP BY line, tax)"]
    for k in range(leaves - 1):
        ways = " UNION ALL ".join(
            f"""SELECT leaf, '{f}' AS feature, {f} AS cut, sum(sum(n)) OVER w AS nl, sum(sum(s)) OVER w AS sl, sum(sum(n)) OVER p AS n, sum(sum(s)) OVER p AS s
            FROM t{k} GROUP BY leaf, {f} WINDOW w AS (PARTITION BY leaf ORDER BY {f}), p AS (PARTITION BY leaf)"""
            for f in ("line", "tax")
        )
        steps.append(f"""g{k} AS MATERIALIZED (SELECT leaf, feature, cut FROM ({ways}) WHERE n > nl AND least(nl, n - nl) >= 20
          ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n DESC LIMIT 1)""")
        steps.append(f"""t{k + 1} AS MATERIALIZED (SELECT line, tax, t.n, t.s, CASE WHEN t.leaf = g.leaf AND (CASE feature WHEN 'line' THEN line ELSE tax END) > cut
          THEN {k + 1} ELSE t.leaf END AS leaf FROM t{k} t, g{k} g)""")
    return f"""WITH base AS (SELECT CAST(l_linenumber AS DOUBLE) AS line, l_tax AS tax, l_extendedprice * (1 + (l_linenumber % 3) * l_tax) AS label FROM lineitem),
      {", ".join(steps)}
      SELECT line, tax, n, {r('(SELECT avg(label) FROM base) + 0.1 * sum(s) OVER (PARTITION BY leaf) / sum(n) OVER (PARTITION BY leaf)')} AS prediction FROM t{leaves - 1}"""


@register("best_first_leaves", _best_first_sql(LEAVES))
def best_first_leaves(spark, d):
    """One boosting tree that is split best-first into a few leaves over two features."""
    lines = read_table(spark, d, "lineitem")
    label = F.col("l_extendedprice") * (1 + (F.col("l_linenumber") % 3) * F.col("l_tax"))
    rows = lines.select(F.col("l_linenumber").cast("double").alias("line"), F.col("l_tax").alias("tax"), label.alias("label"))
    model = M.train(rows, ["line", "tax"], {"m": M.boosted_leaves(1, LEAVES)})["m"]
    groups = rows.groupBy("line", "tax").agg(F.count("*").alias("n"))
    return model.transform(groups).select("line", "tax", "n", rnd("prediction").alias("prediction"))


@register(
    "linear_importance",
    f"""WITH s AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_tax, l_tax) AS bb, covar_pop(l_quantity, l_tax) AS ab,
    covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_tax, l_extendedprice) AS b_y FROM lineitem)
    SELECT 'quantity' AS feature, {r('abs((bb * ay - ab * b_y) / (aa * bb - ab * ab))', 3)} AS importance FROM s
    UNION ALL SELECT 'tax', {r('abs((aa * b_y - ab * ay) / (aa * bb - ab * ab))', 3)} FROM s""",
)
def linear_importance(spark, d):
    """Absolute coefficients of a line over two features."""
    rows = read_table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"), F.col("l_extendedprice").alias("label")
    )
    model = M.train(rows, ["quantity", "tax"], {"m": M.linear()})["m"]
    return round_all(M.feature_importance(model, ["quantity", "tax"], rows), 3)


@register(
    "tree_importance",
    "SELECT 'x' AS feature, 1.0::DOUBLE AS importance UNION ALL SELECT 'constant', 0.0 FROM (SELECT count(*) FROM lineitem)",
)
def tree_importance(spark, d):
    """A feature without two values takes no part in any split."""
    rows = _lines(spark, d).withColumn("constant", F.lit(1.0))
    model = M.train(rows, ["x", "constant"], {"m": M.decision_tree(10)})["m"]
    return round_all(M.feature_importance(model, ["x", "constant"], rows))


@register(
    "random_search_of_groups",
    f"""WITH {PARTS}, grouped AS (SELECT p_partkey % 4 AS g, p_partkey % 5 AS fold, label FROM parts),
    learned AS (SELECT k, g, avg(label) AS p FROM grouped, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY 1, 2),
    mses AS (SELECT fold, avg((label - p) * (label - p)) AS mse FROM grouped JOIN learned ON k = fold AND grouped.g = learned.g GROUP BY 1)
    SELECT {r('avg(mse)', 3)} AS least, {r('avg(mse)', 3)} AS most, true AS best_is_least FROM mses""",
)
def random_search_of_groups(spark, d):
    """Random search of trees over four groups: every point splits all groups."""
    rows = read_table(spark, d, "part").select(
        "p_partkey", (F.col("p_partkey") % 4).cast("double").alias("x"), F.col("p_retailprice").alias("label")
    )
    folded = hash_folds(rows, 5, hash_column=F.col("p_partkey"))
    found = M.tune("decision_tree", M.assembler(["x"]).transform(folded), search="random", parallelism=4)
    table = spark.createDataFrame([(mse, found.rmse**2) for _, mse in found.scores], "mse double, best double")
    return table.agg(
        rnd(F.min("mse"), 3).alias("least"), rnd(F.max("mse"), 3).alias("most"),
        (F.abs(F.max("best") / F.min("mse") - 1) < 1e-9).alias("best_is_least"),
    )


GROUPS_A_TASK = 500_000


@register(
    "default_split_facts",
    on_trips(f"SELECT count(*) AS n, count(DISTINCT ({KEYS_SQL}, total_fare, departure_ts)) AS n_distinct, true AS near_share, 0 AS on_both_sides FROM trips"),
)
def default_split_facts(spark, d):
    """The default split is complete, within five deviations of its share, and equal rows stay together."""
    rows = materialize(trips(spark, d).select(*KEYS, "total_fare", "departure_ts"))
    # Every row is a group: with parts by their number, a task holds a bounded number of groups.
    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // GROUPS_A_TASK))
    twice = with_split(rows.unionAll(rows), "total_fare").repartition(parts, *KEYS)
    sides = twice.groupBy(*rows.columns).agg(
        F.count("*").alias("copies"), F.min("is_test").alias("low"), F.max("is_test").alias("high")
    )
    n = F.sum("copies") / 2
    tested = F.sum(F.when(F.col("low"), F.col("copies")).otherwise(0)) / 2
    return sides.agg(
        n.cast("bigint").alias("n"),
        F.count("*").alias("n_distinct"),
        (F.abs(tested / n - 0.2) < 5 * F.sqrt(0.2 * 0.8 / n)).alias("near_share"),
        F.count_if(F.col("low") != F.col("high")).cast("int").alias("on_both_sides"),
    )


SKETCHED = {"q25": 0.25, "median": 0.5, "q75": 0.75}


@register(
    "sketch_errors",
    on_trips(
        "SELECT class, quantile, count(*) AS n, true AS within FROM trips, (SELECT unnest(['q25', 'median', 'q75']) AS quantile) GROUP BY 1, 2"
    ),
)
def sketch_errors(spark, d):
    """Whether the rank of each sketched quantile is within the promised share of the rows."""
    rows = trips(spark, d).select("class", "total_fare")
    accuracy = 10000
    found = approximate_quantiles(rows, "total_fare", SKETCHED, ["class"], accuracy)
    value = F.col("total_fare")
    # Four classes, one row each.
    counted = rows.join(F.broadcast(found), "class").groupBy("class").agg(
        F.count("*").alias("n"),
        *[F.count_if(value < F.col(name)).alias(f"below_{name}") for name in SKETCHED],
        *[F.count_if(value <= F.col(name)).alias(f"upto_{name}") for name in SKETCHED],
    )
    slack = F.col("n") / accuracy + 1
    facts = [
        F.struct(
            F.lit(name).alias("quantile"), F.col("n").alias("n"),
            ((F.col(f"below_{name}") <= p * F.col("n") + slack) & (F.col(f"upto_{name}") >= p * F.col("n") - slack)).alias("within"),
        )
        for name, p in SKETCHED.items()
    ]
    return counted.select("class", F.inline(F.array(*facts)))
