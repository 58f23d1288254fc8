"""The registered queries in SQL, for an independent engine over the same tables.

Keys and column names are those of ``queries.QUERIES``. A query without an entry has an answer
that SQL cannot give: iterative clustering from a random start.
"""

from __future__ import annotations

LABELLED = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

MEASURED = """
SELECT l_orderkey, nullif(l_linenumber, 7) AS line, l_quantity, l_discount, l_tax, l_returnflag,
       CASE WHEN l_tax = 0.02 THEN '0.0' ELSE l_linestatus END AS status, l_shipdate
FROM lineitem
"""

PRICED = "SELECT *, l_extendedprice / 1000.0::DOUBLE AS price_k FROM lineitem"

MEASURED_BAD = """(
    l_orderkey IS NULL OR l_orderkey = 0
    OR line IS NULL OR line = 0
    OR l_quantity IS NULL OR isnan(l_quantity) OR l_quantity = 0
    OR l_discount IS NULL OR isnan(l_discount) OR l_discount = 0
    OR l_tax IS NULL OR isnan(l_tax) OR l_tax = 0
    OR l_returnflag IS NULL OR coalesce(TRY_CAST(l_returnflag AS DOUBLE) = 0, false)
    OR status IS NULL OR coalesce(TRY_CAST(status AS DOUBLE) = 0, false)
    OR l_shipdate IS NULL
)"""

REPORT = """
SELECT count(*) AS input_rows,
       count(*) FILTER (WHERE NOT coalesce({bad}, false)) AS output_rows,
       count(*) FILTER (WHERE {bad}) AS removed_rows,
       100.0::DOUBLE * count(*) FILTER (WHERE {bad}) / count(*) AS removed_pct,
       '{reason}' AS reason
FROM ({table})
"""

# From a table of p (prediction) and y (label).
METRICS = """
SELECT round(var_pop(p) + power(avg(p) - avg(y), 2), 6) AS "explainedVariance",
       round(avg(abs(p - y)), 6) AS "meanAbsoluteError",
       round(avg((p - y) * (p - y)), 6) AS "meanSquaredError",
       round(sqrt(avg((p - y) * (p - y))), 6) AS "rootMeanSquaredError",
       round(1 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2
FROM ({scored}) WHERE p IS NOT NULL AND y IS NOT NULL
"""

SCORED = "SELECT 3.25::DOUBLE + 1.5 * l_quantity + -20.0 * l_tax AS p, price_k AS y FROM ({table})"

# The probabilities themselves, where the library compares margins.
QUALITY_SCORED = f"""
SELECT doc_id, lang, source, n_chars, quality, toxic,
       CASE WHEN base IS NULL OR c0 IS NULL THEN NULL
            WHEN base > c0 THEN '0' ELSE '1' END AS "PRED"
FROM (SELECT *, 1 / total AS base, e0 / total AS c0
      FROM (SELECT *, 1 + e0 AS total
            FROM (SELECT *, exp(2.0::DOUBLE + n_chars * -0.002::DOUBLE) AS e0
                  FROM ({LABELLED}))))
"""

RETURN_SCORED = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag,
       CASE WHEN base > c0 AND base > c1 THEN 'A' WHEN c0 >= c1 THEN 'R' ELSE 'N' END AS "PRED"
FROM (SELECT *, 1 / total AS base, e0 / total AS c0, e1 / total AS c1
      FROM (SELECT *, 1 + e0 + e1 AS total
            FROM (SELECT *,
                         exp(-0.5::DOUBLE + l_quantity * 0.04::DOUBLE
                             + l_discount * -8.0::DOUBLE) AS e0,
                         exp(0.25::DOUBLE + l_quantity * -0.03::DOUBLE
                             + l_discount * 12.0::DOUBLE) AS e1
                  FROM lineitem)))
"""

# One factor and one number have a closed form: the slope within groups, then a mean per group.
# {table} has y (target), x (continuous) and g (text).
MIXED = """
means AS (SELECT g, avg(x) AS mx, avg(y) AS my FROM ({table}) GROUP BY g),
slope AS (
    SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS b
    FROM ({table}) JOIN means USING (g)
),
levels AS (SELECT g, my - b * mx AS a FROM means CROSS JOIN slope),
base AS (SELECT a AS a0 FROM levels WHERE g = (SELECT min(g) FROM levels))
"""

MIXED_LINES = MIXED.format(
    table=f"SELECT price_k AS y, l_quantity AS x, l_returnflag AS g FROM ({PRICED})"
)
MIXED_PARTS = "SELECT p_retailprice / 1000.0::DOUBLE AS y, p_size AS x, p_type AS g FROM part"
MIXED_WIDE = MIXED.format(
    table=f"SELECT price_k AS y, l_quantity AS x, (l_partkey % 1500)::VARCHAR AS g FROM ({PRICED})"
)
MIXED_PRICES = "SELECT p_retailprice AS y, p_size AS x, p_type AS g FROM part"

DISTANCE = "sqrt(power(l_quantity - {q}, 2) + power(l_extendedprice - {p}, 2))"

HEX = "('0x' || substr({digest}, {start}, {digits}))::BIGINT"


def _digest(column: str) -> str:
    return f"md5('7:' || i || ':{column}')"


def _random_double(column: str) -> str:
    number = HEX.format(digest=_digest(column), start=1, digits=8)
    return f'{number} / 4294967296.0::DOUBLE AS "{column}"'


def _random_int(column: str) -> str:
    number = HEX.format(digest=_digest(column), start=1, digits=8)
    return f'({number} - 2147483648)::INTEGER AS "{column}"'


def _random_string(column: str) -> str:
    letters = [
        "chr((33 + {} % 94)::INTEGER)".format(
            HEX.format(digest=_digest(column), start=1 + 6 * i, digits=6)
        )
        for i in range(5)
    ]
    return " || ".join(letters) + f' AS "{column}"'


def _profile(columns: dict[str, str]) -> str:
    """A row per column; the type names are Spark's."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows, "
        f"count(*) - count({name}) AS n_nulls FROM ({MEASURED})"
        for name, kind in columns.items()
    )


def _statistics(metrics: str) -> str:
    names = [
        "explainedVariance",
        "meanAbsoluteError",
        "meanSquaredError",
        "rootMeanSquaredError",
        "r2",
    ]
    return f"WITH m AS ({metrics}) " + " UNION ALL ".join(
        f'SELECT \'{name}\' AS "Statistic", "{name}" AS "Value" FROM m' for name in names
    )


SQL: dict[str, str] = {
    # Sources and sinks
    "sequence_source": """
        SELECT 'Thing' AS "Thing", i::BIGINT AS "Number"
        FROM (SELECT unnest(range(1, n + 1)) AS i FROM (SELECT count(*) AS n FROM lineitem))
    """,
    "random_source": f"""
        SELECT {_random_double("DoubleCol1")}, {_random_double("DoubleCol2")},
               {_random_int("IntCol1")}, {_random_string("StringCol1")}
        FROM (SELECT unnest(range(0, n)) AS i FROM (SELECT count(*) AS n FROM orders))
    """,
    "read_dataset": "SELECT l_orderkey, l_quantity, l_returnflag, l_shipdate FROM lineitem",
    "save_dataset": "SELECT * FROM orders",
    "save_dataset_text": "SELECT * FROM documents",
    "save_dataset_parquet": "SELECT * FROM events",
    "save_as_table": "SELECT * FROM customer",
    "replace_table": "SELECT * FROM part WHERE p_size > 25",
    "write_rejects": f"SELECT * FROM ({MEASURED}) WHERE {MEASURED_BAD}",
    "save_good_and_bad": f"""
        SELECT *, quality IS NOT NULL AND toxic IS NOT NULL AS kept FROM ({LABELLED})
    """,
    # Projections and derived columns
    "column_filter": "SELECT o_orderpriority, o_orderkey FROM orders",
    "column_filter_advanced": "SELECT o_orderstatus, o_totalprice, o_custkey FROM orders",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "power_features": """
        SELECT *, p_size::DOUBLE * p_size AS "p_size_Pow2",
               p_retailprice * p_retailprice AS "p_retailprice_Pow2"
        FROM part
    """,
    "power_features_cube": """
        SELECT l_orderkey, l_linenumber, l_quantity,
               l_quantity * l_quantity * l_quantity AS "l_quantity_Pow3",
               l_linenumber::DOUBLE * l_linenumber * l_linenumber AS "l_linenumber_Pow3"
        FROM lineitem
    """,
    "power_features_table": 'SELECT *, power(p_size, 3)::DOUBLE AS "p_size_Pow3" FROM part',
    "format_date_column": """
        SELECT *, strftime(o_orderdate, '%m/%d/%Y') AS o_orderdate_formatted FROM orders
    """,
    "format_date_column_time": """
        SELECT event_id, ts,
               strftime(ts, '%a, %d %b %Y %H:%M:%S.%g') || ' day ' || strftime(ts, '%j')
               AS ts_formatted
        FROM events
    """,
    "column_values": "SELECT DISTINCT p_brand FROM part ORDER BY p_brand LIMIT 20",
    "column_values_repeated": "SELECT event_type FROM events ORDER BY event_type LIMIT 500",
    "pair_sample": """
        SELECT c_custkey, c_acctbal FROM customer ORDER BY c_custkey, c_acctbal LIMIT 5000
    """,
    # Data quality
    "drop_null_rows": f"""
        SELECT * FROM ({LABELLED})
        WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL
          AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL
    """,
    "drop_null_nan_zero_rows": f"SELECT * FROM ({MEASURED}) WHERE NOT {MEASURED_BAD}",
    "bad_data_report": REPORT.format(
        bad=MEASURED_BAD, table=MEASURED, reason="due to nulls and zeros"
    ),
    "bad_data_report_nulls": REPORT.format(
        bad="""(doc_id IS NULL OR lang IS NULL OR source IS NULL OR n_chars IS NULL
                OR quality IS NULL OR toxic IS NULL)""",
        table=LABELLED,
        reason="due to nulls",
    ),
    "bad_data_report_custom": REPORT.format(
        bad="(line * l_quantity > 200)", table=MEASURED, reason="due to large lines"
    ),
    "count_value_occurrences": """
        SELECT count(*) FILTER (WHERE l_quantity = 25) AS occurrences FROM lineitem
    """,
    "count_value_occurrences_text": """
        SELECT count(*) FILTER (WHERE TRY_CAST(amount AS DOUBLE) = 7) AS occurrences
        FROM (SELECT CASE WHEN l_linenumber = 3 THEN l_returnflag ELSE l_quantity::VARCHAR END
                     AS amount
              FROM lineitem)
    """,
    # Aggregates
    "count_by_group": """
        SELECT o_orderpriority, count(*) AS "GroupCount" FROM orders GROUP BY o_orderpriority
    """,
    "count_by_group_null": f"""
        SELECT quality, count(*) AS "GroupCount" FROM ({LABELLED}) GROUP BY quality
    """,
    "product_by_group": """
        SELECT l_orderkey::VARCHAR AS "GroupKey", product(l_linenumber) AS "l_linenumber_PRODUCT",
               product(l_linenumber / 4.0::DOUBLE) AS "quarters_PRODUCT"
        FROM lineitem GROUP BY l_orderkey
    """,
    "product_by_group_text": """
        SELECT l_returnflag AS "GroupKey",
               product(CASE WHEN l_quantity > 25 THEN -1 ELSE 1 END) AS "sign_PRODUCT",
               CASE WHEN count(*) FILTER (WHERE l_linestatus <> 'O') > 0 THEN 0.0::DOUBLE END
               AS "gone_PRODUCT"
        FROM lineitem GROUP BY l_returnflag
    """,
    "table_profile": _profile(
        {
            "l_orderkey": "bigint",
            "line": "int",
            "l_quantity": "double",
            "l_discount": "double",
            "l_tax": "double",
            "l_returnflag": "string",
            "status": "string",
            "l_shipdate": "timestamp_ntz",
        }
    ),
    "regression_metrics": METRICS.format(scored=SCORED.format(table=PRICED)),
    "evaluate_regression": METRICS.format(scored=SCORED.format(table=PRICED)),
    "clean_score_evaluate": METRICS.format(
        scored=SCORED.format(
            table=f"SELECT * FROM ({PRICED}) "
            "WHERE l_quantity <> 0 AND l_tax <> 0 AND l_discount <> 0 AND price_k <> 0"
        )
    ),
    # Scoring and encoding
    "predict_linear": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_tax,
               round(3.25::DOUBLE + 1.5 * l_quantity + -20.0 * l_tax, 9) AS prediction
        FROM lineitem
    """,
    "predict_class": QUALITY_SCORED,
    "predict_class_many": RETURN_SCORED,
    "confusion_matrix": f"""
        SELECT quality::VARCHAR AS "Observed", "PRED" AS "Predicted", count(*) AS "N"
        FROM ({QUALITY_SCORED}) GROUP BY quality, "PRED"
    """,
    "save_confusion_matrix": f"""
        SELECT l_returnflag AS "Observed", "PRED" AS "Predicted", count(*) AS "N"
        FROM ({RETURN_SCORED}) GROUP BY l_returnflag, "PRED"
    """,
    "confusion_matrix_many": f"""
        SELECT l_returnflag AS "Observed", "PRED" AS "Predicted", count(*) AS "N"
        FROM ({RETURN_SCORED}) GROUP BY l_returnflag, "PRED"
    """,
    "score_clusters": f"""
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
               round(d0, 6) AS "distance_Cluster_0", round(d1, 6) AS "distance_Cluster_1",
               round(d2, 6) AS "distance_Cluster_2",
               CASE WHEN d0 <= d1 AND d0 <= d2 THEN 'Cluster_0'
                    WHEN d1 <= d2 THEN 'Cluster_1' ELSE 'Cluster_2' END AS "cluster"
        FROM (SELECT *, {DISTANCE.format(q=10, p=15000)} AS d0,
                     {DISTANCE.format(q=25, p=40000)} AS d1,
                     {DISTANCE.format(q=40, p=70000)} AS d2
              FROM lineitem)
    """,
    "one_hot_encode": """
        SELECT p_partkey, p_type,
               CASE WHEN known THEN (p_type = 'ECONOMY')::INTEGER::DOUBLE END AS "p_type_ECONOMY",
               CASE WHEN known THEN (p_type = 'PROMO')::INTEGER::DOUBLE END AS "p_type_PROMO",
               CASE WHEN known THEN (p_type = 'MEDIUM')::INTEGER::DOUBLE END AS "p_type_MEDIUM",
               CASE WHEN known THEN (p_type = 'LARGE')::INTEGER::DOUBLE END AS "p_type_LARGE"
        FROM (SELECT *, p_type <> 'SMALL' AS known FROM part)
    """,
    # Training, where a closed form exists
    "fit_linear_regression": f"""
        SELECT 'Intercept' AS "Predictors", 0.0::DOUBLE AS "Weights"
        UNION ALL
        SELECT 'l_quantity', round(sign(c) * greatest(abs(c) - 0.01, 0) / d, 6)
        FROM (SELECT avg(l_quantity * price_k) AS c, avg(l_quantity * l_quantity) AS d
              FROM ({PRICED}))
    """,
    "fit_ols": f"""
        SELECT 'Intercept' AS "Predictors",
               round(regr_intercept(price_k, l_quantity), 6) AS "Weights" FROM ({PRICED})
        UNION ALL
        SELECT 'l_quantity', round(regr_slope(price_k, l_quantity), 6) FROM ({PRICED})
    """,
    "fit_ols_two": f"""
        WITH s AS (
            SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(price_k) AS my,
                   var_pop(l_quantity) AS v1, var_pop(l_discount) AS v2,
                   covar_pop(l_quantity, l_discount) AS v12,
                   covar_pop(l_quantity, price_k) AS c1, covar_pop(l_discount, price_k) AS c2
            FROM ({PRICED})
        ),
        w AS (
            SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1,
                   (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2
            FROM s
        )
        SELECT 'Intercept' AS "Predictors", round(my - b1 * m1 - b2 * m2, 6) AS "Weights" FROM w
        UNION ALL SELECT 'l_quantity', round(b1, 6) FROM w
        UNION ALL SELECT 'l_discount', round(b2, 6) FROM w
    """,
    "model_equation": """
        SELECT count(*) AS row_count, 'l_extendedprice = '
               || round(regr_intercept(l_extendedprice, l_quantity), 3)::DOUBLE || ' + '
               || round(regr_slope(l_extendedprice, l_quantity), 3)::DOUBLE || ' * l_quantity' AS equation
        FROM lineitem
    """,
    "fit_mixed_wide": f"""
        WITH {MIXED_WIDE}
        SELECT 'Intercept' AS "Predictors", round(a0, 5) AS "Weights" FROM base
        UNION ALL SELECT 'l_quantity', round(b, 5) FROM slope
        UNION ALL SELECT 'part_group_' || g, round(a - a0, 5) FROM levels CROSS JOIN base
                  WHERE g > (SELECT min(g) FROM levels)
    """,
    # The normal equations: nothing is left of the errors in any category.
    "fit_mixed_two_texts": """
        SELECT 'part_group' AS name, (l_partkey % 1000)::VARCHAR AS value, count(*) AS n, 0.0::DOUBLE AS error FROM lineitem GROUP BY 2
        UNION ALL SELECT 'order_group', (l_orderkey % 1000)::VARCHAR, count(*), 0.0 FROM lineitem GROUP BY 2
        UNION ALL SELECT 'l_quantity', '', count(*), 0.0 FROM lineitem
    """,
    "fit_kmeans": """
        SELECT 'Cluster_' || (l_linenumber - min(l_linenumber) OVER ()) AS "ClusterName",
               round(avg(l_quantity + 1000 * l_linenumber), 6) AS place,
               round(avg(l_discount), 6) AS l_discount
        FROM lineitem GROUP BY l_linenumber
    """,
    "fit_kmeans_embeddings": """
        SELECT vec_id, 'Cluster_' || (dense_rank() OVER (ORDER BY label) - 1) AS cluster FROM embeddings
    """,
    "train_then_evaluate": METRICS.format(
        scored=f"""
            SELECT a + b * l_quantity AS p, price_k AS y
            FROM ({PRICED}) CROSS JOIN (
                SELECT regr_intercept(price_k, l_quantity) AS a,
                       regr_slope(price_k, l_quantity) AS b
                FROM ({PRICED}))
        """
    ),
    "fit_mixed_regression": f"""
        WITH {MIXED_LINES}
        SELECT 'Intercept' AS "Predictors", round(a0, 6) AS "Weights" FROM base
        UNION ALL SELECT 'l_quantity', round(b, 6) FROM slope
        UNION ALL SELECT 'l_returnflag_' || g, round(a - a0, 6) FROM levels CROSS JOIN base
                  WHERE g > (SELECT min(g) FROM levels)
    """,
    "fit_mixed_statistics": _statistics(
        METRICS.format(
            scored=f"""
                WITH {MIXED.format(table=MIXED_PARTS)}
                SELECT a + b * x AS p, y FROM ({MIXED_PARTS}) JOIN levels USING (g)
                CROSS JOIN slope
            """
        )
    ),
    "predict_mixed": f"""
        WITH {MIXED.format(table=MIXED_PRICES)}
        SELECT p_partkey, p_type, p_size, p_retailprice, round(a + b * p_size, 4) AS prediction
        FROM part JOIN levels ON p_type = g CROSS JOIN slope
    """,
    "fit_kmeans_separated": """
        SELECT 'Cluster_' || (row_number() OVER (ORDER BY v) - 1) AS "ClusterName",
               v AS l_linenumber
        FROM (SELECT DISTINCT l_linenumber::DOUBLE AS v FROM lineitem)
    """,
    "cluster_centers": """
        SELECT 'Cluster_0' AS "ClusterName", round(avg(l_quantity), 9) AS l_quantity,
               round(avg(l_discount), 9) AS l_discount, round(avg(l_tax), 9) AS l_tax
        FROM lineitem
    """,
}
