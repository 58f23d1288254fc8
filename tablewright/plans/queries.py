"""The registered queries: each runs one operator over whole tables of the given folder.

``oracles.SQL`` holds the same results in SQL under the same keys. Doubles that are sums over many
rows are rounded on both sides, since the order of addition is free in both systems; prices are
taken in thousands where their squares would leave too few digits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.names import quoted
from tablewright.functions.quality import NULLS, NULLS_AND_ZEROS, bad_row
from tablewright.models import ClassWeights, ClusterModel, LinearModel, LogisticModel, weights_table
from tablewright.operators import (
    aggregates,
    columns,
    encoding,
    quality,
    scoring,
    training,
)
from tablewright.plans import workflows
from tablewright.session import shared_folder
from tablewright.sinks import datasets as sinks
from tablewright.sources import datasets as sources
from tablewright.sources import generators

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


RANDOM_SEED = 7
PRICE_MODEL = LinearModel(("l_quantity", "l_tax"), (1.5, -20.0), 3.25, "price_k")
QUALITY_MODEL = LogisticModel(
    ("n_chars",), (ClassWeights("1", (-0.002,), 2.0),), base="0", target="quality"
)
RETURN_MODEL = LogisticModel(
    ("l_quantity", "l_discount"),
    (ClassWeights("R", (0.04, -8.0), -0.5), ClassWeights("N", (-0.03, 12.0), 0.25)),
    base="A",
    target="l_returnflag",
)
PRICE_CLUSTERS = ClusterModel(
    ("l_quantity", "l_extendedprice"), ((10.0, 15000.0), (25.0, 40000.0), (40.0, 70000.0))
)
PART_TYPES = ("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(quoted(name), digits).alias(name) if name in names else quoted(name)
            for name in df.columns
        ]
    )


def priced_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with its price in thousands."""
    return table(spark, folder, "lineitem").withColumn(
        "price_k", F.col("l_extendedprice") / F.lit(1000.0)
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its label, null where it has none."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, folder, "labels"), "doc_id", "left")


def measured_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem columns with zeros and nulls among them: line number 7 reads as null."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("line"),
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        F.when(F.col("l_tax") == 0.02, F.lit("0.0"))
        .otherwise(F.col("l_linestatus"))
        .alias("status"),
        "l_shipdate",
    )


# Sources and sinks


@query
def sequence_source(spark: SparkSession, folder: str) -> DataFrame:
    return generators.sequence_source(spark, table(spark, folder, "lineitem").count())


@query
def random_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").count()
    return generators.random_source(spark, rows, n_double=2, n_int=1, n_string=1, seed=RANDOM_SEED)


@query
def read_dataset(spark: SparkSession, folder: str) -> DataFrame:
    schema = "l_orderkey long, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    return sources.read_dataset(spark, f"{folder}/lineitem.parquet", "parquet", schema)


@query
def save_dataset(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    path = sinks.save_dataset(orders, shared_folder(spark, "orders"), "csv", compression="gzip")
    return sources.read_dataset(spark, path, "csv", orders.schema)


@query
def save_dataset_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with quotes, separators and line breaks, tab separated."""
    documents = table(spark, folder, "documents")
    path = sinks.save_dataset(
        documents, shared_folder(spark, "documents"), "csv", sep="\t", escape=True
    )
    return sources.read_dataset(spark, path, "csv", documents.schema, sep="\t", escape=True)


@query
def save_dataset_parquet(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    path = sinks.save_dataset(events, shared_folder(spark, "events"), "parquet", compression="zstd")
    return sources.read_dataset(spark, path, "parquet", events.schema)


@query
def save_as_table(spark: SparkSession, folder: str) -> DataFrame:
    """One name, whose table each run replaces."""
    sinks.save_as_table_or_view(
        table(spark, folder, "customer"), "customer_copy", schema="default", drop_if_exists=True,
        path=shared_folder(spark, "customer_copy"),
    )
    return sources.read_table(spark, "customer_copy", "default")


@query
def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced by a selection of its own rows."""
    for step in range(2):
        rows = sources.read_table(spark, "part_copy", "default") if step else table(spark, folder, "part")
        sinks.save_as_table_or_view(
            rows.where(F.col("p_size") > 25) if step else rows, "part_copy", schema="default",
            drop_if_exists=True, path=shared_folder(spark, "part_copy"),
        )
    return sources.read_table(spark, "part_copy", "default")


@query
def save_confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The counts saved as a table, and read from there."""
    matrix = scoring.confusion_matrix(table(spark, folder, "lineitem"), RETURN_MODEL)
    sinks.save_as_table_or_view(
        matrix, "return_matrix", schema="default", drop_if_exists=True,
        path=shared_folder(spark, "return_matrix"),
    )
    return sources.read_table(spark, "return_matrix", "default")


@query
def write_rejects(spark: SparkSession, folder: str) -> DataFrame:
    lines = measured_lineitem(spark, folder)
    bad = quality.split_bad_rows(lines, NULLS_AND_ZEROS)[1]
    path = sinks.write_rejects(bad, shared_folder(spark, "rejects"), fmt="csv")
    return sources.read_dataset(spark, path, "csv", lines.schema)


@query
def save_good_and_bad(spark: SparkSession, folder: str) -> DataFrame:
    """A joined input split into good and bad rows by one write with a folder for each."""
    rows = labelled_documents(spark, folder)
    flagged = rows.withColumn("kept", ~bad_row(rows, NULLS))
    path = sinks.save_dataset(flagged, shared_folder(spark, "split"), "parquet", partition_by=["kept"])
    return sources.read_dataset(spark, path, "parquet", flagged.schema)


# Projections and derived columns


@query
def column_filter(spark: SparkSession, folder: str) -> DataFrame:
    return columns.column_filter(table(spark, folder, "orders"), ["o_orderpriority", "o_orderkey"])


@query
def column_filter_advanced(spark: SparkSession, folder: str) -> DataFrame:
    kept, _ = columns.column_filter_advanced(
        table(spark, folder, "orders"),
        ["o_orderstatus", "o_totalprice", "o_custkey"],
        repartition=True,
        num_partitions=16,
    )
    return kept


@query
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    _, info = columns.column_filter_advanced(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_tax"]
    )
    return info["row_count"]


@query
def power_features(spark: SparkSession, folder: str) -> DataFrame:
    return columns.power_features(table(spark, folder, "part"), ["p_size", "p_retailprice"], "Pow2")


@query
def power_features_cube(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return columns.power_features(lines, ["l_quantity", "l_linenumber"], "Pow3")


@query
def power_features_table(spark: SparkSession, folder: str) -> DataFrame:
    powered = columns.power_features_table(table(spark, folder, "part"), ["p_size"], "Pow3")
    sinks.save_as_table_or_view(powered, "part_powers", is_view=True, drop_if_exists=True)
    return sources.read_table(spark, "part_powers")


@query
def format_date_column(spark: SparkSession, folder: str) -> DataFrame:
    return columns.format_date_column(table(spark, folder, "orders"), "o_orderdate")


@query
def format_date_column_time(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts")
    return columns.format_date_column(events, "ts", "EEE, dd MMM yyyy HH:mm:ss.SSS 'day' DDD")


@query
def column_values(spark: SparkSession, folder: str) -> DataFrame:
    return columns.column_values(table(spark, folder, "part"), "p_brand", 20)


@query
def column_values_repeated(spark: SparkSession, folder: str) -> DataFrame:
    return columns.column_values(table(spark, folder, "events"), "event_type", 500, distinct=False)


@query
def pair_sample(spark: SparkSession, folder: str) -> DataFrame:
    return columns.pair_sample(table(spark, folder, "customer"), "c_custkey", "c_acctbal", 5000)


# Data quality


@query
def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.drop_null_rows(labelled_documents(spark, folder))


@query
def drop_null_nan_zero_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.drop_null_nan_zero_rows(measured_lineitem(spark, folder))


@query
def bad_data_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.bad_data_report(measured_lineitem(spark, folder), NULLS_AND_ZEROS)


@query
def bad_data_report_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return quality.bad_data_report(labelled_documents(spark, folder), NULLS)


@query
def bad_data_report_custom(spark: SparkSession, folder: str) -> DataFrame:
    """A caller's own predicate; it is null where the line number is, which counts as good."""
    too_far = F.col("line") * F.col("l_quantity") > 200
    return quality.bad_data_report(
        measured_lineitem(spark, folder), is_bad=too_far, reason="due to large lines"
    )


@query
def count_value_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    return quality.count_value_occurrences(table(spark, folder, "lineitem"), "l_quantity", 25.0)


@query
def count_value_occurrences_text(spark: SparkSession, folder: str) -> DataFrame:
    """A text column that holds numbers in some rows and words in others."""
    mixed = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") == 3, F.col("l_returnflag"))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("amount")
    )
    return quality.count_value_occurrences(mixed, "amount", 7)


# Aggregates


@query
def count_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.count_by_group(table(spark, folder, "orders"), "o_orderpriority")


@query
def count_by_group_null(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.count_by_group(labelled_documents(spark, folder), "quality")


@query
def product_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """Line numbers per order, as they are and in quarters: both multiply exactly."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") / F.lit(4.0)).alias("quarters")
    )
    return aggregates.product_by_group(lines, "l_orderkey", ["l_linenumber", "quarters"])


@query
def product_by_group_text(spark: SparkSession, folder: str) -> DataFrame:
    """A text key with a few huge groups; factors of 1 and -1 keep the products exact."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_quantity") > 25, F.lit(-1)).otherwise(F.lit(1)).alias("sign"),
        F.nullif(F.col("l_linestatus") == "O", F.lit(True)).cast("int").alias("gone"),
    )
    return aggregates.product_by_group(lines, "l_returnflag", ["sign", "gone"])


@query
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.table_profile(measured_lineitem(spark, folder))


@query
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.predict_linear(priced_lineitem(spark, folder), PRICE_MODEL)
    metrics = aggregates.regression_metrics(scored, "prediction", "price_k")
    return rounded(metrics, metrics.columns)


@query
def evaluate_regression(spark: SparkSession, folder: str) -> DataFrame:
    metrics = scoring.evaluate_regression(priced_lineitem(spark, folder), PRICE_MODEL)
    return rounded(metrics, metrics.columns)


@query
def clean_score_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    lines = priced_lineitem(spark, folder).select(
        "l_quantity", "l_tax", "l_discount", "l_returnflag", "price_k"
    )
    metrics = workflows.clean_score_evaluate(lines, PRICE_MODEL)
    return rounded(metrics, metrics.columns)


# Scoring and encoding


@query
def predict_linear(spark: SparkSession, folder: str) -> DataFrame:
    lines = priced_lineitem(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax"
    )
    return rounded(scoring.predict_linear(lines, PRICE_MODEL), ["prediction"], 9)


@query
def predict_class(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.predict_class(labelled_documents(spark, folder), QUALITY_MODEL)


@query
def predict_class_many(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"
    )
    return scoring.predict_class(lines, RETURN_MODEL)


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.confusion_matrix(labelled_documents(spark, folder), QUALITY_MODEL)


@query
def confusion_matrix_many(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.confusion_matrix(table(spark, folder, "lineitem"), RETURN_MODEL)


@query
def score_clusters(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    scored = scoring.score_clusters(lines, PRICE_CLUSTERS)
    return rounded(scored, [name for name in scored.columns if name.startswith("distance_")])


@query
def one_hot_encode(spark: SparkSession, folder: str) -> DataFrame:
    """The last type is left out of the list, so its rows have null indicators."""
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return encoding.one_hot_encode(parts, "p_type", PART_TYPES[:-1], base="STANDARD")


# Training


@query
def fit_linear_regression(spark: SparkSession, folder: str) -> DataFrame:
    model = training.fit_linear_regression(
        priced_lineitem(spark, folder), "price_k", ["l_quantity"]
    )
    return rounded(weights_table(spark, model), ["Weights"])


@query
def fit_ols(spark: SparkSession, folder: str) -> DataFrame:
    model = training.fit_linear_regression(
        priced_lineitem(spark, folder), "price_k", ["l_quantity"], penalty=0, fit_intercept=True
    )
    return rounded(weights_table(spark, model), ["Weights"])


@query
def fit_ols_two(spark: SparkSession, folder: str) -> DataFrame:
    model = training.fit_linear_regression(
        priced_lineitem(spark, folder),
        "price_k",
        ["l_quantity", "l_discount"],
        penalty=0,
        fit_intercept=True,
    )
    return rounded(weights_table(spark, model), ["Weights"])


@query
def model_equation(spark: SparkSession, folder: str) -> DataFrame:
    """The equation of a fitted model, its numbers rounded to three digits."""
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    fitted = training.fit_linear_regression(
        lines, "l_extendedprice", ["l_quantity"], penalty=0, fit_intercept=True
    )
    short = LinearModel(
        fitted.features,
        tuple(round(value, 3) for value in fitted.coefficients),
        round(fitted.intercept, 3),
        fitted.target,
    )
    return aggregates.row_count(lines).withColumn("equation", F.lit(short.equation()))


@query
def train_then_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    _, metrics = workflows.train_then_evaluate(
        priced_lineitem(spark, folder), "price_k", ["l_quantity"], penalty=0, fit_intercept=True
    )
    return rounded(metrics, metrics.columns)


@query
def fit_mixed_regression(spark: SparkSession, folder: str) -> DataFrame:
    model = training.fit_mixed_regression(
        priced_lineitem(spark, folder), "price_k", ["l_returnflag", "l_quantity"]
    )
    return rounded(weights_table(spark, model), ["Weights"])


@query
def fit_mixed_statistics(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").withColumn(
        "price_k", F.col("p_retailprice") / F.lit(1000.0)
    )
    model = training.fit_mixed_regression(parts, "price_k", ["p_type", "p_size"])
    return rounded(training.fit_statistics(parts, model), ["Value"])


@query
def predict_mixed(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    model = training.fit_mixed_regression(parts, "p_retailprice", ["p_size", "p_type"])
    return rounded(scoring.predict_linear(parts, model), ["prediction"], 4)


@query
def fit_mixed_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A text column of 1,500 values: all weights."""
    lines = priced_lineitem(spark, folder).select(
        "price_k", "l_quantity", (F.col("l_partkey") % 1500).cast("string").alias("part_group")
    )
    model = training.fit_mixed_regression(lines, "price_k", ["l_quantity", "part_group"])
    return rounded(weights_table(spark, model), ["Weights"], 5)


@query
def fit_mixed_two_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Two text columns of 1,000 values each. The least error is where the errors of every category, and
    those times the quantity, add up to nothing: rows per category with the mean error."""
    lines = priced_lineitem(spark, folder).select(
        "price_k", "l_quantity",
        (F.col("l_partkey") % 1000).cast("string").alias("part_group"),
        (F.col("l_orderkey") % 1000).cast("string").alias("order_group"),
    )
    model = training.fit_mixed_regression(lines, "price_k", ["l_quantity", "part_group", "order_group"])
    scored = scoring.predict_linear(lines, model).withColumn("error", F.col("price_k") - F.col("prediction"))
    cells = F.inline(F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).alias("value"), F.col("error").alias("error")) for c in ("part_group", "order_group")],
        F.struct(F.lit("l_quantity").alias("name"), F.lit("").alias("value"), (F.col("error") * F.col("l_quantity")).alias("error")),
    ))
    found = scored.select(cells).groupBy("name", "value").agg(F.count("*").alias("n"), F.avg("error").alias("error"))
    return found.select("name", "value", "n", (F.round("error", 6) + F.lit(0.0)).alias("error"))


@query
def fit_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    """Seven groups far from one another, each with spread of its own."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_quantity") + 1000 * F.col("l_linenumber")).alias("place"), "l_discount"
    )
    model = training.fit_kmeans(lines, ["place", "l_discount"], k=7, seed=RANDOM_SEED)
    return rounded(model.centers_table(spark), ["place", "l_discount"], 6)


@query
def fit_kmeans_separated(spark: SparkSession, folder: str) -> DataFrame:
    """As many clusters as there are values: the centres are the values."""
    model = training.fit_kmeans(
        table(spark, folder, "lineitem"), ["l_linenumber"], k=7, seed=RANDOM_SEED
    )
    return rounded(model.centers_table(spark), ["l_linenumber"])


@query
def fit_kmeans_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Whole vectors, the first element moved by their label: a cluster per label."""
    moved = F.expr("transform(embedding, (x, i) -> if(i = 0, x + 100.0D * label, cast(x as double)))")
    vectors = table(spark, folder, "embeddings").select("vec_id", moved.alias("point"))
    model = training.fit_kmeans(vectors, ["point"], k=10, seed=RANDOM_SEED)
    return scoring.score_clusters(vectors, model).select("vec_id", "cluster")


@query
def cluster_centers(spark: SparkSession, folder: str) -> DataFrame:
    """One cluster: its centre is the mean."""
    model = training.fit_kmeans(
        table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_tax"], k=1
    )
    # An average over this many rows of two-decimal values may lie half-way between six-digit
    # numbers, but not between nine-digit ones.
    return rounded(model.centers_table(spark), ["l_quantity", "l_discount", "l_tax"], 9)
