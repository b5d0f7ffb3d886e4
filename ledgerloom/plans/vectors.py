"""Vectors: cosine search, dense layers, activations, losses, best classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import arrays as A
from ..operators.evaluation import regression_error as errors
from ..operators.neighbours import exact_neighbours, indexed_neighbours, recall
from ..operators.scoring import Layer, forward
from ..operators.skew import join_skewed
from ..operators.similarity import most_similar as best_match, score_against_row
from .common import given, report
from .retail import MONEY

# Parameters of the registered queries: the query vector and the shape of the network.
QUERY_ID = 0
GRID = (-0.25, 0.25, 9)  # first point, last point, number of points; all are exact
INPUTS, HIDDEN, CLASSES = 64, 16, 10
DIGITS = 6
#: Every row whose number is divisible by this is a query against all rows; so many neighbours each; least share that the index finds.
QUERY_STEP, NEIGHBOURS, LEAST_RECALL = 50, 10, 0.9


def layer(neurons: int, inputs: int, relu: bool = False) -> Layer:
    """Example weights between -0.5 and 0.5, set by a rule, and rising biases."""
    weights = [[((7 * i + 13 * j) % 11 - 5) / 10 for i in range(inputs)] for j in range(neurons)]
    return Layer(weights, [j / 10 for j in range(neurons)], relu)


def vectors(spark, folder) -> DataFrame:
    return given(spark, folder, "embeddings").withColumn("x", A.doubles(F.col("embedding"))).drop("embedding")


def logits(spark, folder) -> DataFrame:
    """Two dense layers with ReLU between them."""
    network = [layer(HIDDEN, INPUTS, relu=True), layer(CLASSES, HIDDEN)]
    return forward(given(spark, folder, "embeddings"), "embedding", network, "logits").select("vec_id", "label", "logits")


def probabilities(spark, folder) -> DataFrame:
    return logits(spark, folder).select("vec_id", "label", A.softmax(F.col("logits")).alias("p"))


def rounded(*names: str) -> list:
    return [F.round(F.col(n), DIGITS).alias(n) for n in names]


def cosine_scores(spark, folder):
    v = vectors(spark, folder)
    scored = score_against_row(v, "x", v.filter(F.col("vec_id") == QUERY_ID), "x")
    return report(scored.select("vec_id", *rounded("similarity")))


def most_similar(spark, folder):
    v = vectors(spark, folder)
    others = v.filter(F.col("vec_id") != QUERY_ID)
    scored = score_against_row(others, "x", v.filter(F.col("vec_id") == QUERY_ID), "x")
    return report(best_match(scored, "vec_id").select("vec_id", "label", *rounded("similarity")))


def _asked_and_all(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = given(spark, folder, "embeddings").select("vec_id", "embedding")
    return rows.filter(F.col("vec_id") % QUERY_STEP == 0), rows


def similar_vectors(spark, folder):
    """The nearest neighbours of many vectors at once, exact."""
    found = exact_neighbours(*_asked_and_all(spark, folder), "vec_id", "embedding", NEIGHBOURS, INPUTS, DIGITS)
    return report(found.select(F.col("query").alias("query_id"), F.col("key").alias("vec_id"), "similarity", "place"))


def similarity_index_recall(spark, folder):
    """Neighbours found through the hash tables against the exact ones."""
    asked = _asked_and_all(spark, folder)
    found = indexed_neighbours(*asked, "vec_id", "embedding", NEIGHBOURS, INPUTS, digits=DIGITS)
    measured = recall(found, exact_neighbours(*asked, "vec_id", "embedding", NEIGHBOURS, INPUTS, DIGITS))
    return report(measured.select("queries", "wanted", (F.col("found") >= LEAST_RECALL * F.col("wanted")).alias("recall_reached")))


def dense_forward(spark, folder):
    out = logits(spark, folder).select("vec_id", F.posexplode("logits").alias("neuron", "value"))
    return report(out.select("vec_id", "neuron", *rounded("value")))


def activations(spark, folder):
    x = F.col("x")
    parts = F.arrays_zip(
        x.alias("x"), A.step(x).alias("step"), A.sigmoid(x).alias("sigmoid"), A.relu(x).alias("relu"),
        A.exponentials(x).alias("exponential"),
    )
    out = vectors(spark, folder).select("vec_id", F.posexplode(parts).alias("position", "a")).select("vec_id", "position", "a.*")
    powers = out.withColumn("square", F.pow("x", F.lit(2))).withColumn("log_exponential", F.ln("exponential"))
    names = ["x", "step", "sigmoid", "relu", "exponential", "square", "log_exponential"]
    return report(powers.select("vec_id", "position", *rounded(*names)))


def vector_sums(spark, folder):
    """Sums and means down the columns, along the rows, and over everything."""
    v = vectors(spark, folder)
    rows = v.select(
        F.lit("row").alias("axis"), F.col("vec_id").alias("place"),
        A.total(F.col("x")).alias("total"), A.mean(F.col("x")).alias("mean"),
    )
    cells = v.select(F.posexplode("x").alias("position", "value"))
    columns = cells.groupBy(F.lit("column").alias("axis"), F.col("position").cast("bigint").alias("place")).agg(
        F.sum("value").alias("total"), F.avg("value").alias("mean")
    )
    # The grand total needs no exploded cells.
    everything = v.agg(F.sum(A.total(F.col("x"))).alias("total"), F.sum(F.size("x")).alias("n")).select(
        F.lit("all").alias("axis"), F.lit(None).cast("bigint").alias("place"), "total", (F.col("total") / F.col("n")).alias("mean")
    )
    out = rows.unionByName(columns).unionByName(everything)
    return report(out.select("axis", "place", *rounded("total", "mean")))


def softmax_scores(spark, folder):
    scores = logits(spark, folder)
    out = scores.select("vec_id", F.posexplode(A.softmax(F.col("logits"))).alias("class", "probability"))
    return report(out.select("vec_id", "class", *rounded("probability")))


def cross_entropy(spark, folder):
    """Loss per vector, from the class number and from the one-hot form."""
    one_hot = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda i: (i == F.col("label")).cast("double"))
    losses = probabilities(spark, folder).select(
        "vec_id",
        A.cross_entropy(F.col("p"), F.col("label")).alias("loss"),
        A.cross_entropy_one_hot(F.col("p"), one_hot).alias("loss_one_hot"),
    )
    return report(losses.select("vec_id", *rounded("loss", "loss_one_hot")))


def classification_accuracy(spark, folder):
    scored = probabilities(spark, folder).select(
        A.cross_entropy(F.col("p"), F.col("label")).alias("loss"),
        (A.argmax(F.col("p")) == F.col("label")).cast("int").alias("hit"),
    )
    result = scored.agg(F.count("*").alias("n"), F.avg("loss").alias("mean_loss"), F.avg("hit").alias("accuracy"))
    return report(result.select("n", *rounded("mean_loss", "accuracy")))


def regression_error(spark, folder):
    """List price times quantity as a prediction of the price charged for a line."""
    parts = given(spark, folder, "part").select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("price"))
    lines = given(spark, folder, "lineitem").select(
        "l_partkey", F.col("l_quantity").cast("decimal(12,2)").alias("quantity"), F.col("l_extendedprice").cast(MONEY).alias("charged")
    )
    # a part may hold a large share of the lines, and every line goes on
    keyed = lines.withColumnRenamed("l_partkey", "p_partkey")
    priced = join_skewed(keyed, parts, "p_partkey", ["quantity", "charged"])
    result = errors(priced, F.col("charged"), F.col("price") * F.col("quantity"))
    return report(result.select("n", *rounded("mae", "rmse")))


def top5_classes(spark, folder):
    best = probabilities(spark, folder).select("vec_id", F.posexplode(A.top_classes(F.col("p"), 5)).alias("place", "best"))
    out = best.select(
        "vec_id",
        (F.col("place") + 1).alias("place"),
        F.concat(F.lit("class_"), F.col("best.class")).alias("class_name"),
        F.col("best.score").alias("score"),
    )
    return report(out.select("vec_id", "place", "class_name", *rounded("score")))


def grid_counts(spark, folder):
    """How many first components lie at or below each point of an even grid."""
    firsts = given(spark, folder, "embeddings").select(F.get("embedding", F.lit(0)).cast("double").alias("x"))
    points = firsts.select("x", F.posexplode(A.grid(*GRID)).alias("place", "point"))
    return report(points.groupBy("place", "point").agg(F.count_if(F.col("x") <= F.col("point")).alias("n")))


QUERIES = {
    f.__name__: f
    for f in (
        cosine_scores, most_similar, similar_vectors, similarity_index_recall, dense_forward, activations, vector_sums, softmax_scores,
        cross_entropy, classification_accuracy, regression_error, top5_classes,
        grid_counts,
    )
}

VECTORS_SQL = "vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
COSINE_SQL = f"""{VECTORS_SQL},
query AS (SELECT x AS q FROM vectors WHERE vec_id = {QUERY_ID}),
scored AS (SELECT vec_id, label, list_cosine_similarity(x, q) AS similarity FROM vectors, query)"""


NEIGHBOURS_SQL = f"""{VECTORS_SQL},
pairs AS (SELECT a.vec_id AS query_id, b.vec_id, ROUND(list_cosine_similarity(a.x, b.x), {DIGITS}) + 0.0 AS similarity
  FROM vectors a JOIN vectors b ON a.vec_id % {QUERY_STEP} = 0 AND a.vec_id <> b.vec_id),
near AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS place FROM pairs)"""


def _dense_sql(x: str, neurons: int, inputs: int) -> str:
    return (
        f"list_transform(range({neurons}), lambda j: list_sum(list_transform(range({inputs}), lambda i: "
        f"{x}[i + 1] * ((((7 * i + 13 * j) % 11) - 5) / CAST(10 AS DOUBLE)))) + j / CAST(10 AS DOUBLE))"
    )


LOGITS_SQL = f"""{VECTORS_SQL},
hidden AS (SELECT vec_id, label, list_transform({_dense_sql('x', HIDDEN, INPUTS)}, lambda v: greatest(0.0, v)) AS h FROM vectors),
scores AS (SELECT vec_id, label, {_dense_sql('h', CLASSES, HIDDEN)} AS logits FROM hidden)"""
SOFTMAX_SQL = f"""{LOGITS_SQL},
raised AS (SELECT vec_id, label, list_transform(logits, lambda v: exp(v - list_max(logits))) AS e FROM scores),
probs AS (SELECT vec_id, label, list_transform(e, lambda v: v / list_sum(e)) AS p FROM raised)"""


def _r(expression: str) -> str:
    """Rounded, and never a negative zero."""
    return f"ROUND({expression}, {DIGITS}) + 0.0"


_CLIPPED = f"least(greatest(p[label + 1], {A.CLIP_LOW}), {A.CLIP_HIGH!r})"
# the sum over all classes of the one-hot vector times the clipped probabilities, without looking one up by its number
_ONE_HOT_LOSS = (
    f"-ln(list_sum(list_transform(list_zip(p, list_transform(range({CLASSES}), lambda i: CASE WHEN i = label THEN 1.0 ELSE 0.0 END)), "
    f"lambda z: least(greatest(z[1], {A.CLIP_LOW}), {A.CLIP_HIGH!r}) * z[2])))"
)

ORACLES = {
    "grid_counts": f"""SELECT p AS place, {GRID[0]} + p * {(GRID[1] - GRID[0]) / (GRID[2] - 1)}::DOUBLE AS point,
       COUNT(*) FILTER (WHERE CAST(embedding[1] AS DOUBLE) <= {GRID[0]} + p * {(GRID[1] - GRID[0]) / (GRID[2] - 1)}::DOUBLE) AS n
FROM embeddings, range({GRID[2]}) t(p) GROUP BY p""",
    "cosine_scores": f"WITH {COSINE_SQL} SELECT vec_id, {_r('similarity')} AS similarity FROM scored",
    "most_similar": f"""WITH {COSINE_SQL} SELECT vec_id, CAST(label AS BIGINT) AS label, {_r('similarity')} AS similarity
FROM scored WHERE vec_id <> {QUERY_ID} ORDER BY scored.similarity DESC, vec_id LIMIT 1""",
    "similar_vectors": f"""WITH {NEIGHBOURS_SQL} SELECT * FROM near WHERE place <= {NEIGHBOURS}""",
    "similarity_index_recall": f"""WITH {NEIGHBOURS_SQL}
SELECT COUNT(DISTINCT query_id) AS queries, COUNT(*) AS wanted, TRUE AS recall_reached FROM near WHERE place <= {NEIGHBOURS}""",
    "dense_forward": f"""WITH {LOGITS_SQL}, n AS (SELECT vec_id, logits, UNNEST(range({CLASSES})) AS neuron FROM scores)
SELECT vec_id, neuron, {_r('logits[neuron + 1]')} AS value FROM n""",
    "activations": f"""WITH {VECTORS_SQL}, cells AS (SELECT vec_id, UNNEST(range(len(x))) AS position, UNNEST(x) AS v FROM vectors)
SELECT vec_id, position, {_r('v')} AS x, CASE WHEN v > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS step,
       {_r('1 / (1 + exp(-v))')} AS sigmoid, {_r('greatest(0.0, v)')} AS relu, {_r('exp(v)')} AS exponential,
       {_r('v * v')} AS square, {_r('ln(exp(v))')} AS log_exponential FROM cells""",
    "vector_sums": f"""WITH {VECTORS_SQL}, cells AS (SELECT vec_id, UNNEST(range(len(x))) AS position, UNNEST(x) AS v FROM vectors)
SELECT 'row' AS axis, vec_id AS place, {_r('SUM(v)')} AS total, {_r('AVG(v)')} AS mean FROM cells GROUP BY vec_id
UNION ALL SELECT 'column', position, {_r('SUM(v)')}, {_r('AVG(v)')} FROM cells GROUP BY position
UNION ALL SELECT 'all', NULL, {_r('SUM(v)')}, {_r('AVG(v)')} FROM cells""",
    "softmax_scores": f"""WITH {SOFTMAX_SQL}, n AS (SELECT vec_id, p, UNNEST(range({CLASSES})) AS class FROM probs)
SELECT vec_id, class, {_r('p[class + 1]')} AS probability FROM n""",
    "cross_entropy": f"""WITH {SOFTMAX_SQL}
SELECT vec_id, {_r(f'-ln({_CLIPPED})')} AS loss, {_r(_ONE_HOT_LOSS)} AS loss_one_hot FROM probs""",
    "classification_accuracy": f"""WITH {SOFTMAX_SQL}
SELECT COUNT(*) AS n, {_r(f'AVG(-ln({_CLIPPED}))')} AS mean_loss,
       {_r('AVG(CASE WHEN list_position(p, list_max(p)) - 1 = label THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM probs""",
    "regression_error": f"""WITH missed AS (
  SELECT CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(12,2)) - CAST(l_extendedprice AS DECIMAL(18,2)) AS miss
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT COUNT(miss) AS n, {_r('AVG(ABS(CAST(miss AS DOUBLE)))')} AS mae, {_r('SQRT(AVG(CAST(miss AS DOUBLE) * CAST(miss AS DOUBLE)))')} AS rmse
FROM missed""",
    "top5_classes": f"""WITH {SOFTMAX_SQL}, n AS (SELECT vec_id, p, UNNEST(range({CLASSES})) AS class FROM probs),
ranked AS (SELECT vec_id, class, p[class + 1] AS s, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY p[class + 1] DESC, class) AS place FROM n)
SELECT vec_id, place, 'class_' || class AS class_name, {_r('s')} AS score FROM ranked WHERE place <= 5""",
}
