"""Members of a release as SQL: trees and coefficients flattened to rows, and one expression for each member's probability.

A saved tree model is a table of nodes. Its rows, bounded by the number and depth of the trees, become nested conditions over the input
columns, without vectors, indexers or a model object: scoring is a projection, and the same text runs in any engine with ANSI SQL. The
probabilities are those of the fitted pipeline but for the order of sums.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.config import EnsembleConfig
from tallyguard.operators.models import CATEGORICAL, NUMERIC
from tallyguard.operators.rules import apply_policy


@dataclass(frozen=True)
class Node:
    """A row of the node table: a leaf has a ``value``; else rows with ``feature`` <= ``threshold`` (or in ``categories``) go left."""

    tree: int
    id: int
    value: float | None = None
    left: int = -1
    right: int = -1
    feature: int = -1
    threshold: float | None = None
    categories: tuple[float, ...] = ()


@dataclass(frozen=True)
class Member:
    """``kind``: logistic (coefficients by input, intercept), forest (mean of the trees' values) or boosted (logistic of twice their weighted sum)."""

    kind: str
    inputs: tuple[str, ...]
    nodes: tuple[Node, ...] = ()
    weights: dict[int, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = ()
    intercept: float = 0.0


def number(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def numeric_input(column: str) -> str:
    """A missing number is NaN, which is above every threshold."""
    return f"coalesce(CAST({column} AS DOUBLE), CAST('NaN' AS DOUBLE))"


def indicator_input(column: str, level: str) -> str:
    text = level.replace("'", "''")
    return f"CASE WHEN {column} = '{text}' THEN {number(1)} ELSE {number(0)} END"


def tree_sql(nodes: dict[int, Node], inputs: tuple[str, ...], at: int = 0) -> str:
    n = nodes[at]
    if n.left < 0:
        return number(n.value)
    left = f"{inputs[n.feature]} <= {number(n.threshold)}" if n.threshold is not None else f"{inputs[n.feature]} IN ({', '.join(map(number, n.categories))})"
    return f"CASE WHEN {left} THEN {tree_sql(nodes, inputs, n.left)} ELSE {tree_sql(nodes, inputs, n.right)} END"


def probability_sql(member: Member) -> str:
    """The member's probability of label 1, from the input columns."""
    if member.kind == "logistic":
        terms = [f"{number(c)} * {x}" for c, x in zip(member.coefficients, member.inputs, strict=True) if c]
        return f"1 / (1 + exp(-({' + '.join([number(member.intercept), *(f'({t})' for t in terms)])})))"
    trees: dict[int, dict[int, Node]] = {}
    for n in member.nodes:
        trees.setdefault(n.tree, {})[n.id] = n
    values = {t: f"({tree_sql(nodes, member.inputs)})" for t, nodes in sorted(trees.items())}
    if member.kind == "forest":
        return f"({' + '.join(values.values())}) / {number(len(values))}"
    total = " + ".join(f"{number(member.weights.get(t, 1.0))} * {v}" for t, v in values.items())
    return f"1 / (1 + exp(-2 * ({total})))"


def inputs_of(model: PipelineModel) -> tuple[str, ...]:
    """SQL of each place of a fitted pipeline's feature vector: numbers, then an indicator for each known level of each category."""
    levels = model.stages[0].labelsArray
    return (*map(numeric_input, NUMERIC), *(indicator_input(c, level) for c, held in zip(CATEGORICAL, levels, strict=True) for level in held))


def node_table(spark: SparkSession, path: str, boosted: bool) -> DataFrame:
    """The node table of a saved tree model: tree, id, value, left, right, feature, threshold, categories. A forest's leaf has the share of label 1."""
    n = F.col("nodeData")
    stats = n["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    value = n["prediction"] if boosted else F.element_at(stats, 2) / F.nullif(total, F.lit(0.0))
    split = n["split"]
    inner, ordered = n["leftChild"] >= 0, split["numCategories"] < 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), F.when(~inner, value).alias("value"), n["leftChild"].alias("left"), n["rightChild"].alias("right"), split["featureIndex"].alias("feature"),
        F.when(inner & ordered, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"), F.when(inner & ~ordered, split["leftCategoriesOrThreshold"]).alias("categories"),
    )


def member_of(spark: SparkSession, path: str) -> Member:
    """A saved pipeline, flattened."""
    model = PipelineModel.load(path)
    inputs, last = inputs_of(model), model.stages[-1]
    if hasattr(last, "coefficients"):
        return Member("logistic", inputs, coefficients=tuple(float(x) for x in last.coefficients.toArray()), intercept=float(last.intercept))
    kind = "boosted" if "GBT" in type(last).__name__ else "forest"
    rows = node_table(spark, f"{path}/stages/{len(model.stages) - 1}_{last.uid}", kind == "boosted").collect()  # a row for each node of the model
    nodes = tuple(Node(r["tree"], r["id"], r["value"], r["left"], r["right"], r["feature"], r["threshold"], tuple(r["categories"] or ())) for r in rows)
    return Member(kind, inputs, nodes, dict(enumerate(map(float, last.treeWeights))))


def load_members(spark: SparkSession, folder: str, config: EnsembleConfig | None = None) -> dict[str, Member]:
    """The members of the release that a folder's manifest names."""
    config = config or EnsembleConfig()
    release = json.loads(spark.read.text(f"{folder}/manifest").first()["value"])["release"]
    return {m: member_of(spark, f"{folder}/{release}/{m}") for m in config.members}


def probabilities(featured: DataFrame, members: dict[str, Member]) -> DataFrame:
    """``featured`` with a probability column named after each member."""
    return featured.select("*", *(F.expr(probability_sql(m)).alias(name) for name, m in members.items()))


def score(decided: DataFrame, members: dict[str, Member], config: EnsembleConfig | None = None) -> DataFrame:
    """Decisions with the ensemble's policy, by projection alone."""
    if not members:
        raise ValueError("the ensemble has no members")
    return apply_policy(probabilities(decided, members), list(members), (config or EnsembleConfig()).threshold)
