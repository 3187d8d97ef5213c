"""A fitted tree ensemble as a table of nodes, as a native column expression and
as SQL text.

The same node rows give all three, so scoring needs no vector assembler and no
model object in a stream's tasks, a model can be kept as a small text file, and
another engine can check the scores.

A node is a leaf (``value``), a split by threshold (left: at most ``threshold``;
NULL and NaN go right) or a split by ``values`` of a category (left: one of
these; ``unseen`` tells whether a value that training did not have, or NULL,
goes left). The score is P(1) = 1 / (1 + exp(-2 margin)), with the margin the
weighted sum of the trees' leaves, as gradient-boosted classification has it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = ("tree int, node int, weight double, feature string, threshold double, categories array<string>, seen array<string>, "
         "unseen boolean, left int, right int, value double")


@dataclass
class Node:
    tree: int
    node: int
    weight: float
    feature: str | None = None
    threshold: float | None = None
    categories: list[str] | None = None
    seen: list[str] | None = None
    unseen: bool | None = None
    left: int | None = None
    right: int | None = None
    value: float | None = None


@dataclass
class Ensemble:
    features: list[str]
    nodes: list[Node] = field(default_factory=list)

    @classmethod
    def of_model(cls, model: PipelineModel, features: list[str]) -> "Ensemble":
        """The nodes of a pipeline that ``operators.model.train_gbt`` fitted."""
        labels = {s.getInputCol(): list(s.labels) for s in model.stages if isinstance(s, StringIndexerModel)}
        gbt, nodes = model.stages[-1], []
        for t, (tree, weight) in enumerate(zip(gbt.trees, gbt.treeWeights, strict=True)):
            waiting, number = [(tree._java_obj.rootNode(), 0)], 1
            while waiting:
                java, own = waiting.pop()
                node = Node(t, own, float(weight))
                nodes.append(node)
                if java.getClass().getSimpleName() == "LeafNode":
                    node.value = java.prediction()
                    continue
                split = java.split()
                node.feature = features[split.featureIndex()]
                if split.getClass().getSimpleName() == "ContinuousSplit":
                    node.threshold = split.threshold()
                else:
                    seen, left = labels[node.feature], {int(i) for i in split.leftCategories()}
                    node.categories, node.seen = [seen[i] for i in sorted(left) if i < len(seen)], seen
                    node.unseen = len(seen) in left
                node.left, node.right = number, number + 1
                waiting += [(java.leftChild(), number), (java.rightChild(), number + 1)]
                number += 2
        return cls(list(features), nodes)

    def to_json(self) -> str:
        """One node a line."""
        lines = [json.dumps({k: v for k, v in asdict(n).items() if v is not None}) for n in self.nodes]
        return '{"features": ' + json.dumps(self.features) + ', "nodes": [\n' + ",\n".join(lines) + "\n]}\n"

    @classmethod
    def from_json(cls, text: str) -> "Ensemble":
        content = json.loads(text)
        return cls(content["features"], [Node(**n) for n in content["nodes"]])

    def table(self, spark: SparkSession) -> DataFrame:
        """The nodes as a DataFrame."""
        return spark.createDataFrame([tuple(asdict(n).values()) for n in self.nodes], NODES)

    def _trees(self) -> list[tuple[float, dict[int, Node]]]:
        trees: dict[int, dict[int, Node]] = {}
        for n in self.nodes:
            trees.setdefault(n.tree, {})[n.node] = n
        return [(own[0].weight, own) for _, own in sorted(trees.items())]

    def score(self, columns: Mapping[str, Column] | None = None) -> Column:
        """P(1) as a column of the features' columns, or of others that ``columns`` has in their place."""
        place = {f: F.col(f) for f in self.features} | dict(columns or {})

        def walk(own: dict[int, Node], k: int) -> Column:
            n = own[k]
            if n.value is not None:
                return F.lit(n.value)
            if n.threshold is not None:
                goes_left = F.coalesce(place[n.feature].cast("double"), F.lit(float("nan"))) <= F.lit(n.threshold)
            else:
                text = place[n.feature].cast("string")
                goes_left = F.coalesce(text.isin(n.categories), F.lit(False))
                if n.unseen:
                    goes_left = goes_left | ~F.coalesce(text.isin(n.seen), F.lit(False))
            return F.when(goes_left, walk(own, n.left)).otherwise(walk(own, n.right))

        margin = F.lit(0.0)
        for weight, own in self._trees():
            margin = margin + F.lit(weight) * walk(own, 0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

    def sql(self) -> str:
        """P(1) as SQL over the features' columns."""
        def number(x: float) -> str:
            return f"{x:.17e}"

        def listed(values: list[str]) -> str:
            return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")" if values else "(NULL)"

        def walk(own: dict[int, Node], k: int) -> str:
            n = own[k]
            if n.value is not None:
                return number(n.value)
            if n.threshold is not None:
                goes_left = f"coalesce(CAST({n.feature} AS DOUBLE), CAST('NaN' AS DOUBLE)) <= {number(n.threshold)}"
            else:
                goes_left = f"coalesce(CAST({n.feature} AS VARCHAR) IN {listed(n.categories)}, false)"
                if n.unseen:
                    goes_left += f" OR NOT coalesce(CAST({n.feature} AS VARCHAR) IN {listed(n.seen)}, false)"
            return f"CASE WHEN {goes_left} THEN {walk(own, n.left)} ELSE {walk(own, n.right)} END"

        margin = " + ".join(["0e0", *(f"{number(w)} * ({walk(own, 0)})" for w, own in self._trees())])
        return f"1e0 / (1e0 + exp(-2e0 * ({margin})))"
