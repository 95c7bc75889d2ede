"""PMML documents as Spark expressions.

A document is read once on the driver. Linear models and single trees become
Column expressions that stay in generated code. Forests and networks would exceed
the size of one generated method, so they become a vectorised UDF over Arrow
batches holding a few arrays.

Fields map to columns by name (lower case, spaces as underscores); a field without a
column counts as 0, as does a missing value.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Rows of a document's fields to predictions.
Run = Callable[[np.ndarray], np.ndarray]

# Trees with more leaves than this are evaluated by the vectorised UDF.
MAX_EXPRESSION_LEAVES = 64


def column_name(field: str) -> str:
    return field.strip().lower().replace(" ", "_")


@dataclass
class FlatTree:
    """A binary decision list in arrays: node i tests `feature[i] <op> value[i]`, goes to
    `yes[i]` or `no[i]`; a leaf has feature -1 and an output row."""

    feature: np.ndarray
    op: np.ndarray
    value: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    output: np.ndarray
    root: int = 0

    def apply(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root, dtype=np.int64)
        while True:
            f = self.feature[at]
            live = np.flatnonzero(f >= 0)
            if len(live) == 0:
                return self.output[at]
            node = at[live]
            v, t, op = x[live, f[live]], self.value[node], self.op[node]
            hit = np.select([op == 0, op == 1, op == 2, op == 3, op == 4],
                            [v <= t, v < t, v > t, v >= t, v == t], v != t)
            at[live] = np.where(hit, self.yes[node], self.no[node])


_OPS = {"lessOrEqual": 0, "lessThan": 1, "greaterThan": 2, "greaterOrEqual": 3, "equal": 4, "notEqual": 5}


def _compare(x: float, operator: str, t: float) -> bool:
    return [x <= t, x < t, x > t, x >= t, x == t, x != t][_OPS[operator]]


def _returns_last(tree: ET.Element) -> bool:
    return tree.get("noTrueChildStrategy") == "returnLastPrediction"


def simple_form(node: ET.Element) -> tuple:
    """The predicate of a tree node from four parts: ("const", bool), ("test", field, operator,
    number), ("and" | "or" | "xor", left, right). Both evaluators read this form only. A node
    without a predicate, and predicates outside these families, are refused."""
    found = [c for c in node if c.tag in ("True", "False") or c.tag.endswith("Predicate")]
    if len(found) != 1:
        raise ValueError(f"a tree node has {len(found)} predicates")
    return _simplify(found[0])


def _join(kind: str, parts: list[tuple]) -> tuple:
    out = parts[0]
    for part in parts[1:]:
        out = (kind, out, part)
    return out


def _simplify(p: ET.Element) -> tuple:
    if p.tag in ("True", "False"):
        return ("const", p.tag == "True")
    if p.tag == "SimplePredicate" and p.get("operator") in _OPS:
        return ("test", p.get("field"), p.get("operator"), float(p.get("value")))
    if p.tag == "SimpleSetPredicate" and p.get("booleanOperator") in ("isIn", "isNotIn"):
        values = [float(v.strip('"')) for v in p.find("Array").text.split()]
        isin = p.get("booleanOperator") == "isIn"
        if not values:
            return ("const", not isin)
        return _join("or" if isin else "and", [("test", p.get("field"), "equal" if isin else "notEqual", v) for v in values])
    if p.tag == "CompoundPredicate" and p.get("booleanOperator") in ("and", "or", "xor"):
        parts = [_simplify(c) for c in p if c.tag in ("True", "False") or c.tag.endswith("Predicate")]
        if parts:
            return _join(p.get("booleanOperator"), parts)
    raise ValueError(f"unsupported predicate: {p.tag} {p.get('operator') or p.get('booleanOperator') or ''}")


class Document:
    """A parsed PMML file; `score(columns)` gives the prediction as a DOUBLE column."""

    def __init__(self, data: bytes | str):
        root = ET.fromstring(data)
        for el in root.iter():
            el.tag = el.tag.rsplit("}", 1)[-1]
        self.root = root
        self.model = next((e for e in root if e.tag in (
            "RegressionModel", "GeneralRegressionModel", "TreeModel", "MiningModel", "NeuralNetwork")), None)
        if self.model is None:
            raise ValueError("no supported model in the document")
        schema = self.model.find("MiningSchema")
        target = [f.get("name") for f in schema if f.get("usageType") in ("target", "predicted")]
        self.fields = [f.get("name") for f in schema if f.get("name") not in target]
        dictionary = {f.get("name"): f for f in root.find("DataDictionary")}
        values = dictionary[target[0]].findall("Value") if target and target[0] in dictionary else []
        self.classes = [v.get("value") for v in values]

    def score(self, columns: list[str]) -> Column:
        build: dict[str, Callable[[list[str]], Column]] = {
            "RegressionModel": self._regression, "GeneralRegressionModel": self._general,
            "TreeModel": self._tree, "MiningModel": self._forest, "NeuralNetwork": self._network}
        return build[self.model.tag](columns)

    @property
    def vectorised(self) -> bool:
        """Whether `score` is a vectorised function rather than an expression."""
        return self.model.tag in ("MiningModel", "NeuralNetwork") or (
            self.model.tag == "TreeModel" and self._leaves(self.model) > MAX_EXPRESSION_LEAVES)

    def runner(self) -> tuple[list[str], Run]:
        """Columns and a numpy function from rows of them (missing values as 0) to predictions, for
        workers that get a document when they run."""
        build: dict[str, Callable[[], tuple[list[str], Run]]] = {
            "RegressionModel": self._regression_run, "GeneralRegressionModel": self._general_run,
            "TreeModel": lambda: (self.fields, self._tree_run()), "MiningModel": lambda: (self.fields, self._forest_run()),
            "NeuralNetwork": lambda: (self.fields, self._network_run())}
        fields, run = build[self.model.tag]()
        return [column_name(f) for f in fields], run

    # Linear models -------------------------------------------------------------

    @staticmethod
    def _field(name: str, columns: list[str]) -> Column:
        c = column_name(name)
        return F.coalesce(F.col(c), F.lit(0.0)) if c in columns else F.lit(0.0)

    def _regression(self, columns: list[str]) -> Column:
        table = self.model.find("RegressionTable")
        total = F.lit(float(table.get("intercept", 0)))
        for p in table.findall("NumericPredictor"):
            x = self._field(p.get("name"), columns)
            power = float(p.get("exponent", 1))
            x = x if power == 1 else F.pow(x, F.lit(power))
            total = total + F.lit(float(p.get("coefficient"))) * x
        return total

    def _general(self, columns: list[str]) -> Column:
        cells: dict[str, list[tuple[str, float]]] = {}
        for c in self.model.find("PPMatrix").findall("PPCell"):
            cells.setdefault(c.get("parameterName"), []).append((c.get("predictorName"), float(c.get("value"))))
        total = F.lit(0.0)
        for p in self.model.find("ParamMatrix").findall("PCell"):
            term = F.lit(float(p.get("beta")))
            for name, power in cells.get(p.get("parameterName"), []):
                x = self._field(name, columns)
                term = term * (x if power == 1 else F.pow(x, F.lit(power)))
            total = total + term
        link = self.model.get("linkFunction", "identity")
        inverse = {"identity": lambda e: e, "log": F.exp, "logit": lambda e: 1 / (1 + F.exp(-e)),
                   "power": lambda e: F.pow(e, F.lit(1 / float(self.model.get("linkParameter", 1))))}
        return inverse[link](total)

    def _regression_run(self) -> tuple[list[str], Run]:
        table = self.model.find("RegressionTable")
        terms = [(p.get("name"), float(p.get("coefficient")), float(p.get("exponent", 1)))
                 for p in table.findall("NumericPredictor")]
        start = float(table.get("intercept", 0))

        def run(x: np.ndarray) -> np.ndarray:
            total = np.full(len(x), start)
            for i, (_, weight, power) in enumerate(terms):
                total = total + weight * (x[:, i] if power == 1 else x[:, i] ** power)
            return total

        return [t[0] for t in terms], run

    def _general_run(self) -> tuple[list[str], Run]:
        cells = [(c.get("parameterName"), c.get("predictorName"), float(c.get("value")))
                 for c in self.model.find("PPMatrix").findall("PPCell")]
        betas = [(p.get("parameterName"), float(p.get("beta"))) for p in self.model.find("ParamMatrix").findall("PCell")]
        names = list(dict.fromkeys(c[1] for c in cells))
        link, power = self.model.get("linkFunction", "identity"), float(self.model.get("linkParameter", 1))
        inverse = {"identity": lambda e: e, "log": np.exp, "logit": lambda e: 1 / (1 + np.exp(-e)),
                   "power": lambda e: e ** (1 / power)}[link]

        def run(x: np.ndarray) -> np.ndarray:
            total = np.zeros(len(x))
            for parameter, beta in betas:
                term = np.full(len(x), beta)
                for own, name, exponent in cells:
                    if own == parameter:
                        column = x[:, names.index(name)]
                        term = term * (column if exponent == 1 else column ** exponent)
                total = total + term
            return inverse(total)

        return names, run

    # Trees ---------------------------------------------------------------------

    def _distribution(self, node: ET.Element, classes: list[str]) -> list[float]:
        counts = {s.get("value"): float(s.get("probability") or s.get("recordCount"))
                  for s in node.findall("ScoreDistribution")}
        if not counts:
            counts = {node.get("score"): 1.0}
        total = sum(counts.values())
        return [counts.get(c, 0.0) / total for c in classes]

    def _label(self, node: ET.Element, classes: list[str] | None) -> float:
        if classes is None:
            return float(node.get("score"))
        if node.get("score") is not None:
            return float(node.get("score"))
        p = self._distribution(node, classes)
        return float(classes[p.index(max(p))])

    def _leaves(self, tree: ET.Element) -> int:
        return sum(1 for n in tree.iter("Node") if n.find("Node") is None)

    def _tree(self, columns: list[str]) -> Column:
        classes = self.classes if self.model.get("functionName") == "classification" else None
        if self.vectorised:
            return self._udf(self._tree_run(), columns)

        def holds(p: tuple) -> Column:
            if p[0] == "const":
                return F.lit(p[1])
            if p[0] == "test":
                x, t = self._field(p[1], columns), F.lit(p[3])
                return {"lessOrEqual": x <= t, "lessThan": x < t, "greaterThan": x > t,
                        "greaterOrEqual": x >= t, "equal": x == t, "notEqual": x != t}[p[2]]
            left, right = holds(p[1]), holds(p[2])
            return {"and": left & right, "or": left | right, "xor": left != right}[p[0]]

        def test(node: ET.Element) -> Column:
            return holds(simple_form(node))

        def value(node: ET.Element) -> Column:
            children = node.findall("Node")
            if not children:
                return F.lit(self._label(node, classes))
            out = None
            for child in children:
                out = F.when(test(child), value(child)) if out is None else out.when(test(child), value(child))
            if _returns_last(self.model):
                out = out.otherwise(F.lit(self._label(node, classes)))
            return out

        return value(self.model.find("Node"))

    def _tree_run(self) -> Run:
        classes = self.classes if self.model.get("functionName") == "classification" else None
        flat = self._flatten(self.model, lambda n: [self._label(n, classes)])
        return lambda x: flat.apply(x)[:, 0]

    def _flatten(self, tree: ET.Element, output: Callable[[ET.Element], list[float]]) -> FlatTree:
        index = {f: i for i, f in enumerate(self.fields)}
        rows: list[list] = []
        last = _returns_last(tree)

        def add(feature=-1, op=0, value=0.0, yes=-1, no=-1, out=None) -> int:
            rows.append([feature, op, value, yes, no, out])
            return len(rows) - 1

        def build(node: ET.Element) -> int:
            children = node.findall("Node")
            if not children:
                return add(out=output(node))
            # Where no child holds: the node's own prediction, or none.
            at = add(out=output(node) if last else None)
            for child in reversed(children):
                at = route(simple_form(child), lambda c=child: build(c), lambda a=at: a)
            return at

        def route(p: tuple, yes: Callable[[], int], no: Callable[[], int]) -> int:
            if p[0] == "const":
                return yes() if p[1] else no()
            if p[0] == "test":
                y, n = yes(), no()
                # A document may test a field that its schema does not list: it counts as 0.
                if p[1] not in index:
                    index[p[1]] = -1
                return add(index[p[1]], _OPS[p[2]], p[3], y, n) if index[p[1]] >= 0 else (
                    y if _compare(0.0, p[2], p[3]) else n)
            y, n = yes(), no()
            if p[0] == "and":
                return route(p[1], lambda: route(p[2], lambda: y, lambda: n), lambda: n)
            if p[0] == "or":
                return route(p[1], lambda: y, lambda: route(p[2], lambda: y, lambda: n))
            return route(p[1], lambda: route(p[2], lambda: n, lambda: y), lambda: route(p[2], lambda: y, lambda: n))

        root = build(tree.find("Node"))
        width = max([1, *(len(r[5]) for r in rows if r[5])])
        cols = list(zip(*rows))
        out = np.array([r or [float("nan")] * width for r in cols[5]], dtype=float)
        return FlatTree(*[np.array(c) for c in cols[:5]], out, root)

    def _forest(self, columns: list[str]) -> Column:
        return self._udf(self._forest_run(), columns)

    def _forest_run(self) -> Run:
        seg = self.model.find("Segmentation")
        method = seg.get("multipleModelMethod")
        trees = [s.find("TreeModel") for s in seg.findall("Segment")]
        if any(t is None for t in trees) or method not in ("average", "majorityVote", "sum"):
            raise ValueError(f"unsupported ensemble: {method}")
        if self.model.get("functionName") == "regression":
            flat = [self._flatten(t, lambda n: [self._label(n, None)]) for t in trees]
            scale = 1.0 if method == "sum" else 1.0 / len(flat)
            return lambda x: sum(f.apply(x)[:, 0] for f in flat) * scale
        classes = self.classes

        def votes(node: ET.Element) -> list[float]:
            if method == "average":
                return self._distribution(node, classes)
            label = self._label(node, classes)
            return [1.0 if float(c) == label else 0.0 for c in classes]

        flat = [self._flatten(t, votes) for t in trees]
        labels = np.array([float(c) for c in classes])
        return lambda x: labels[np.argmax(sum(f.apply(x) for f in flat), axis=1)]

    # Networks ------------------------------------------------------------------

    def _network(self, columns: list[str]) -> Column:
        return self._udf(self._network_run(), columns)

    def _network_run(self) -> Run:
        inputs = {n.get("id"): n.find("DerivedField/FieldRef").get("field")
                  for n in self.model.find("NeuralInputs")}
        index = {f: i for i, f in enumerate(self.fields)}
        order = list(inputs)
        take = np.array([index[inputs[i]] for i in order])
        layers = []
        for layer in self.model.findall("NeuralLayer"):
            neurons = layer.findall("Neuron")
            w = np.zeros((len(order), len(neurons)))
            for j, n in enumerate(neurons):
                for c in n.findall("Con"):
                    w[order.index(c.get("from")), j] = float(c.get("weight"))
            bias = np.array([float(n.get("bias", 0)) for n in neurons])
            activation = layer.get("activationFunction") or self.model.get("activationFunction")
            layers.append((w, bias, activation))
            order = [n.get("id") for n in neurons]
        outputs = {o.get("outputNeuron"): o for o in self.model.find("NeuralOutputs")}
        act = {"logistic": lambda z: 1 / (1 + np.exp(-z)), "identity": lambda z: z, "tanh": np.tanh,
               "rectifier": lambda z: np.maximum(z, 0)}
        classes = None
        if self.model.get("functionName") == "classification":
            classes = np.array([float(outputs[i].find("DerivedField/NormDiscrete").get("value")) for i in order])

        def run(x: np.ndarray) -> np.ndarray:
            h = x[:, take]
            for w, bias, activation in layers:
                h = act[activation](h @ w + bias)
            # Softmax keeps the order of its inputs, so the class needs only the largest.
            return h[:, 0] if classes is None else classes[np.argmax(h, axis=1)]

        return run

    # Vectorised evaluation -----------------------------------------------------

    def _udf(self, run: Callable[[np.ndarray], np.ndarray], columns: list[str]) -> Column:
        present = [column_name(f) for f in self.fields if column_name(f) in columns]
        at = [i for i, f in enumerate(self.fields) if column_name(f) in columns]
        width = len(self.fields)

        @F.pandas_udf("double")
        def scored(*series: pd.Series) -> pd.Series:
            x = np.zeros((len(series[0]), width))
            for i, s in zip(at, series):
                x[:, i] = s.fillna(0.0).to_numpy()
            return pd.Series(run(x))

        return scored(*[F.col(c) for c in present])
