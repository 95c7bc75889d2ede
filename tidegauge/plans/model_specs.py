"""Models for the scoring queries: PMML text for the compiler, and the same model
as SQL for checking. The linear models are fixed; trees, forest and network follow
simple rules, so no tables are needed."""

from __future__ import annotations

from tidegauge.functions.parse import WINE_FEATURES

FIELD_NAMES = {c: c.replace("_", " ") if c != "ph" else "pH" for c in WINE_FEATURES}
CLASSES = [5, 6, 7, 4, 8, 3]

# Intercept and coefficients of the wine quality linear model.
LINEAR = (3.282519468977813, {
    "fixed_acidity": 0.0022749888223266997,
    "volatile_acidity": -0.9766327107221001,
    "chlorides": -0.28614341184874237,
    "total_sulfur_dioxide": -9.71748496814966E-4,
    "sulphates": 0.4897192785787167,
    "alcohol": 0.2492508640175212,
})
# Intercept and coefficients of the Gamma model with identity link.
GAMMA = (2.558204953024672, {
    "fixed_acidity": 0.05274008868326803,
    "volatile_acidity": -0.112266028957389,
    "citric_acid": 0.04478368542359958,
    "residual_sugar": 0.001446012959707688,
    "chlorides": -0.007581693955199139,
    "free_sulfur_dioxide": 0.007376526314283259,
    "total_sulfur_dioxide": -0.00392382955610902,
    "density": -3.187271296618442E-4,
    "ph": -0.020250777189684124,
    "sulphates": 0.07497638411719085,
    "alcohol": 0.26442850605626217,
})
# Intercept and coefficients of the Gaussian model with identity link.
GAUSSIAN = (37.78827517106293, {
    "fixed_acidity": 0.025160941296738137,
    "volatile_acidity": -0.8082809015719441,
    "citric_acid": 0.1466430979745386,
    "residual_sugar": 0.015508690806807179,
    "chlorides": -1.4501498496628016,
    "free_sulfur_dioxide": 0.0015603040869526096,
    "total_sulfur_dioxide": -0.002342701531371318,
    "density": -33.9204950546251,
    "ph": -0.1478565095402152,
    "sulphates": 0.6945636330848931,
    "alcohol": 0.19566842314715827,
})
# Width, mean and deviation of the anomaly preprocessing example.
PREPROCESSING = (3, 0.34964777, 0.18103937)
# Per anomaly model: weights over the sliding vector and the intercept.
LOGISTIC = {"a": ([1.0, 1.0, 1.0], 4.5), "b": ([0.5, 1.0, 1.5], 5.0), "c": ([1.5, 1.0, 0.5], 4.8)}

# Value range per feature in the wine view, from which rule-made thresholds are taken.
RANGES = {
    "fixed_acidity": (4, 14), "volatile_acidity": (0, 1), "citric_acid": (0, 0.64), "residual_sugar": (0, 9),
    "chlorides": (0.01, 0.07), "free_sulfur_dioxide": (0, 60), "total_sulfur_dioxide": (20, 160),
    "density": (0.99, 1.003), "ph": (3.1, 3.7), "sulphates": (0.4, 1.2), "alcohol": (8.5, 14.5),
}


def _doc(body: str, classes: list[int] | None = None) -> str:
    fields = "".join(f'<DataField name="{FIELD_NAMES[c]}" optype="continuous" dataType="double"/>' for c in WINE_FEATURES)
    values = "".join(f'<Value value="{c}"/>' for c in classes or [])
    target = f'<DataField name="quality" optype="{"categorical" if classes else "continuous"}" dataType="double">{values}</DataField>'
    return (f'<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><DataDictionary>{target}{fields}'
            f"</DataDictionary>{body}</PMML>")


def _schema() -> str:
    fields = "".join(f'<MiningField name="{FIELD_NAMES[c]}"/>' for c in WINE_FEATURES)
    return f'<MiningSchema><MiningField name="quality" usageType="target"/>{fields}</MiningSchema>'


def linear_pmml(spec=LINEAR) -> str:
    terms = "".join(f'<NumericPredictor name="{FIELD_NAMES[c]}" coefficient="{w!r}"/>' for c, w in spec[1].items())
    return _doc(f'<RegressionModel functionName="regression">{_schema()}<RegressionTable intercept="{spec[0]!r}">'
                f"{terms}</RegressionTable></RegressionModel>")


def general_pmml(spec, distribution: str, link: str = "identity") -> str:
    names = list(spec[1])
    cells = "".join(f'<PPCell value="1" predictorName="{FIELD_NAMES[c]}" parameterName="p{i + 1}"/>'
                    for i, c in enumerate(names))
    betas = f'<PCell parameterName="p0" beta="{spec[0]!r}"/>' + "".join(
        f'<PCell parameterName="p{i + 1}" beta="{spec[1][c]!r}"/>' for i, c in enumerate(names))
    return _doc(f'<GeneralRegressionModel modelType="generalizedLinear" functionName="regression" linkFunction="{link}" '
                f'distribution="{distribution}">{_schema()}<PPMatrix>{cells}</PPMatrix><ParamMatrix>{betas}</ParamMatrix>'
                "</GeneralRegressionModel>")


def linear_sql(spec) -> str:
    return f"{spec[0]!r}::double" + "".join(f" + ({w!r}::double) * {c}" for c, w in spec[1].items())


# Full binary trees by rule: node k (heap numbering) tests one feature at one point of
# its range; leaves carry a score and class counts.

def split(k: int, seed: int) -> tuple[str, float]:
    feature = WINE_FEATURES[(k * 5 + seed) % len(WINE_FEATURES)]
    lo, hi = RANGES[feature]
    return feature, round(lo + (hi - lo) * (10 + (k * 37 + seed * 13) % 80) / 100, 6)


def leaf_score(k: int, seed: int) -> float:
    return round(3 + (k * 7 + seed) % 50 / 10, 6)


def leaf_counts(k: int, seed: int) -> list[int]:
    return [1 + (k * 7 + j * j * 3 + (seed + k) * j) % 11 for j in range(len(CLASSES))]


def _leaf_class(k: int, seed: int) -> int:
    n = leaf_counts(k, seed)
    return CLASSES[n.index(max(n))]


def _nodes(k: int, depth: int, seed: int, test: str, kind: str) -> str:
    label = leaf_score(k, seed) if kind == "reg" else _leaf_class(k, seed)
    dist = "" if kind == "reg" else "".join(
        f'<ScoreDistribution value="{c}" recordCount="{n}"/>' for c, n in zip(CLASSES, leaf_counts(k, seed)))
    inner = ""
    if depth:
        f, t = split(k, seed)
        name = FIELD_NAMES[f]
        inner = _nodes(2 * k, depth - 1, seed, f'<SimplePredicate field="{name}" operator="lessOrEqual" value="{t!r}"/>', kind) + \
            _nodes(2 * k + 1, depth - 1, seed, f'<SimplePredicate field="{name}" operator="greaterThan" value="{t!r}"/>', kind)
    return f'<Node score="{label}">{test}{dist}{inner}</Node>'


def _tree_body(depth: int, seed: int, kind: str) -> str:
    function = "regression" if kind == "reg" else "classification"
    return (f'<TreeModel functionName="{function}" splitCharacteristic="binarySplit">{_schema()}'
            f"{_nodes(1, depth, seed, '<True/>', kind)}</TreeModel>")


def tree_pmml(depth: int, seed: int, kind: str) -> str:
    return _doc(_tree_body(depth, seed, kind), CLASSES if kind == "cls" else None)


def predicate_pmml(copies: int = 1) -> str:
    """A tree with every kind of predicate; the last branch is listed `copies` times, of which only
    the first is ever reached."""
    def simple(c: str, op: str, v: float) -> str:
        return f'<SimplePredicate field="{FIELD_NAMES[c]}" operator="{op}" value="{v!r}"/>'

    def compound(op: str, *parts: str) -> str:
        return f'<CompoundPredicate booleanOperator="{op}">{"".join(parts)}</CompoundPredicate>'

    a, b, x = "alcohol", "residual_sugar", "fixed_acidity"
    members = f'<SimpleSetPredicate field="{FIELD_NAMES[a]}" booleanOperator="isIn"><Array n="2" type="real">9.5 10.5</Array></SimpleSetPredicate>'
    inner = f'<Node score="4"><False/></Node><Node score="5">{simple(b, "greaterThan", 8.0)}</Node>'
    branches = [("9", "<False/>", ""), ("2", members, ""), ("3", compound("and", simple(a, "lessThan", 11.0), simple(x, "greaterOrEqual", 7.0)), inner),
                ("6", compound("or", simple(a, "greaterThan", 14.0), compound("xor", simple(b, "lessThan", 5.0), simple(x, "lessThan", 8.0))), "")]
    branches += [("7", simple(a, "greaterThan", 12.0), "")] * copies
    nodes = "".join(f'<Node score="{score}">{test}{inside}</Node>' for score, test, inside in branches)
    return _doc(f'<TreeModel functionName="regression" splitCharacteristic="multiSplit" noTrueChildStrategy="returnLastPrediction">'
                f'{_schema()}<Node score="1"><True/>{nodes}</Node></TreeModel>')


PREDICATE_SQL = ("case when alcohol in (9.5, 10.5) then 2 when alcohol < 11 and fixed_acidity >= 7 then "
                 "case when residual_sugar > 8 then 5 else 3 end "
                 "when alcohol > 14 or ((residual_sugar < 5) <> (fixed_acidity < 8)) then 6 when alcohol > 12 then 7 else 1 end")


def forest_pmml(trees: int, depth: int, method: str = "average") -> str:
    segments = "".join(f'<Segment id="{t}"><True/>{_tree_body(depth, t, "cls")}</Segment>' for t in range(trees))
    return _doc(f'<MiningModel functionName="classification">{_schema()}<Segmentation multipleModelMethod="{method}">'
                f"{segments}</Segmentation></MiningModel>", CLASSES)


def tree_sql(depth: int, seed: int, leaf, k: int = 1) -> str:
    """Nested CASE; `leaf(k)` is the SQL of leaf k."""
    if not depth:
        return leaf(k)
    f, t = split(k, seed)
    return (f"case when {f} <= {t!r}::double then {tree_sql(depth - 1, seed, leaf, 2 * k)} "
            f"else {tree_sql(depth - 1, seed, leaf, 2 * k + 1)} end")


def tree_score_sql(depth: int, seed: int, kind: str) -> str:
    return tree_sql(depth, seed, lambda k: f"{float(leaf_score(k, seed) if kind == 'reg' else _leaf_class(k, seed))!r}::double")


def leaf_number_sql(depth: int, seed: int) -> str:
    return tree_sql(depth, seed, str)


def forest_sql(trees: int, depth: int, source: str, key: str) -> str:
    """Leaf number per tree, class shares per leaf by the rule, their sum, first maximum."""
    leaves = ", ".join(f"{leaf_number_sql(depth, t)} as k{t}" for t in range(trees))
    counts = {(t, j): f"(1 + (k{t} * 7 + {j * j * 3} + ({t} + k{t}) * {j}) % 11)"
              for t in range(trees) for j in range(len(CLASSES))}
    totals = {t: "(" + " + ".join(counts[t, j] for j in range(len(CLASSES))) + ")" for t in range(trees)}
    shares = ", ".join("+".join(f"{counts[t, j]}::double / {totals[t]}" for t in range(trees))
                       for j in range(len(CLASSES)))
    labels = "[" + ", ".join(f"{float(c)}::double" for c in CLASSES) + "]"
    return (f"with lv as (select {key}, {leaves} from {source}), pr as (select {key}, [{shares}] as p from lv) "
            f"select {key}, {labels}[list_position(p, list_max(p))] as score from pr")


# A dense network by rule: 11 inputs, two logistic layers, six softmax outputs.
NETWORK_LAYERS = [11, 5, 4, 6]


def weight(layer: int, i: int, j: int) -> float:
    w = ((i * 31 + j * 17 + layer * 7) % 21 - 10) / 10
    return round(w / RANGES[WINE_FEATURES[i]][1], 6) if layer == 0 else w


def bias(layer: int, j: int) -> float:
    return ((j * 13 + layer * 5) % 11 - 5) / 10


def network_pmml() -> str:
    inputs = "".join(f'<NeuralInput id="0/{i}"><DerivedField optype="continuous" dataType="double">'
                     f'<FieldRef field="{FIELD_NAMES[c]}"/></DerivedField></NeuralInput>' for i, c in enumerate(WINE_FEATURES))
    layers = ""
    last = len(NETWORK_LAYERS) - 2
    for n in range(len(NETWORK_LAYERS) - 1):
        neurons = "".join(
            f'<Neuron id="{n + 1}/{j}" bias="{bias(n, j)!r}">' + "".join(
                f'<Con from="{n}/{i}" weight="{weight(n, i, j)!r}"/>' for i in range(NETWORK_LAYERS[n])) + "</Neuron>"
            for j in range(NETWORK_LAYERS[n + 1]))
        kind = ' activationFunction="identity" normalizationMethod="softmax"' if n == last else ""
        layers += f"<NeuralLayer{kind}>{neurons}</NeuralLayer>"
    outputs = "".join(f'<NeuralOutput outputNeuron="{last + 1}/{j}"><DerivedField optype="categorical" dataType="string">'
                      f'<NormDiscrete field="quality" value="{c}"/></DerivedField></NeuralOutput>' for j, c in enumerate(CLASSES))
    return _doc(f'<NeuralNetwork functionName="classification" activationFunction="logistic">{_schema()}'
                f"<NeuralInputs>{inputs}</NeuralInputs>{layers}<NeuralOutputs>{outputs}</NeuralOutputs></NeuralNetwork>", CLASSES)


def network_sql(source: str, key: str, classes=CLASSES) -> str:
    ctes, names = [], list(WINE_FEATURES)
    previous = source
    for n in range(len(NETWORK_LAYERS) - 1):
        outs = []
        for j in range(NETWORK_LAYERS[n + 1]):
            z = f"({bias(n, j)!r}::double)" + "".join(f" + ({weight(n, i, j)!r}::double) * {c}" for i, c in enumerate(names))
            if n < len(NETWORK_LAYERS) - 2:
                z = f"1 / (1 + exp(-({z})))"
            outs.append(f"{z} as h{n}_{j}")
        ctes.append(f"l{n} as (select {key}, {', '.join(outs)} from {previous})")
        previous, names = f"l{n}", [f"h{n}_{j}" for j in range(NETWORK_LAYERS[n + 1])]
    labels = "[" + ", ".join(f"{float(c)}::double" for c in classes) + "]"
    p = "[" + ", ".join(names) + "]"
    return (f"with {', '.join(ctes)}, o as (select {key}, {p} as p from {previous}) "
            f"select {key}, {labels}[list_position(p, list_max(p))] as score from o")
