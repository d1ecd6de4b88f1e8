"""Table rules of an experiment grid (G7): a catalogue of rules as data, compiled
to one array expression over a table of cases.

A case is a flat ``map<string,string>`` config with dotted keys; lists (the
pipeline nodes, column lists) are comma separated, blanks between them ignored.
A ``Rule`` names what its path must satisfy (``kind`` with ``keys``, ``bounds``,
``members``) and the facts of the case under which it counts (``when``; ``!``
negates a fact).  ``with_issues`` is three projections (nodes, facts, rules), so
that no expression is repeated: no join, no Python, any number of cases.

Rules compare without case and outer blanks where they compare words.  An absent
key takes the rule's default, a blank number is 0, text that is no number breaks
a range.  A null config is a case without any key.  After a missing model type
only the rules before it are reported: the others judge the model.  The order of
the nodes is judged where no rule is broken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: node, model and strategy names.
FEATURE_NODES = ("use.curated_features", "featurize.none", "featurize.rdkit", "featurize.rdkit_labeled", "featurize.morgan")
INPUT_OF_NODE = (("featurize.none", ("featurize.none", "use.curated_features")),
                 ("featurize.rdkit", ("featurize.rdkit", "featurize.rdkit_labeled")),
                 ("featurize.morgan", ("featurize.morgan",)))
INPUT_ALIASES = {"use.curated_features": "featurize.none"}
TEXT_MODELS = ("chemprop", "chemeleon")
TEXT_INPUT = "smiles_native"
DEEP_PREFIX = "dl_"
CLASSIFIERS_ONLY = ("catboost_classifier",)
DEDUPE_STRATEGIES = ("first", "last", "drop_conflicts", "majority", "keep_first", "keep_last")
KEY_COLUMN = "canonical_smiles"
LABEL_SOURCE_COLUMNS = ("standard_value",)
TRUE_WORDS = ("1", "true", "yes", "on")
BEFORE_SPLIT = ("curate", "label.normalize", "label.ic50", "featurize.none", "featurize.rdkit", "featurize.rdkit_labeled",
                "featurize.morgan")
AFTER_SPLIT = ("preprocess.features", "select.features", "train", "explain")


@dataclass(frozen=True)
class Profile:
    """What a study allows: its task, source, model types (a trailing ``*``
    stands for any ending) and feature inputs."""
    name: str
    task: str
    source: str
    models: tuple[str, ...]
    inputs: tuple[str, ...]
    derives_label: bool = False     # the target is computed from LABEL_SOURCE_COLUMNS
    needs_node: str | None = None   # a feature node that every case must have


@dataclass(frozen=True)
class Probe:
    """What is known of the dataset (H20); no columns: column rules do not count."""
    columns: tuple[str, ...] = ()
    key: str | None = None
    binary_target: bool = False


@dataclass(frozen=True)
class Rule:
    code: str
    path: str
    message: str
    kind: str = "never"
    keys: tuple[str, ...] = ()
    bounds: str = ""                 # interval, e.g. "(0,1)", "[2,)"
    members: tuple[str, ...] = ()
    default: str | None = None
    when: tuple[str, ...] = ()


# Fixed values that must equal the reference's: profiles with their members.
_TABULAR = ("random_forest", "svm", "decision_tree", "xgboost", "ensemble")
_INPUTS = ("none", TEXT_INPUT, "featurize.none", "featurize.rdkit", "featurize.morgan")
PROFILES = {p.name: p for p in (
    Profile("reg_local_csv", "regression", "local_csv", (*_TABULAR, *TEXT_MODELS, "dl_*"), _INPUTS),
    Profile("reg_local_csv_ic50", "regression", "local_csv", (*_TABULAR, *TEXT_MODELS, "dl_*"), _INPUTS, derives_label=True),
    Profile("reg_chembl_ic50", "regression", "chembl", (*_TABULAR, "dl_*"), ("featurize.rdkit",), derives_label=True,
            needs_node="featurize.rdkit"),
    Profile("clf_local_csv", "classification", "local_csv", (*_TABULAR, *CLASSIFIERS_ONLY, *TEXT_MODELS, "dl_*"), _INPUTS),
    Profile("clf_tdc_benchmark", "classification", "tdc", CLASSIFIERS_ONLY, ("none",)),
)}

_PARAM = "DOE_SPLIT_PARAM_INVALID"


def _fold_rules(prefix: str, fact: str) -> tuple[Rule, ...]:
    """Folds and repeats below ``prefix``, and the slice's place among them."""
    when = ("node split", fact)
    return (
        Rule(_PARAM, f"{prefix}.n_splits", "at least two folds", "int", bounds="[2,)", default="5", when=when),
        Rule(_PARAM, f"{prefix}.repeats", "at least one repeat", "int", bounds="[1,)", default="1", when=when),
        Rule(_PARAM, f"{prefix}.fold_index", "the fold is not one of the folds", "index",
             keys=(f"{prefix}.fold_index", f"{prefix}.n_splits"), members=("0", "5"), when=when),
        Rule(_PARAM, f"{prefix}.repeat_index", "the repeat is not one of the repeats", "index",
             keys=(f"{prefix}.repeat_index", f"{prefix}.repeats"), members=("0", "1"), when=when),
    )


BEFORE_MODEL = (
    Rule("DOE_TRAIN_NODE_CONFLICT", "pipeline.nodes", "one of train and train.tdc only", when=("node train", "node train.tdc")),
    Rule("DOE_EXPLAIN_REQUIRES_TRAIN", "pipeline.nodes", "explain needs a training node", when=("node explain", "!trains")),
    Rule("DOE_SOURCE_NOT_SUPPORTED_FOR_PROFILE", "get_data.data_source", "not the source of this profile",
         when=("node get_data", "other source")),
    Rule("DOE_DATA_SOURCE_CONFIG_INVALID", "get_data.source.path", "a local file needs its path", "filled",
         when=("node get_data", "source local_csv")),
    Rule("DOE_DATA_SOURCE_CONFIG_INVALID", "get_data.source", "a target name or id is needed", "filled",
         keys=("get_data.source.target_name", "get_data.source.target_chembl_id"), when=("node get_data", "source chembl")),
    Rule("DOE_CURATE_DEDUPE_INVALID", "curate.dedupe_strategy", "unknown dedupe strategy", "member",
         members=("", *DEDUPE_STRATEGIES), default="", when=("node curate",)),
)
MISSING_MODEL = Rule("DOE_MISSING_MODEL_TYPE", "train.model.type", "a case needs a model type", when=("!model",))
AFTER_MODEL = (
    Rule("DOE_MODEL_NOT_SUPPORTED_FOR_PROFILE", "train.model.type", "model not in this profile", when=("!model allowed",)),
    Rule("DOE_MODEL_TASK_MISMATCH", "train.model.type", "a classifier cannot do regression",
         when=("task regression", "classifier only")),
    Rule("DOE_FEATURE_INPUT_NOT_SUPPORTED", "pipeline.nodes", "feature input not in this profile",
         when=("node train", "!input allowed")),
    Rule("DOE_SMILES_NATIVE_MODEL_UNSUPPORTED", "pipeline.feature_input", "a table model cannot read raw text",
         when=("node train", "!text model", "text input")),
    Rule("DOE_FEATURE_INPUT_REQUIRED", "pipeline.nodes", "a table model needs a feature node",
         when=("node train", "!text model", "!text input", "!features")),
    Rule("DOE_FEATURE_INPUT_REQUIRED_FOR_PREPROCESS", "pipeline.nodes", "preprocessing and selection need a feature node",
         when=("prepares", "!features", "!text input")),
    Rule("DOE_CHEMPROP_FEATURE_INPUT_UNSUPPORTED", "pipeline.feature_input", "a text model reads raw text only",
         when=("text model", "!text input")),
    Rule("DOE_CHEMPROP_PREPROCESS_UNSUPPORTED", "pipeline.nodes", "a text model takes no table preprocessing",
         when=("text model", "prepares", "!passes through")),
    Rule("DOE_CHEMELEON_CHECKPOINT_REQUIRED", "train.model.foundation_checkpoint", "the pretrained model needs its checkpoint",
         "filled", when=("pretrained",)),
    Rule("DOE_FEATURE_INPUT_NOT_SUPPORTED", "pipeline.nodes", "this profile needs its own feature node", when=("!own node",)),
    Rule("DOE_SELECT_REQUIRES_PREPROCESS", "pipeline.nodes", "selection needs preprocessing",
         when=("node select.features", "!node preprocess.features")),
    Rule("DOE_SPLIT_STRATEGY_MODE_INVALID", "split.strategy", "cross-validation splits at random or by group only", "member",
         members=("random", "scaffold"), default="random", when=("node split", "folded")),
    Rule("DOE_SPLIT_STRATEGY_MODE_INVALID", "split.strategy", "imported splits are no holdout strategy",
         when=("node split", "holdout", "imported split")),
    Rule(_PARAM, "split.test_size", "above 0 and below 1", "number", bounds="(0,1)", default="0.2", when=("node split", "holdout")),
    Rule(_PARAM, "split.val_size", "from 0 to below 1", "number", bounds="[0,1)", default="0.1", when=("node split", "holdout")),
    Rule(_PARAM, "split", "test and validation leave nothing to train on", "sum", keys=("split.test_size", "split.val_size"),
         members=("0.2", "0.1"), bounds="(,1)", when=("node split", "holdout")),
    *_fold_rules("split.cv", "cv"),
    Rule(_PARAM, "split.stage", "inner or outer", "member", members=("inner", "outer"), default="inner",
         when=("node split", "nested")),
    Rule(_PARAM, "split.outer.test_size", "above 0 and below 1", "number", bounds="(0,1)", default="0.2",
         when=("node split", "nested")),
    *_fold_rules("split.inner", "nested"),
    Rule("DOE_VALIDATION_SPLIT_REQUIRED", "split", "this model needs a validation part", "number", keys=("split.val_size",),
         bounds="(0,)", default="0", when=("node split", "validates", "holdout")),
    Rule("DOE_VALIDATION_SPLIT_REQUIRED", "split", "this model needs a validation part", "number",
         keys=("split.val_from_train.val_size",), bounds="(0,)", default="0", when=("node split", "validates", "!holdout")),
    Rule("DOE_LABEL_IC50_SOURCE_COLUMNS_MISSING", "dataset.source.path", "columns of the label are not in the data",
         when=("probed", "derives label", "!label sources")),
    Rule("DOE_CURATE_LABEL_IC50_SOURCE_DROPPED", "curate.properties", "curation drops the columns of the label", "kept",
         members=LABEL_SOURCE_COLUMNS, when=("probed", "derives label", "label sources", "!keeps all")),
    Rule("DOE_TARGET_COLUMN_MISSING", "global.target_column", "target column not in the data", "column",
         when=("probed", "given target")),
    Rule("DOE_CURATE_TARGET_DROPPED", "curate.properties", "curation drops the target",
         when=("probed", "given target", "target found", "!target kept")),
    Rule("DOE_DATASET_COLUMN_MISSING", "curate.smiles_column", "key column not in the data", "column",
         when=("probed", "names key")),
    Rule("DOE_SMILES_COLUMN_MISSING", "curate.smiles_column", "no key column found in the data",
         when=("probed", "!names key", "source local_csv", "!key found")),
    Rule("DOE_CURATE_REQUIRED_COLUMNS_MISSING", "curate.required_non_null_columns", "columns not in the data", "columns",
         when=("probed",)),
    Rule("DOE_CURATE_ROW_FILTER_COLUMNS_MISSING", "curate.row_filters", "columns not in the data", "columns", when=("probed",)),
    Rule("DOE_DATASET_COLUMN_MISSING", "label.source_column", "label column not in the data", "column",
         when=("probed", "task classification", "node label.normalize", "names label")),
    Rule("DOE_LABEL_MAPPING_REQUIRED", "label", "a source column, positive and negative values are needed", "all filled",
         keys=("label.source_column", "label.positive", "label.negative"), when=("task classification", "node label.normalize")),
    Rule("DOE_LABEL_MAPPING_REQUIRED", "dataset", "without a mapping the target must have two classes",
         when=("task classification", "!node label.normalize", "!binary target")),
    Rule("DOE_TDC_MODEL_UNSUPPORTED", "train_tdc.model.type", "not a model of this training node", "exact",
         members=CLASSIFIERS_ONLY, default="", when=("node train.tdc",)),
)
CATALOGUE = (*BEFORE_MODEL, MISSING_MODEL, *AFTER_MODEL)


class _Case:
    """Columns that read one case."""

    def __init__(self, config: Column, nodes: Column, profile: Profile, probe: Probe):
        self.config, self.nodes, self.profile, self.probe = config, nodes, profile, probe

    def text(self, key: str, default: str = "") -> Column:
        return F.trim(F.coalesce(self.config[key], F.lit(default)))

    def word(self, key: str, default: str = "") -> Column:
        return F.lower(self.text(key, default))

    def words(self, key: str) -> Column:
        return listed(self.text(key))

    def number(self, key: str, default: str, kind: str = "double") -> Column:
        text = self.text(key, default)
        return F.when(text == "", F.lit(0).cast(kind)).otherwise(text.try_cast(kind))

    def known(self, column: Column) -> Column:
        return column.isin(*self.probe.columns) if self.probe.columns else F.lit(False)

    def unknown_columns(self, key: str) -> Column:
        """Listed columns that the data lacks; the key column may be listed by
        its own or by its canonical name."""
        key_name = F.coalesce(F.nullif(self.text("curate.smiles_column"), F.lit("")), F.lit(self.probe.key or ""))
        found = self.known(F.lit(KEY_COLUMN)) | self.known(key_name)
        named = F.transform(self.words(key), lambda w: F.when((w == key_name), F.lit(KEY_COLUMN)).otherwise(w))
        return F.array_distinct(F.filter(named, lambda w: ~F.when(w == KEY_COLUMN, found).otherwise(self.known(w))))

    def facts(self) -> dict[str, Column]:
        p, probe = self.profile, self.probe
        has = lambda *names: F.arrays_overlap(self.nodes, F.array(*map(F.lit, names)))
        node = {f"node {n}": has(n) for n in ("train", "train.tdc", "explain", "get_data", "curate", "split", "label.normalize",
                                              "preprocess.features", "select.features")}
        model = F.when(node["node train"], self.text("train.model.type")) \
            .when(node["node train.tdc"], self.text("train_tdc.model.type")).otherwise("")
        exact = [m for m in p.models if not m.endswith("*")]
        starts = [m[:-1] for m in p.models if m.endswith("*")]
        deep = model.startswith(DEEP_PREFIX)
        allowed = F.when(deep, F.lit(DEEP_PREFIX in starts)).otherwise(model.isin(*exact))
        given = self.text("pipeline.feature_input", "none")
        for alias, name in INPUT_ALIASES.items():
            given = F.when(given == alias, name).otherwise(given)
        given = F.when(given == "", "none").otherwise(given)
        for name, nodes in reversed(INPUT_OF_NODE):
            given = F.when(has(*nodes), name).otherwise(given)
        features, text_model, text_input = has(*FEATURE_NODES), model.isin(*TEXT_MODELS), given == TEXT_INPUT
        preprocess, select = node["node preprocess.features"], node["node select.features"]
        scaler = F.coalesce(F.nullif(self.word("preprocess.scaler", "robust"), F.lit("")), F.lit("robust"))
        source = self.word("get_data.data_source", p.source)
        task = self.word("global.task_type", p.task)
        mode, strategy = self.word("split.mode", "holdout"), self.word("split.strategy", "random")
        target, properties = self.text("global.target_column"), self.words("curate.properties")
        keeps_all = self.word("curate.keep_all_columns").isin(*TRUE_WORDS)
        local_regression = (task == "regression") & F.lit(p.source == "local_csv")
        return node | {
            "trains": node["node train"] | node["node train.tdc"],
            "model": model != "",
            "model allowed": allowed,
            "classifier only": model.isin(*CLASSIFIERS_ONLY),
            "text model": text_model,
            "text input": text_input,
            "input allowed": given.isin(*p.inputs),
            "features": features,
            "prepares": preprocess | select,
            "passes through": preprocess & ~select & (scaler == "none") & text_input & ~features,
            "pretrained": (model == "chemeleon") | (self.word("train.model.foundation", "none") == "chemeleon"),
            "own node": has(p.needs_node) if p.needs_node else F.lit(True),
            "validates": text_model | deep,
            "other source": (source != "") & (source != p.source),
            "source local_csv": source == "local_csv",
            "source chembl": source == "chembl",
            "task regression": task == "regression",
            "task classification": task == "classification",
            "holdout": mode == "holdout",
            "cv": mode == "cv",
            "nested": mode == "nested_holdout_cv",
            "folded": mode.isin("cv", "nested_holdout_cv"),
            "imported split": strategy.startswith("tdc"),
            "probed": F.lit(bool(probe.columns)),
            "derives label": local_regression & F.lit(p.derives_label),
            "given target": local_regression & F.lit(not p.derives_label),
            "label sources": F.lit(set(LABEL_SOURCE_COLUMNS) <= set(probe.columns)),
            "keeps all": keeps_all,
            "target found": self.known(target),
            "target kept": keeps_all | has("featurize.none", "use.curated_features")
            | (target == self.text("curate.label_column")) | F.array_contains(properties, target),
            "names key": self.text("curate.smiles_column") != "",
            "key found": F.lit(bool(probe.key and probe.key.strip())),
            "names label": self.text("label.source_column") != "",
            "binary target": F.lit(probe.binary_target),
        }

    def holds(self, r: Rule) -> Column:
        """Whether the rule's path satisfies it (null: it does not)."""
        keys = r.keys or (r.path,)
        if r.kind == "never":
            return F.lit(False)
        if r.kind in ("filled", "all filled"):
            filled = [F.size(self.words(k)) > 0 for k in keys]
            return reduce(lambda a, b: a & b if r.kind == "all filled" else a | b, filled)
        if r.kind == "member":
            return self.word(keys[0], r.default).isin(*r.members)
        if r.kind == "exact":
            return self.text(keys[0], r.default).isin(*r.members)
        if r.kind in ("number", "int"):
            return inside(self.number(keys[0], r.default, "double" if r.kind == "number" else "long"), r.bounds)
        if r.kind == "sum":
            return inside(reduce(lambda a, b: a + b, [self.number(k, d) for k, d in zip(keys, r.members)]), r.bounds)
        if r.kind == "index":
            at, size = (self.number(k, d, "long") for k, d in zip(keys, r.members))
            return (at >= 0) & (at < size)
        if r.kind == "column":
            return self.known(self.text(keys[0]))
        if r.kind == "columns":
            return F.size(self.unknown_columns(keys[0])) == 0
        if r.kind == "kept":
            return F.size(F.array_except(F.array(*map(F.lit, r.members)), self.words(keys[0]))) == 0
        raise ValueError(f"rule {r.code}: unknown kind {r.kind!r}")


def listed(text: Column) -> Column:
    """Words of a comma separated list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda w: F.trim(w)), lambda w: w != "")


def inside(c: Column, interval: str) -> Column:
    """``c`` within an interval written as "[low,high)"; a side may be open-ended."""
    low, high = interval[1:-1].split(",")
    out = F.lit(True)
    if low:
        out = (c >= float(low)) if interval[0] == "[" else (c > float(low))
    if high:
        below = (c <= float(high)) if interval[-1] == "]" else (c < float(high))
        out = out & below if low else below
    return out & ~F.isnan(c.cast("double"))


def with_issues(cases: DataFrame, profile: Profile, probe: Probe = Probe(), config: str = "config", out: str = "issues",
                rules: tuple[Rule, ...] = CATALOGUE) -> DataFrame:
    """``cases`` with ``out``, an ``array<struct<code,path,message>>`` of the rules
    that a case breaks, in the catalogue's order; empty for a valid case."""
    given = cases.columns
    case = _Case(F.col(f"`{config}`"), F.col("__rule_nodes"), profile, probe)
    facts = {name: (f"__rule_fact_{i}", c) for i, (name, c) in enumerate(case.facts().items())}
    after_model = set(AFTER_MODEL)

    def fact(name: str) -> Column:
        if name.lstrip("!") not in facts:
            raise ValueError(f"unknown fact {name!r}")
        c = F.col(facts[name.lstrip("!")][0])
        return ~c if name.startswith("!") else c

    def counts(r: Rule) -> Column:
        return reduce(lambda a, b: a & b, [fact(n) for n in (("model", *r.when) if r in after_model else r.when)], F.lit(True))

    def issue(r: Rule) -> Column:
        return F.struct(F.lit(r.code).alias("code"), F.lit(r.path).alias("path"), F.lit(r.message).alias("message"))

    found = [F.when(counts(r) & ~F.coalesce(case.holds(r), F.lit(False)), issue(r)) for r in rules]
    order = Rule("DOE_RUNTIME_SCHEMA_INVALID", "pipeline/config", "the nodes are in no order that can run")
    kept = [F.col(f"`{c}`") for c in given if c != out]
    return cases.withColumn("__rule_nodes", listed(case.config["pipeline.nodes"])) \
        .withColumns(dict(facts.values())) \
        .withColumn("__rule_found", F.array_compact(F.array(*found))) \
        .select(*kept, F.when((F.size("__rule_found") == 0) & unordered(case.nodes), F.array(issue(order)))
                .otherwise(F.col("__rule_found")).alias(out))


def resolve_profile(task: str, source: str = "local_csv", name: str | None = None) -> Profile:
    """The profile of a study by its resolved task and source, or the named
    one, which must be of that task."""
    if name:
        if name.strip() not in PROFILES:
            raise ValueError(f"unknown profile {name!r}; known: {sorted(PROFILES)}")
        found = PROFILES[name.strip()]
        if found.task != task:
            raise ValueError(f"profile {found.name} is for {found.task}, the task is {task}")
        return found
    source = source.strip().lower()
    if source == "tdc" and task != "classification":
        raise ValueError("this source has classification benchmarks only")
    chosen = {"tdc": "clf_tdc_benchmark", "chembl": "reg_chembl_ic50" if task == "regression" else "clf_local_csv"}
    return PROFILES[chosen.get(source, "reg_local_csv" if task == "regression" else "clf_local_csv")]


def unordered(nodes: Column) -> Column:
    """Whether a list of nodes has two splits or two tdc trainings, a tdc training
    that is not the last node, a node on the wrong side of the split, or a node
    that needs a split and finds none."""
    def times(n: str) -> Column:
        return F.size(F.filter(nodes, lambda x: x == n))

    at = F.array_position(nodes, "split")
    broken = (times("split") > 1) | (times("train.tdc") > 1) \
        | (F.array_contains(nodes, "train.tdc") & (F.element_at(nodes, -1) != "train.tdc"))
    for n in BEFORE_SPLIT:
        broken = broken | ((at > 0) & (F.array_position(nodes, n) > at))
    for n in AFTER_SPLIT:
        broken = broken | F.array_position(nodes, n).between(1, at) | ((at == 0) & F.array_contains(nodes, n))
    return F.coalesce(broken, F.lit(False))
