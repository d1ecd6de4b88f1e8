import pytest
from pyspark.sql import functions as F

from tessera.operators import grid_rules as R

BASE = {
    "pipeline.nodes": "get_data, curate, featurize.none, split, preprocess.features, train, explain",
    "train.model.type": "random_forest", "get_data.source.path": "/x.csv", "global.target_column": "y",
    "curate.smiles_column": "key",
}
PROBE = R.Probe(columns=("key", "y", "a"), key="key", binary_target=True)
REG, IC50, CHEMBL, CLF, TDC = (R.PROFILES[n] for n in ("reg_local_csv", "reg_local_csv_ic50", "reg_chembl_ic50", "clf_local_csv",
                                                      "clf_tdc_benchmark"))


def codes(spark, configs, profile=REG, probe=PROBE):
    """Codes and paths per config; the case's own columns stay, an old ``issues`` goes."""
    rows = spark.createDataFrame([(i, c, "old") for i, c in enumerate(configs)], "id int, config map<string,string>, issues string")
    out = R.with_issues(rows, profile, probe)
    assert out.columns == ["id", "config", "issues"]
    return [[(i.code.removeprefix("DOE_"), i.path) for i in r.issues] for r in out.orderBy("id").collect()]


def nodes(text):
    return {"pipeline.nodes": text}


CV, NESTED = {"split.mode": "cv"}, {"split.mode": "nested_holdout_cv"}
TEXT = {"train.model.type": "chemprop", "split.val_size": "0.1", "pipeline.feature_input": "smiles_native"}
TRIPS = [
    ({}, []),
    (nodes("curate,featurize.none,split,train,train.tdc") | {"train_tdc.model.type": "catboost_classifier"},
     [("TRAIN_NODE_CONFLICT", "pipeline.nodes")]),
    (nodes("curate,split,explain"), [("EXPLAIN_REQUIRES_TRAIN", "pipeline.nodes"), ("MISSING_MODEL_TYPE", "train.model.type")]),
    ({"get_data.data_source": "TDC "}, [("SOURCE_NOT_SUPPORTED_FOR_PROFILE", "get_data.data_source")]),
    ({"get_data.source.path": " "}, [("DATA_SOURCE_CONFIG_INVALID", "get_data.source.path")]),
    ({"curate.dedupe_strategy": "Keep_Last"}, []),
    ({"curate.dedupe_strategy": "best"}, [("CURATE_DEDUPE_INVALID", "curate.dedupe_strategy")]),
    ({"train.model.type": ""}, [("MISSING_MODEL_TYPE", "train.model.type")]),
    ({"train.model.type": "dl_simple", "split.val_size": "0.1"}, []),
    ({"train.model.type": "dl_simple"}, [("VALIDATION_SPLIT_REQUIRED", "split")]),
    ({"train.model.type": "catboost_classifier"},
     [("MODEL_NOT_SUPPORTED_FOR_PROFILE", "train.model.type"), ("MODEL_TASK_MISMATCH", "train.model.type")]),
    (nodes("curate,split,train") | {"curate.properties": "y"}, [("FEATURE_INPUT_REQUIRED", "pipeline.nodes")]),
    (nodes("curate,split,train") | {"curate.properties": "y", "pipeline.feature_input": "smiles_native"},
     [("SMILES_NATIVE_MODEL_UNSUPPORTED", "pipeline.feature_input")]),
    (nodes("curate,split,preprocess.features,train") | {"curate.properties": "y", "pipeline.feature_input": "other"},
     [("FEATURE_INPUT_NOT_SUPPORTED", "pipeline.nodes"), ("FEATURE_INPUT_REQUIRED", "pipeline.nodes"),
      ("FEATURE_INPUT_REQUIRED_FOR_PREPROCESS", "pipeline.nodes")]),
    (nodes("curate,split,train") | TEXT | {"curate.properties": "y"}, []),
    (nodes("curate,split,preprocess.features,train") | TEXT | {"curate.properties": "y", "preprocess.scaler": "None"}, []),
    (nodes("curate,split,preprocess.features,train") | TEXT | {"curate.properties": "y"},
     [("CHEMPROP_PREPROCESS_UNSUPPORTED", "pipeline.nodes")]),
    (nodes("curate,featurize.none,split,train") | TEXT, [("CHEMPROP_FEATURE_INPUT_UNSUPPORTED", "pipeline.feature_input")]),
    (nodes("curate,split,train") | TEXT | {"train.model.type": "chemeleon", "curate.properties": "y"},
     [("CHEMELEON_CHECKPOINT_REQUIRED", "train.model.foundation_checkpoint")]),
    (nodes("curate,featurize.none,split,select.features,train"), [("SELECT_REQUIRES_PREPROCESS", "pipeline.nodes")]),
    (CV | {"split.strategy": "scaffold"}, []),
    (CV | {"split.strategy": "stratified"}, [("SPLIT_STRATEGY_MODE_INVALID", "split.strategy")]),
    ({"split.strategy": "tdc_random"}, [("SPLIT_STRATEGY_MODE_INVALID", "split.strategy")]),
    ({"split.test_size": "0"}, [("SPLIT_PARAM_INVALID", "split.test_size")]),
    ({"split.test_size": "0.5", "split.val_size": "0.5"}, [("SPLIT_PARAM_INVALID", "split")]),
    ({"split.val_size": "-0.1"}, [("SPLIT_PARAM_INVALID", "split.val_size")]),
    ({"split.test_size": "x", "split.val_size": ""}, [("SPLIT_PARAM_INVALID", "split.test_size"), ("SPLIT_PARAM_INVALID", "split")]),
    (CV | {"split.cv.n_splits": "1"}, [("SPLIT_PARAM_INVALID", "split.cv.n_splits")]),
    (CV | {"split.cv.fold_index": "5"}, [("SPLIT_PARAM_INVALID", "split.cv.fold_index")]),
    (CV | {"split.cv.repeats": "0"}, [("SPLIT_PARAM_INVALID", "split.cv.repeats"), ("SPLIT_PARAM_INVALID", "split.cv.repeat_index")]),
    (NESTED | {"split.stage": "middle"}, [("SPLIT_PARAM_INVALID", "split.stage")]),
    (NESTED | {"split.outer.test_size": "1"}, [("SPLIT_PARAM_INVALID", "split.outer.test_size")]),
    (NESTED | {"split.inner.repeat_index": "-1"}, [("SPLIT_PARAM_INVALID", "split.inner.repeat_index")]),
    ({"global.target_column": "z"}, [("TARGET_COLUMN_MISSING", "global.target_column")]),
    (nodes("curate,featurize.rdkit,split,train"), [("CURATE_TARGET_DROPPED", "curate.properties")]),
    (nodes("curate,featurize.rdkit,split,train") | {"curate.keep_all_columns": "Yes"}, []),
    ({"curate.smiles_column": "zz"}, [("DATASET_COLUMN_MISSING", "curate.smiles_column")]),
    ({"curate.required_non_null_columns": "a,key,canonical_smiles"}, []),
    ({"curate.required_non_null_columns": "a, b"}, [("CURATE_REQUIRED_COLUMNS_MISSING", "curate.required_non_null_columns")]),
    ({"curate.row_filters": "b"}, [("CURATE_ROW_FILTER_COLUMNS_MISSING", "curate.row_filters")]),
    (nodes("featurize.none,split,curate,train"), [("RUNTIME_SCHEMA_INVALID", "pipeline/config")]),
    (nodes("featurize.none,train"), [("RUNTIME_SCHEMA_INVALID", "pipeline/config")]),
    (nodes("featurize.none,split,split,train"), [("RUNTIME_SCHEMA_INVALID", "pipeline/config")]),
    (nodes("train,featurize.none,split"), [("RUNTIME_SCHEMA_INVALID", "pipeline/config")]),
]


def test_every_rule_of_the_regression_profile(spark):
    got = codes(spark, [BASE | change for change, _ in TRIPS])
    for (change, want), have in zip(TRIPS, got):
        assert have == want, change


def test_other_profiles(spark):
    rdkit = BASE | nodes("curate,featurize.rdkit,split,train")
    assert codes(spark, [rdkit], IC50) == [[("LABEL_IC50_SOURCE_COLUMNS_MISSING", "dataset.source.path")]]
    sources = R.Probe(columns=("key", "standard_value"), key="key")
    assert codes(spark, [rdkit, rdkit | {"curate.properties": "a,standard_value"}], IC50, sources) == \
        [[("CURATE_LABEL_IC50_SOURCE_DROPPED", "curate.properties")], []]
    assert codes(spark, [BASE | {"get_data.data_source": "chembl", "pipeline.nodes": "get_data,curate,split,train"}], CHEMBL) == [[
        ("DATA_SOURCE_CONFIG_INVALID", "get_data.source"), ("FEATURE_INPUT_NOT_SUPPORTED", "pipeline.nodes"),
        ("FEATURE_INPUT_REQUIRED", "pipeline.nodes"), ("FEATURE_INPUT_NOT_SUPPORTED", "pipeline.nodes")]]
    label = BASE | nodes("curate,label.normalize,featurize.none,split,train") | {"label.source_column": "a", "label.positive": "1"}
    assert codes(spark, [BASE, label, label | {"label.negative": "0"}, label | {"label.negative": "0", "label.source_column": "q"}], CLF) == \
        [[], [("LABEL_MAPPING_REQUIRED", "label")], [], [("DATASET_COLUMN_MISSING", "label.source_column")]]
    assert codes(spark, [BASE], CLF, R.Probe(columns=PROBE.columns, key="key")) == [[("LABEL_MAPPING_REQUIRED", "dataset")]]
    tdc = {"pipeline.nodes": "train.tdc", "train_tdc.model.type": "catboost_classifier"}
    assert codes(spark, [tdc, tdc | {"train_tdc.model.type": "svm"}, tdc | nodes("train.tdc,curate")], TDC, R.Probe(binary_target=True)) == [
        [], [("MODEL_NOT_SUPPORTED_FOR_PROFILE", "train.model.type"), ("TDC_MODEL_UNSUPPORTED", "train_tdc.model.type")],
        [("RUNTIME_SCHEMA_INVALID", "pipeline/config")]]


def test_null_and_empty_configs_and_no_key(spark):
    assert codes(spark, [None, {}]) == [[("MISSING_MODEL_TYPE", "train.model.type")]] * 2
    no_key = {k: v for k, v in BASE.items() if k != "curate.smiles_column"}
    assert codes(spark, [no_key], probe=R.Probe(columns=("y",))) == [[("SMILES_COLUMN_MISSING", "curate.smiles_column")]]
    assert codes(spark, [no_key], probe=R.Probe()) == [[]]
    empty = spark.createDataFrame([], "config map<string,string>")
    assert R.with_issues(empty, REG).count() == 0


def test_every_rule_is_tripped_and_facts_are_known(spark):
    seen = {c for _, want in TRIPS for c, _ in want} | {
        "LABEL_IC50_SOURCE_COLUMNS_MISSING", "CURATE_LABEL_IC50_SOURCE_DROPPED", "LABEL_MAPPING_REQUIRED", "SMILES_COLUMN_MISSING",
        "TDC_MODEL_UNSUPPORTED"}
    assert {r.code.removeprefix("DOE_") for r in R.CATALOGUE} <= seen
    with pytest.raises(ValueError, match="unknown fact"):
        R.with_issues(spark.createDataFrame([], "config map<string,string>"), REG, rules=(R.Rule("X", "p", "m", when=("sunny",)),))


def test_rules_are_one_projection_of_the_scan(spark):
    plan = R.with_issues(spark.range(5).select(F.create_map(F.lit("a"), F.lit("b")).alias("config")), REG, PROBE) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
