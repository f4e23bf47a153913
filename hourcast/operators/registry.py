"""Model registry: versioned folders and a pointer that is swapped last.

``<root>/models/aqi_model_<h>h/versions/<version>/`` holds a model and its metadata, and
is never written again once complete. ``<root>/models/aqi_model_<h>h/LATEST`` names the
current version; it is written beside and renamed over the old one, which the file system
does in one step. A writer that dies earlier leaves an unnamed folder and the old pair in
force; a reader that has read the pointer reads one version throughout."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.ml import PipelineModel

from hourcast.operators import boosting, forest
from hourcast.operators.linear import LinearModel
from hourcast.schema import LOOKBACK_WINDOW, MODEL_METADATA_SCHEMA, feature_columns


def _home(root: str, horizon: int) -> str:
    return os.path.join(root, f"models/aqi_model_{horizon}h")


def _fs(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _point(spark, home: str, version: str) -> None:
    """Swap the pointer: a rename over the old one."""
    jvm = spark._jvm
    new = os.path.join(home, f".LATEST-{version}")
    _write_text(spark, new, version)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, new)[0].getUri(), spark._jsc.hadoopConfiguration())
    option = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = option
    context.rename(jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(os.path.join(home, "LATEST")), options)


def model_type(model) -> str:
    return {LinearModel: "linear", boosting.Booster: "boosted", forest.Forest: "forest"}.get(type(model), "spark_ml")


def _write_model(spark, model, path: str) -> None:
    kind = model_type(model)
    if kind == "linear":
        _write_text(spark, os.path.join(path, "linear.json"), json.dumps(vars(model)))
    elif kind == "boosted":
        boosting.nodes_frame(spark, model).coalesce(1).write.parquet(os.path.join(path, "nodes"))
        _write_text(spark, os.path.join(path, "boosted.json"), json.dumps({"features": model.features, "base": model.base}))
    elif kind == "forest":
        model.nodes.write.parquet(os.path.join(path, "trees"))
        _write_text(spark, os.path.join(path, "forest.json"), json.dumps({"features": model.features, "trees": model.trees}))
    else:
        PipelineModel(stages=[model]).write().save(os.path.join(path, "model"))


def _read_model(spark, path: str):
    text = _read_text(spark, os.path.join(path, "linear.json"))
    if text is not None:
        return LinearModel(**json.loads(text))
    text = _read_text(spark, os.path.join(path, "boosted.json"))
    if text is not None:
        head = json.loads(text)
        return boosting.from_nodes(spark.read.parquet(os.path.join(path, "nodes")).collect(), head["features"], head["base"])
    text = _read_text(spark, os.path.join(path, "forest.json"))
    if text is not None:
        return forest.Forest(**json.loads(text), nodes=spark.read.schema(forest.TREE_SCHEMA).parquet(os.path.join(path, "trees")))
    return PipelineModel.load(os.path.join(path, "model")).stages[0]


def save_model(spark, model, root: str, horizon: int, metadata: dict) -> str:
    """Write a version and make it the current one; returns its folder."""
    home, version = _home(root, horizon), uuid.uuid4().hex
    path = os.path.join(home, "versions", version)
    _write_model(spark, model, path)
    row = {f.name: metadata.get(f.name) for f in MODEL_METADATA_SCHEMA.fields}
    spark.createDataFrame([row], MODEL_METADATA_SCHEMA).coalesce(1).write.json(os.path.join(path, "metadata"))
    _point(spark, home, version)
    return path


def with_defaults(metadata: dict, horizon: int) -> dict:
    """What readers assume where a model's metadata says nothing."""
    default = {"model_name": f"aqi_model_{horizon}h", "model_type": "sklearn", "features": feature_columns(),
               "lookback_window": LOOKBACK_WINDOW, "metrics": {}, "all_model_metrics": {}}
    return metadata | {k: v for k, v in default.items() if metadata.get(k) is None}


def latest_version(spark, root: str, horizon: int) -> str:
    version = _read_text(spark, os.path.join(_home(root, horizon), "LATEST"))
    if version is None:
        raise RuntimeError(f"metadata missing for aqi_model_{horizon}h")
    return version


def load_model(spark, root: str, horizon: int):
    """(model, metadata with defaults) of the current version."""
    path = os.path.join(_home(root, horizon), "versions", latest_version(spark, root, horizon))
    row = spark.read.schema(MODEL_METADATA_SCHEMA).json(os.path.join(path, "metadata")).first()
    if row is None:
        raise RuntimeError(f"metadata missing for aqi_model_{horizon}h")
    return _read_model(spark, path), with_defaults(row.asDict(recursive=True), horizon)
