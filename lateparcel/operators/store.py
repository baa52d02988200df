"""Saved form of the models that are not MLlib's: a folder of Parquet tables.

``parts`` has one row for every field of the model and, where a field is a list (trees, stumps), one
for every entry, as JSON text that names its class. Frames that a model holds (points of neighbours)
are tables of their own.
"""

from __future__ import annotations

import dataclasses
import json
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lateparcel.operators import boosting, extra_trees, forest, lockstep, neighbours, stumps

_KINDS = {
    kind.__name__: kind
    for kind in (
        boosting.Boosted, boosting.Binning, boosting.Loss, boosting.Tree, extra_trees.Forest,
        extra_trees.Grown, stumps.StumpsModel, stumps.Stump, lockstep.Machine, lockstep.Kernel,
        neighbours.NeighboursModel, neighbours.Cells, forest.CellForest,
    )
}


def _told(value: Any) -> Any:
    if dataclasses.is_dataclass(value):
        return {"kind": type(value).__name__} | {
            f.name: _told(getattr(value, f.name)) for f in dataclasses.fields(value)
        }
    if isinstance(value, np.ndarray):
        return {"kind": "array", "type": str(value.dtype), "shape": value.shape, "values": value.ravel().tolist()}
    if isinstance(value, tuple):
        return {"kind": "tuple", "values": [_told(v) for v in value]}
    if isinstance(value, list):
        return [_told(v) for v in value]
    return value.item() if isinstance(value, np.generic) else value


def _read(value: Any) -> Any:
    if isinstance(value, list):
        return [_read(v) for v in value]
    if not isinstance(value, dict):
        return value
    kind = value["kind"]
    if kind == "array":
        return np.array(value["values"], value["type"]).reshape(value["shape"])
    if kind == "tuple":
        return tuple(_read(v) for v in value["values"])
    return _KINDS[kind](**{k: _read(v) for k, v in value.items() if k != "kind"})


def save(spark: SparkSession, model: Any, path: str) -> None:
    """Write a model, over what was there."""
    if type(model).__name__ not in _KINDS:
        raise ValueError(f"no saved form of {type(model).__name__}")
    rows = [("", -1, json.dumps(type(model).__name__))]
    for field in dataclasses.fields(model):
        value = getattr(model, field.name)
        if isinstance(value, DataFrame):
            value.write.mode("overwrite").parquet(f"{path}/{field.name}")
            rows.append((field.name, -2, ""))
        elif isinstance(value, list):
            rows.append((field.name, -3, ""))
            rows += [(field.name, i, json.dumps(_told(v))) for i, v in enumerate(value)]
        else:
            rows.append((field.name, -1, json.dumps(_told(value))))
    parts = spark.createDataFrame(rows, "field string, position int, text string")
    parts.write.mode("overwrite").parquet(f"{path}/parts")


def load(spark: SparkSession, path: str) -> Any:
    """The model that ``save`` wrote."""
    kind, fields = None, {}
    rows = spark.read.parquet(f"{path}/parts").collect()
    for field, position, text in sorted((tuple(r) for r in rows), key=lambda r: r[:2]):
        if not field:
            kind = _KINDS[json.loads(text)]
        elif position == -3:
            fields[field] = []
        elif position == -2:
            fields[field] = spark.read.parquet(f"{path}/{field}")
        elif position == -1:
            fields[field] = _read(json.loads(text))
        else:
            fields[field].append(_read(json.loads(text)))
    return kind(**fields)
