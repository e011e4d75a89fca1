"""Stored model bundles: train once, score later.

A bundle root holds versions side by side::

    <root>/v-000003-5f1c.../models/0 ...   fold models
                            medians        training medians (Parquet, one row)
                            calibrator     intercept and slope, if there is one
                            contract       JSON: label, ordered features, models
                            _COMPLETE      SHA-256 of the contract, written last

A version without its marker does not exist for readers, so a job that dies
while it saves changes nothing, and a finished one becomes current with one
small file.  The calibrator belongs to its ensemble; no other is looked up.

Loading takes the first of several ordered places that holds a complete
bundle (or a single saved model, if its features are given), checks the
contract's hash and every model's width, and never pads or truncates.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession

from pitwall.operators.trees import Ensemble
from pitwall.sources.files import file_text, first_existing, hadoop_path, write_file_text

MARKER = "_COMPLETE"
THREADS = 5   # fold models saved or loaded at once


def _digest(contract: str) -> str:
    return hashlib.sha256(contract.encode()).hexdigest()


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions of a root, newest first."""
    fs, path = hadoop_path(spark, root)
    if not fs.exists(path):
        return []
    names = sorted((s.getPath().getName() for s in fs.listStatus(path)), reverse=True)
    return [f"{root}/{n}" for n in names if n.startswith("v-") and first_existing(spark, [f"{root}/{n}/{MARKER}"])]


def save_bundle(ens: Ensemble, root: str) -> str:
    """Writes ``ens`` as the newest version under ``root``; returns its folder."""
    spark = SparkSession.getActiveSession()
    fs, path = hadoop_path(spark, root)
    last = max([int(s.getPath().getName().split("-")[1]) for s in fs.listStatus(path)
                if s.getPath().getName().startswith("v-")], default=0) if fs.exists(path) else 0
    folder = f"{root}/v-{last + 1:06d}-{uuid.uuid4().hex[:8]}"
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(lambda im: im[1].write().save(f"{folder}/models/{im[0]}"), enumerate(ens.models)))
    if ens.medians is not None:
        ens.medians.coalesce(1).write.parquet(f"{folder}/medians")
    if ens.calibrator is not None:
        ens.calibrator.coalesce(1).write.parquet(f"{folder}/calibrator")
    contract = json.dumps({"label": ens.label, "features": list(ens.features), "models": len(ens.models),
                           "medians": ens.medians is not None, "calibrated": ens.calibrator is not None})
    write_file_text(spark, f"{folder}/contract", contract)
    write_file_text(spark, f"{folder}/{MARKER}", _digest(contract))
    return folder


def find_bundle(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first candidate that holds a complete bundle (its newest
    version) or a saved model; an error names all places looked at."""
    for place in candidates:
        if first_existing(spark, [f"{place}/{MARKER}", f"{place}/metadata"]):
            return place
        versions = _versions(spark, place)
        if versions:
            return versions[0]
    raise FileNotFoundError(f"no complete model bundle in any of {list(candidates)}")


def _check_width(model, features: Sequence[str], where: str) -> None:
    if model.numFeatures != len(features):
        raise ValueError(f"{where}: the model takes {model.numFeatures} features, the contract names {len(features)}")


def load_bundle(spark: SparkSession, candidates: Sequence[str], features: Sequence[str] | None = None) -> Ensemble:
    """The ensemble of ``find_bundle``.  ``features`` is only for a single
    saved model, which has no contract of its own."""
    folder = find_bundle(spark, candidates)
    if not first_existing(spark, [f"{folder}/{MARKER}"]):
        if features is None:
            raise ValueError(f"{folder} is a single model: its ordered features must be given")
        model = GBTRegressionModel.load(folder)
        _check_width(model, features, folder)
        return Ensemble([model], tuple(features), None, folder=folder)
    text = file_text(spark, f"{folder}/contract")
    if _digest(text) != file_text(spark, f"{folder}/{MARKER}"):
        raise ValueError(f"{folder}: the contract is not the one the bundle was completed with")
    contract = json.loads(text)
    places = [f"{folder}/models/{i}" for i in range(contract["models"])]
    with ThreadPoolExecutor(THREADS) as pool:
        models = list(pool.map(GBTRegressionModel.load, places))
    for m, where in zip(models, places):
        _check_width(m, contract["features"], where)

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    return Ensemble(models, tuple(contract["features"]), table("medians") if contract["medians"] else None,
                    label=contract["label"], calibrator=table("calibrator") if contract["calibrated"] else None,
                    folder=folder)
