"""A versioned model store on a shared folder: what fitting learned, the frozen threshold and a manifest that is written last.

A version is staged beside the others and renamed to its number when it is whole, so a reader never sees half a model. Estimators go
through the ML writer; transforms, calibrators and cards are rows of a table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.engineer import EngineerState, ScalerState
from plumbline.operators.models import Candidate, FittedModel, Space
from plumbline.operators.scorecard import Scorecard
from plumbline.sources import paths

_LOADERS = {"logistic": LogisticRegressionModel, "gbt": GBTClassificationModel, "forest": RandomForestClassificationModel}
PARTS = "part string, content string"
MANIFEST = "name string, version int, kind string, threshold double, metadata string, parts array<string>, saved_at timestamp"


@dataclass(frozen=True)
class Stored:
    """A model with what it was published with."""

    model: FittedModel | Scorecard
    version: int
    threshold: float
    metadata: dict


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """The versions that are whole, in ascending order."""
    found = [v for v in paths.children(spark, f"{root}/{name}") if v.startswith("v=")]
    return sorted(int(v[2:]) for v in found if paths.exists(spark, f"{root}/{name}/{v}/manifest/_SUCCESS"))


def save(spark: SparkSession, root: str, name: str, model: FittedModel | Scorecard, threshold: float, metadata: dict | None = None) -> int:
    """Publishes the next version and returns its number. One writer for each name at a time."""
    taken = [int(v[2:]) for v in paths.children(spark, f"{root}/{name}") if v.startswith("v=")]
    version = max(taken, default=0) + 1
    stage = f"{root}/{name}/staged-{uuid.uuid4().hex}"
    if isinstance(model, Scorecard):
        kind = "scorecard"
        # rules are expressions of the code; their names and inputs tie the stored threshold to them
        parts = {"rules": {n: list(r.inputs) for n, r in model.rules.items()}, "card": {"bands": model.bands, "band_minimum": model.band_minimum, "base_rate": model.base_rate, "lift_multiplier": model.lift_multiplier}}
    else:
        kind = model.candidate.kind
        parts = {"candidate": asdict(model.candidate), "engineer": asdict(model.engineer), "scaler": model.scaler and asdict(model.scaler), "inputs": model.inputs}
        model.model.write().save(f"{stage}/estimator")
    spark.createDataFrame([(k, json.dumps(v)) for k, v in parts.items()], PARTS).coalesce(1).write.parquet(f"{stage}/state")
    manifest = spark.createDataFrame([(name, version, kind, float(threshold), json.dumps(metadata or {}), sorted(parts), None)], MANIFEST)
    manifest.withColumn("saved_at", F.current_timestamp()).write.json(f"{stage}/manifest")
    paths.move(spark, stage, f"{root}/{name}/v={version}")
    return version


def load(spark: SparkSession, root: str, name: str, version: int | None = None, cards: dict[str, Scorecard] | None = None) -> Stored:
    """The given version, or the newest whole one. A card is found among cards by name and refused if its rules are others than those saved."""
    known = versions(spark, root, name)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no version {'' if version is None else version} of {name} below {root}")
    version = known[-1] if version is None else version
    path = f"{root}/{name}/v={version}"
    m = spark.read.schema(MANIFEST).json(f"{path}/manifest").first()
    parts = {r["part"]: json.loads(r["content"]) for r in spark.read.schema(PARTS).parquet(f"{path}/state").collect()}
    if sorted(parts) != sorted(m["parts"]):
        raise ValueError(f"{path} lacks parts that its manifest names")
    metadata = json.loads(m["metadata"])
    if m["kind"] == "scorecard":
        card = (cards or {}).get(name)
        if card is None or {n: list(r.inputs) for n, r in card.rules.items()} != parts["rules"]:
            raise ValueError(f"the rules of card {name} are not those of version {version}")
        return Stored(replace(card, threshold=m["threshold"], **parts["card"]), version, m["threshold"], metadata)
    c, e, s = parts["candidate"], parts["engineer"], parts["scaler"]
    candidate = Candidate(c["name"], c["kind"], c["params"], c["scale"], {k: Space(**{**v, "choices": tuple(v["choices"])}) for k, v in c["search"].items()})
    engineer = EngineerState(tuple(e["columns"]), e["caps"], e["medians"], tuple(e["log_scale"]), {k: tuple(v) for k, v in e["levels"].items()})
    fitted = FittedModel(candidate, engineer, s and ScalerState(s["mean"], s["scale"]), _LOADERS[m["kind"]].load(f"{path}/estimator"), parts["inputs"])
    return Stored(fitted, version, m["threshold"], metadata)


def manifests(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row for each whole version."""
    at = [f"{root}/{name}/v={v}/manifest" for v in versions(spark, root, name)]
    return spark.read.schema(MANIFEST).json(at) if at else spark.createDataFrame([], MANIFEST)
