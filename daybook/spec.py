"""Feature spec of a prepared sequence example and the schemas derived from it.

One declarative list drives the Spark schemas (compute-time doubles and
export-time floats), the validation rules and the schema file written beside
an export.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source pipeline's for identical output.
# ---------------------------------------------------------------------------
SEQ_LEN = 31
SCALAR_STRING_FEATURES = ["item_description"]
SCALAR_INT_FEATURES = ["item_id", "year", "month", "last_valid_day"]
SCALAR_FLOAT_FEATURES = ["volume_ml", "pack_size", "cost", "retail"]
ONE_DIM_INT_FEATURES = ["day", "valid_day"]
ONE_DIM_FLOAT_FEATURES = ["cumu_bottles_sold", "daily_bottles_sold", "total_packs_sold"]
TARGET = "total_packs_sold"
TRAIN_PREFIX = "train"
TEST_PREFIX = "test"
TRAIN_SHARDS = 4
TEST_SHARDS = 1
SCALED_FEATURES = ["volume_ml", "pack_size"]
ERROR_CLASSES = ["AssertionErrors", "KeyErrors", "TypeErrors", "ValueErrors", "other_errors"]
# Columns fed to the sequence model, in its input order.
MODEL_TILED_FEATURES = ["item_id", "month", "cost", "retail", "pack_size"]
MODEL_SEQUENCE_FEATURES = ["cumu_bottles_sold", "daily_bottles_sold", "total_packs_sold"]
# ---------------------------------------------------------------------------
# What a per-step model reads: the model's columns without the target.
STEP_FEATURES = [c for c in MODEL_TILED_FEATURES + MODEL_SEQUENCE_FEATURES if c != TARGET]


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str  # "string" | "int" | "float"
    length: int | None  # None for a scalar, SEQ_LEN for a sequence

    def compute_type(self) -> T.DataType:
        base = {"string": T.StringType(), "int": T.LongType(), "float": T.DoubleType()}[self.kind]
        return base if self.length is None else T.ArrayType(base, True)

    def export_type(self) -> T.DataType:
        base = {"string": T.StringType(), "int": T.LongType(), "float": T.FloatType()}[self.kind]
        return base if self.length is None else T.ArrayType(base, True)


FEATURES: list[Feature] = (
    [Feature(n, "string", None) for n in SCALAR_STRING_FEATURES]
    + [Feature(n, "int", None) for n in SCALAR_INT_FEATURES]
    + [Feature(n, "float", None) for n in SCALAR_FLOAT_FEATURES]
    + [Feature(n, "int", SEQ_LEN) for n in ONE_DIM_INT_FEATURES]
    + [Feature(n, "float", SEQ_LEN) for n in ONE_DIM_FLOAT_FEATURES]
)
FEATURE_NAMES = [f.name for f in FEATURES]
SEQUENCE_FEATURES = [f.name for f in FEATURES if f.length is not None]


def prepared_schema() -> T.StructType:
    """Schema of prepared rows while they are computed (doubles)."""
    return T.StructType([T.StructField(f.name, f.compute_type(), False) for f in FEATURES])


def export_schema() -> T.StructType:
    """Schema of exported examples (float32 like the serialized examples)."""
    return T.StructType([T.StructField(f.name, f.export_type(), False) for f in FEATURES])


def schema_document() -> str:
    """Human- and machine-readable schema stored beside every export."""
    doc = {
        "seq_len": SEQ_LEN,
        "target": TARGET,
        "features": [
            {"name": f.name, "type": f.kind, "shape": [] if f.length is None else [f.length], "presence": 1.0}
            for f in sorted(FEATURES, key=lambda f: f.name)
        ],
        "spark_schema": json.loads(export_schema().json()),
    }
    return json.dumps(doc, indent=2, sort_keys=True)


def schema_from_document(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text)["spark_schema"])
