"""Records of experiments, and labels for showing recommendations."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.fallback import LEVELS
from pairloom.output.writers import write_manifest
from pairloom.schemas import CONTRACTS, schema
from pairloom.sources.files import exists, read_text, write_text


def write_record(path: str, record: Mapping[str, Any]) -> None:
    """One experiment as JSON."""
    write_manifest(path, record)


def append_record(path: str, record: Mapping[str, Any]) -> None:
    """Add a row to a CSV table in any store; columns that it doesn't have yet are added for all rows.

    The table is replaced as a whole, so readers never see a part of it.
    """
    rows = list(csv.DictReader(io.StringIO(read_text(path), newline=""))) if exists(path) else []
    rows.append(dict(record))
    text = io.StringIO(newline="")
    writer = csv.DictWriter(text, list(dict.fromkeys(k for r in rows for k in r)))
    writer.writeheader()
    writer.writerows(rows)
    write_text(path, text.getvalue())


def for_display(recommendations: DataFrame) -> DataFrame:
    """Missing columns as nulls, contract types, and a readable label of each row's source."""
    types = {f.name: f.dataType for f in schema("recommendations")}
    df = recommendations.select(*[(F.col(c).cast(types[c]) if c in recommendations.columns else F.lit(None).cast(types[c])).alias(c) for c in CONTRACTS["recommendations"]])
    label = F.when(F.col("source") == "behavioral", "seen together")
    for level, source in LEVELS.items():
        label = label.when(F.col("source") == source, f"popular by {level.replace('_', ' and ')}" if level != "global" else "popular")
    return df.withColumn("source_label", label.otherwise(F.coalesce("source", F.lit("unknown"))))
