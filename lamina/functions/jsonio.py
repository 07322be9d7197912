"""Strict JSON: what the built-in parsers accept too leniently is refused here."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def _object(text: str | None) -> str | None:
    try:
        found = json.loads(text) if text is not None else None
    except ValueError:
        return None
    return json.dumps(found, ensure_ascii=False) if isinstance(found, dict) else None


@pandas_udf(T.StringType())
def strict_object(text: pd.Series) -> pd.Series:
    """The text of a JSON object in normal form (a repeated key's last value); null for anything else."""
    return text.map(_object)


def loose_object(text: Column) -> Column:
    """The first brace group without an inner closing brace that is a strict JSON object.

    Groups end at the first closing brace, so a nested answer mostly yields nothing.
    """
    groups = F.regexp_extract_all(text, F.lit(r"(?s)(\{[^}]*\})"), F.lit(1))
    return strict_first(groups)


@pandas_udf(T.StringType())
def strict_first(groups: pd.Series) -> pd.Series:
    return groups.map(lambda g: next((o for o in map(_object, g if g is not None else []) if o is not None), None))


def field(text: Column, path: str) -> Column:
    """A JSON field as string; null when missing."""
    return F.get_json_object(text, path)
