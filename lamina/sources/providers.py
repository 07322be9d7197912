"""Model answers as a column: recorded ones by join, live ones by a batch function in the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import answers


class Model(Protocol):
    """(prompts, images) -> one response each, in order; missing outputs are empty strings."""

    def __call__(self, prompts: list[str], images: list[bytes | None]) -> list[str]: ...


@lru_cache(maxsize=1)
def loaded(factory: Callable[[], Model]) -> Model:
    """The worker's model, made on first use and kept while the worker lives."""
    return factory()


def infer(requests: DataFrame, factory: Callable[[], Model], end: str = "", batch: int = 32) -> DataFrame:
    """requests (prompt, image, ...) with raw_response and error; every row keeps its own key.

    A batch that fails leaves its error in its rows; others go on.
    """
    schema = requests.drop("image").schema.add("raw_response", "string").add("error", "string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(factory)
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                pictures = [None if x is None else bytes(x) for x in part["image"]] if "image" in part else [None] * len(part)
                try:
                    found, error = list(model(list(part["prompt"]), pictures)), None
                    found += [""] * (len(part) - len(found))
                except Exception as e:  # kept per row
                    found, error = [None] * len(part), f"{type(e).__name__}: {e}"
                told = [x if x is None or not end else x.replace(end, "") for x in found]
                yield part.drop(columns="image", errors="ignore").assign(raw_response=told, error=error)

    return requests.mapInPandas(run, schema)


def recorded(requests: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """requests with the recorded raw_response of the same keys."""
    return requests.join(responses.select(*keys, "raw_response"), keys, "left")


def first_pass(pages: DataFrame, factory: Callable[[], Model], end: str = "") -> DataFrame:
    """Pages with the model's markup."""
    return infer(pages.withColumn("prompt", F.lit(answers.FIRST_PASS)), factory, end).drop("prompt")


def second_pass(contexts: DataFrame, factory: Callable[[], Model], end: str = "") -> DataFrame:
    """Elements (element_type, context, image crop) with the model's answer."""
    return infer(answers.with_prompts(contexts), factory, end)
