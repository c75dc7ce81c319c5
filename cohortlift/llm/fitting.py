"""Fit a model on a bounded sample in one task, which leaves the driver's memory alone."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlift.llm.scratch import lean


def _run(batches: Iterator[pa.RecordBatch], fit: Callable[[list, list], Any]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
    rows.sort(key=lambda r: (str(r[1]), r[0]))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit([r[0] for r in rows], [r[1] for r in rows]))], pa.binary())], ["model"])


def fit_in_task(samples: list[DataFrame], fit: Callable[[list, list], Any]) -> Any:
    """``fit(texts, labels)`` over the rows (text, label) of all ``samples``, whose sizes the caller has bounded."""
    if not samples:
        return fit([], [])
    rows = reduce(DataFrame.union, samples).repartition(1)
    found = rows.mapInArrow(lean(_run, fit=fit), "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([], [])
