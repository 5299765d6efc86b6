"""The sample of the training query."""

import inspect

import checks.queries  # noqa: F401
from checks.base import ORACLES
from reclink.operators import training as L


def test_the_sample_is_not_cut():
    wanted = inspect.signature(L.training_sample).parameters["n"].default
    assert f"limit {wanted}" in ORACLES["training_sample"] and wanted == 10_000
