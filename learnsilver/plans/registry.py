"""The models by name: their inputs, their layer, and how to build them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from learnsilver.functions.columns import widen
from learnsilver.schemas import CONTRACTS, MODELS, Contract


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    stamped: bool

    @property
    def contract(self) -> Contract:
        return MODELS[self.name]

    @property
    def layer(self) -> str:
        return layer_of(self.name)


REGISTRY: dict[str, Model] = {}


def layer_of(name: str) -> str:
    """Raw tables, staging views and silver tables, told apart by name."""
    if name.startswith("stg_"):
        return "staging"
    return "silver" if name in MODELS else "raw"


def model(*inputs: str, stamped: bool = False):
    """Register a function as the model of its name.

    The function takes one DataFrame per input; a stamped one also takes
    ``run_ts``, an expression for the load time it writes into its rows.
    """

    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REGISTRY[build.__name__] = Model(build.__name__, inputs, build, stamped)
        return build

    return register


def build_model(
    name: str,
    read: Callable[[str], DataFrame],
    run_ts: str = "current_timestamp()",
    **options,
) -> DataFrame:
    """Build a model lazily; ``read`` returns the table or view of a given name.

    Inputs that lack optional columns get them as typed NULLs. Options go to
    the model function.
    """
    found = REGISTRY[name]
    if found.stamped:
        options["run_ts"] = run_ts
    return found.build(*[widen(read(i), CONTRACTS[i]) for i in found.inputs], **options)
