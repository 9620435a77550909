"""Names of layers and views, and tables addressed by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from learnsilver.schemas import STATEMENTS_ALIAS, STATEMENTS_TABLE

Read = Callable[[str], DataFrame]


def layer_name(layer: str, prefix: str = "") -> str:
    """Schema name of a layer, after the prefix and one underscore where there is a prefix."""
    return "_".join(part for part in (prefix.removesuffix("_"), layer) if part)


def with_alias(read: Read) -> Read:
    """A reader that also knows the statements under their second name."""
    return lambda name: read(STATEMENTS_TABLE if name == STATEMENTS_ALIAS else name)


def register_views(read: Read, names: Iterable[str]) -> None:
    """Make tables known to SQL as temporary views."""
    names = list(names)
    for name in names:
        read(name).createOrReplaceTempView(name)
    if STATEMENTS_TABLE in names:
        read(STATEMENTS_TABLE).createOrReplaceTempView(STATEMENTS_ALIAS)
