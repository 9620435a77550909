"""Appended loads in levels: which of them to write together, so that few are left.

New loads are of level 0. When ``FAN`` loads of one level stand in a row, they
become one load of the next. So n appends leave at most ``FAN`` - 1 loads for
each digit that n has in base ``FAN``, and every row is rewritten as often as
there are digits.
"""

from __future__ import annotations

FAN = 8


def due(loads: list[dict], fan: int = FAN) -> list[dict] | None:
    """The oldest ``fan`` appended loads of one level that stand in a row; None when there are none.

    Loads between merges stay between them: a merge counts for the rows before
    it, and not for those after.
    """
    start = 0
    for at, load in enumerate(loads):
        first = loads[start]
        if load["mode"] != "append" or (first["mode"], first.get("level", 0)) != ("append", load.get("level", 0)):
            start = at
        if load["mode"] == "append" and at - start + 1 == fan:
            return loads[start : at + 1]
    return None


def joined(run: list[dict], **written: object) -> dict:
    """The load that stands for several in a row."""
    return {
        "mode": "append",
        "version": run[-1]["version"],
        "rows": sum(load["rows"] for load in run),
        "level": run[0].get("level", 0) + 1,
        **written,
    }
