"""Switch parsing for write options."""

from __future__ import annotations

from typing import Any

# The spellings the reference accepts as "on" for a switch.
TRUE_SPELLINGS = (True, "True", "true")


def parse_flag(value: Any) -> bool:
    """``True``, ``"True"`` and ``"true"`` (and ``1``, which equals ``True``)
    switch a feature on; anything else leaves it off."""
    return any(value == spelling for spelling in TRUE_SPELLINGS)
