"""All families in their fixed order."""

from __future__ import annotations

from functools import cache

from ..functions.expr import Expr
from . import excel, indicator, tv, wh6

FAMILIES = ("wh6", "indicator", "excel", "tv")
SIZES = {"wh6": 198, "indicator": 59, "excel": 66, "tv": 142}


@cache
def family(name: str) -> dict[str, Expr]:
    """The columns of a family, in order."""
    made = {"wh6": wh6.columns, "indicator": lambda: indicator.columns(family("wh6")), "excel": excel.columns, "tv": tv.columns}[name]()
    if len(made) != SIZES[name]:
        raise ValueError(f"{name} has {len(made)} columns, not {SIZES[name]}")
    return made


@cache
def every() -> dict[str, Expr]:
    return {k: v for f in FAMILIES for k, v in family(f).items()}


def select(names: list[str] | None = None, families: tuple[str, ...] = FAMILIES) -> dict[str, Expr]:
    """The named columns, or all of the families; unknown and repeated names are refused."""
    if names is None:
        return {k: v for f in families for k, v in family(f).items()}
    unknown = [n for n in names if n not in every()]
    if unknown or len(set(names)) != len(names):
        raise ValueError(f"unknown or repeated columns: {unknown or names}")
    return {n: every()[n] for n in names}
