"""Argument checks shared by the configuration classes."""

from __future__ import annotations

from typing import Any


def check_limits(config: Any, limits: dict[str, int]) -> None:
    """Every named field, or every element of a tuple field, must reach its limit."""

    for name, low in limits.items():
        value = getattr(config, name)
        for item in value if isinstance(value, tuple) else (value,):
            if item < low:
                raise ValueError(f"{name} must be at least {low}: {item}.")


def check_choice(name: str, value: str, choices: tuple[str, ...]) -> None:
    if value not in choices:
        raise ValueError(f"{name} must be one of {', '.join(choices)}: {value}.")


def check_shares(**shares: float) -> None:
    """Each share lies between 0 and 1, and together they leave a rest."""

    for name, share in shares.items():
        if not 0.0 < share < 1.0:
            raise ValueError(f"{name} must lie between 0 and 1: {share}.")
    if sum(shares.values()) >= 1.0:
        raise ValueError(f"{' and '.join(shares)} must leave training rows.")
