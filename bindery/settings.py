"""Settings of a stage, read from the annotations of its keyword arguments.

int, float, str, bool, list[str] and Literal are understood as they are; Annotated adds rules, each a condition and what it
asks for. An argument without a default has to be given.
"""

from __future__ import annotations

import inspect
import math
import typing
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Annotated, Any, Literal, get_args, get_origin


class ConfigError(ValueError):
    """A setting is missing or wrong, or a stage needs a format that nothing gives."""


@dataclass(frozen=True)
class Rule:
    holds: Callable[[Any], bool]
    asks: str


def _bases(most: int | None = None, least: int = 1) -> Rule:
    return Rule(lambda x: least <= len(x) <= (most or len(x)) and set(x) <= set("ACGT"), "one of A, C, G, T" if most == 1 else "letters A, C, G, T")


#: Text that is read as DNA: upper case, T for U.
_DNA = "dna"
Count = Annotated[int, Rule(lambda x: x >= 0, "a whole number from 0 on")]
Amount = Annotated[float, Rule(lambda x: x >= 0 and math.isfinite(x), "a number from 0 on")]
Base = Annotated[str, _DNA, _bases(1)]
Dna = Annotated[str, _DNA, _bases()]
MaybeDna = Annotated[str, _DNA, _bases(least=0)]

#: Words of YAML for truth.
TRUTH = {"yes": True, "true": True, "on": True, "1": True, "no": False, "false": False, "off": False, "0": False, "": False}


def convert(value: Any, kind: Any) -> Any:
    """A raw value as its annotation asks; ValueError if that cannot be."""
    rules: tuple = ()
    if get_origin(kind) is Annotated:
        kind, *rules = get_args(kind)
    if get_origin(kind) is Literal:
        if value not in get_args(kind):
            raise ValueError(f"one of {', '.join(map(str, get_args(kind)))} is expected")
        return value
    if kind == list[str]:
        return [x for x in (p.strip() for p in value.split(",")) if x] if isinstance(value, str) else [str(x) for x in value]
    if kind is bool:
        if str(value).lower() not in TRUTH:
            raise ValueError("yes or no is expected")
        return TRUTH[str(value).lower()]
    if kind is int and isinstance(value, float) and value != int(value):
        raise ValueError("a whole number is expected")
    out = kind(value)
    for rule in rules:
        if rule == _DNA:
            out = out.upper().replace("U", "T")
        elif not rule.holds(out):
            raise ValueError(f"{rule.asks} expected")
    return out


def fields(run: Callable) -> dict[str, inspect.Parameter]:
    """The keyword-only arguments of a function, with their annotations resolved."""
    hints = typing.get_type_hints(run, include_extras=True)
    return {n: p.replace(annotation=hints.get(n, str)) for n, p in inspect.signature(run).parameters.items() if p.kind is p.KEYWORD_ONLY}


def read(config: Mapping[str, Any], known: Mapping[str, inspect.Parameter], where: str = "") -> dict[str, Any]:
    """Values for all arguments; settings that are unknown, missing or wrong raise, all of them at once."""
    wrong = [f"unknown setting {n!r}" for n in sorted(set(config) - set(known))]
    out: dict[str, Any] = {}
    for name, p in known.items():
        if name in config:
            try:
                out[name] = convert(config[name], p.annotation)
            except (ValueError, TypeError) as e:
                wrong.append(f"{name!r} cannot be {config[name]!r}: {e}")
        elif p.default is p.empty:
            wrong.append(f"{name!r} has to be given")
        else:
            out[name] = list(p.default) if p.annotation == list[str] else p.default
    if wrong:
        raise ConfigError(f"{where}: {'; '.join(wrong)}")
    return out
