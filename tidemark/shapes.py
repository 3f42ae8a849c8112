"""Shapes of small documents: a rule per field, and a walk that names every field that breaks its rule."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

Rule = Callable[[object], bool]
Shape = dict[str, Rule]

HEX64 = "[a-f0-9]{64}"


def text(pattern: str) -> Rule:
    return lambda v: isinstance(v, str) and re.fullmatch(pattern, v) is not None


def one_of(*values: object) -> Rule:
    return lambda v: any(type(v) is type(w) and v == w for w in values)


def whole(least: int = 0) -> Rule:
    """Integers; truth values are none."""
    return lambda v: type(v) is int and v >= least


def either(*rules: Rule) -> Rule:
    return lambda v: any(r(v) for r in rules)


def listed(rule: Rule, least: int = 1, key: Callable[[object], object] | None = None) -> Rule:
    """A list of such values; with `key`, no two of the same."""
    return lambda v: (
        isinstance(v, list) and len(v) >= least and all(map(rule, v)) and (key is None or len({key(x) for x in v}) == len(v))
    )


def mapped(rule: Rule, keys: Iterable[str] | None = None) -> Rule:
    """An object with such values, under exactly these keys, or any one or more."""
    return lambda v: isinstance(v, dict) and (set(v) == set(keys) if keys is not None else bool(v)) and all(map(rule, v.values()))


def shaped(shape: Shape) -> Rule:
    return lambda v: not faults(v, shape)


def faults(document: object, shape: Shape) -> list[str]:
    """What is missing, not known, or not as its rule has it; nothing if the document has the shape."""
    if not isinstance(document, dict):
        return ["no object"]
    found = [f"{k} is not known" for k in document if k not in shape]
    for name, rule in shape.items():
        if name not in document:
            found.append(f"{name} is missing")
        elif not rule(document[name]):
            found.append(f"{name} has a wrong value")
    return found


def require(document: object, shape: Shape, what: str) -> None:
    if found := faults(document, shape):
        raise ValueError(f"{what}: {', '.join(found)}")
