"""Keeps a caller's columns apart from those that an operator makes for itself."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apart(results: Sequence[str], roles: Sequence[str]) -> Callable:
    """Runs an operator on renamed columns and gives the caller's names back.

    The operator's first argument is a table; ``roles`` are the parameters that name
    columns of it. Inside, every column has a name that begins with ``in_``, so no
    helper or result of the operator can meet one of the caller's, whatever its
    name or case. A column named like one of ``results`` (in any case) is
    replaced, unless it plays a role. Columns come back in their order, then the rest.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(operator)
        table = next(iter(signature.parameters))

        @functools.wraps(operator)
        def run(*args, **options) -> DataFrame:
            given = signature.bind(*args, **options)
            given.apply_defaults()
            docs = given.arguments[table]
            names = docs.columns
            places = {role: _place(names, given.arguments[role]) for role in roles}
            inner = [f"in_{k}" for k in range(len(names))]
            taken = {name.lower() for name in results}
            kept = [k for k, name in enumerate(names) if k in places.values() or name.lower() not in taken]
            given.arguments[table] = docs.toDF(*inner).select(*[inner[k] for k in kept])
            given.arguments.update({role: inner[k] for role, k in places.items()})
            out = operator(*given.args, **given.kwargs)
            new = [name for name in out.columns if name not in inner]
            back = {inner[k]: names[k] for k in kept if inner[k] in out.columns and names[k] not in new}
            return out.select(*[F.col(a).alias(b) for a, b in back.items()], *[F.col(f"`{name}`") for name in new])

        return run

    return wrap


def _place(names: Sequence[str], name: str) -> int:
    """Where a column stands; by its name, else by its name in any case."""
    if name in names:
        return list(names).index(name)
    alike = [k for k, own in enumerate(names) if own.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"no single column {name!r} among {list(names)}")
    return alike[0]
