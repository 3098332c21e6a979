"""SQL fragments over a sorted ``array<double>`` column.

They are strings, not Columns, because most are used inside a lambda over ensemble members,
where the searched value is a lambda variable. Lookups take O(log size) steps.
"""

from __future__ import annotations

import itertools

_names = itertools.count()


def _search(arr: str, x: str, op: str) -> str:
    """Index of the last element with ``element op x``; -1 where there is none.

    The index grows by halving powers of two; ``get`` is NULL past the end, which stops it.
    """
    tag = next(_names)
    at, bit = f"at{tag}", f"bit{tag}"
    jump = f"({at} + shiftleft(1, {bit}))"
    bits = f"sequence(cast(floor(log2(greatest(size({arr}), 1))) as int), 0, -1)"
    return f"aggregate({bits}, -1, ({at}, {bit}) -> if(get({arr}, {jump}) {op} {x}, {jump}, {at}))"


def last_at_most(arr: str, x: str) -> str:
    return _search(arr, x, "<=")


def last_below(arr: str, x: str) -> str:
    return _search(arr, x, "<")


def midpoint(arr: str, i: str, n: str) -> str:
    """Quantile at i/(n+1), the mean of the two order statistics around it.

    Positions are whole-number arithmetic, so no rounding moves them to a neighbour.
    """
    scaled = f"(cast({i} as bigint) * (size({arr}) - 1))"
    below = f"{scaled} div ({n} + 1)"
    above = f"({scaled} + {n}) div ({n} + 1)"  # rounded up
    return f"((get({arr}, cast({below} as int)) + get({arr}, cast({above} as int))) / 2)"


def knot(arr: str, k: str, n: str) -> str:
    """Knot ``k`` (0-based) of ``knots``, without the others."""
    return midpoint(arr, f"({k} + 1)", n)


def _search_knots(arr: str, n: str, x: str, op: str) -> str:
    """Like ``_search`` over ``knots(arr, n)``, of which only those looked at are computed."""
    tag = next(_names)
    at, bit = f"at{tag}", f"bit{tag}"
    jump = f"({at} + shiftleft(1, {bit}))"
    bits = f"sequence(cast(floor(log2({n})) as int), 0, -1)"
    return f"aggregate({bits}, -1, ({at}, {bit}) -> if({jump} < {n} and {knot(arr, jump, n)} {op} {x}, {jump}, {at}))"


def last_knot_at_most(arr: str, n: str, x: str) -> str:
    return _search_knots(arr, n, x, "<=")


def last_knot_below(arr: str, n: str, x: str) -> str:
    return _search_knots(arr, n, x, "<")


def knots(arr: str, n: str) -> str:
    """The n quantiles at 1/(n+1) ... n/(n+1)."""
    i = f"i{next(_names)}"
    return f"transform(sequence(1, cast({n} as int)), {i} -> {midpoint(arr, i, n)})"


def total(arr: str) -> str:
    tag = next(_names)
    return f"aggregate({arr}, 0.0D, (s{tag}, v{tag}) -> s{tag} + v{tag})"


def squares_about(arr: str, centre: str) -> str:
    tag = next(_names)
    return (
        f"aggregate({arr}, 0.0D, (s{tag}, v{tag}) -> "
        f"s{tag} + (v{tag} - {centre}) * (v{tag} - {centre}))"
    )


def more_distinct_than(arr: str, k: str) -> str:
    """Whether there are more than ``k`` distinct values, by hopping over runs of equal ones."""
    at = f"at{next(_names)}"
    hop = f"{last_at_most(arr, f'get({arr}, {at})')} + 1"
    hops = f"aggregate(sequence(1, {k}), 0, ({at}, hop) -> if({at} >= size({arr}), {at}, {hop}))"
    return f"({hops} < size({arr}))"
