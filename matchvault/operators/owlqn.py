"""The search for a minimum that Spark's linear models use (Breeze's OWL-QN without an L1 part), over any function.

Spark's own runs on vectors that it keeps in blocks; this one asks for value and gradient at a point and takes the same steps.
"""

import numpy as np

MEMORY = 10  # steps remembered
VALUES = 20  # values looked back on
SEARCHES = 20


class _Failed(Exception):
    pass


def _direction(gradient, steps):
    out = gradient.copy()
    if steps:
        s, y = steps[0]
        sy = s @ y
        if not sy >= 0:
            raise _Failed
        scale, shares = sy / (y @ y), []
        for s, y in steps:
            share = (s @ out) / (s @ y)
            if np.isnan(share):
                raise _Failed
            shares.append(share)
            out -= share * y
        out *= scale
        for (s, y), share in zip(reversed(steps), reversed(shares)):
            out += (share - (y @ out) / (s @ y)) * s
    return np.where(-out * gradient < 0, -out, 0.0)


def _taken(x, gradient, direction, length):
    """The step, as far as no entry changes its sign; one that is zero may go against its gradient."""
    to, sign = x + direction * length, np.where(x != 0, np.sign(x), np.sign(-gradient))
    return to * (np.sign(to) == sign)


def _length(value_at, x, value, gradient, direction, first):
    """A step length under the strong Wolfe conditions, by shrinking and growing.

    Breeze takes the value at the first length for that at ``x``, so it shrinks the first length whatever is found there;
    it is not asked for here.
    """
    slope_0 = gradient @ direction

    def at(length):
        v, g = value_at(_taken(x, gradient, direction, length))
        return v, g @ direction

    length, shrink = (0.5 / np.linalg.norm(gradient), 0.1) if first else (1.0, 0.5)
    v, slope = value, None
    for search in range(SEARCHES):
        if v > value + length * slope_0 * 1e-4:
            times = shrink
        else:
            slope = at(length)[1] if slope is None else slope
            if slope < 0.9 * slope_0:
                times = 2.1
            elif slope > -0.9 * slope_0:
                times = shrink
            else:
                break
        if not 1e-10 <= length * times <= 1e10:
            raise _Failed
        if search + 1 < SEARCHES:
            length *= times
            v, slope = at(length)
    return length


def minimum(value_and_gradient, start, rounds, tolerance):
    """``(point, values by round)`` of the search from ``start``."""
    last = []

    def value_at(x):
        if not last or not np.array_equal(last[0], x):
            last[:] = [x, value_and_gradient(x)]
        return last[1]

    with np.errstate(divide="ignore", invalid="ignore"):
        return _search(value_at, np.asarray(start, float), rounds, tolerance)


def _search(value_at, x, rounds, tolerance):
    value, gradient = value_at(x)
    first, steps, values, n, failed = value, [], [value], 0, False
    recent = [np.inf]
    while n < rounds:
        if n and abs(value - max(recent)) <= tolerance * abs(first) and len(recent) >= 2:
            break
        if np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            break
        try:
            direction = _direction(gradient, steps)
            length = _length(value_at, x, value, gradient, direction, n < 1)
            to = _taken(x, gradient, direction, length)
            found, slope = value_at(to)
        except _Failed:
            if failed:
                break
            failed, steps = True, []
            continue
        steps = [(to - x, slope - gradient), *steps][:MEMORY]
        x, value, gradient, n, failed = to, found, slope, n + 1, False
        recent = [*recent, value][-VALUES:]
        values.append(value)
    return x, values
