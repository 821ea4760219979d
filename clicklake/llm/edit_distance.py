"""Banded bit-parallel edit distance."""

from __future__ import annotations


def within(a, b, most: int) -> bool:
    """True when at most ``most`` inserted, deleted or replaced items (code points, words) turn ``a`` into ``b``.

    Common ends are cut off; over the rest one bit vector holds the ``2 * most + 1`` diagonals around the
    main one, and a column costs a constant number of operations on it, whatever the length.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return False
    lo, end = 0, len(b)
    while lo < end and a[lo] == b[lo]:
        lo += 1
    cut = 0
    while cut < end - lo and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    a, b = a[lo:len(a) - cut], b[lo:end - cut]
    if not b or len(a) <= most:
        return len(a) <= most
    return _band(a, b, most) <= most


def _band(a, b, most: int) -> int:
    """Distance if at most ``most``, else a larger number; ``len(a) >= len(b)`` and ``len(a) > most``.

    Bit ``width - 1`` stands for row ``column + most`` of the band, lower bits for the rows above it.
    """
    width = 2 * most + 2
    full, top, below = (1 << width) - 1, 1 << (width - 1), 1 << (width - 2)
    rows: dict = {}
    for i, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << (i + width)
    up, down = (full << (width - most - 1)) & full, 0  # vertical +1 and -1 steps
    distance, give_up = most, most + len(b) - (len(a) - most)
    for column, c in enumerate(b):
        match = (rows.get(c, 0) >> (column + most + 1)) & full
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right = (down | ~(diagonal | up)) & full
        left = diagonal & up
        if column < len(a) - most:
            distance += not diagonal & top
            if distance > give_up:
                return most + 1
        else:
            distance += bool(right & below) - bool(left & below)
            below >>= 1
        up = (left | ~((diagonal >> 1) | right)) & full
        down = (diagonal >> 1) & right
    return distance
