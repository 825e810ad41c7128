"""Edit distance within a bound, one machine word per column of the table."""


def within(a, b, bound):
    """The edit distance of two strings if it is at most `bound`, else None.

    Only the diagonal band of 2 * bound + 1 rows can hold a small distance. Its vertical
    steps (plus or minus one) are kept as two bit masks that move down with the diagonal;
    bit i of column j stands for row j - bound + i.
    """
    rows, columns = len(a), len(b)
    if abs(rows - columns) > bound:
        return None
    if a == b:
        return 0
    if not bound:
        return None
    places = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    width = 2 * bound + 1
    full, last = (1 << width) - 1, 1 << (width - 1)
    plus, minus = full & ~((1 << (bound + 1)) - 1), 0  # rows above the first have no step
    score = min(bound, rows)  # in the lowest row of the band that the table has
    for j in range(1, columns + 1):
        plus, minus = plus >> 1 | last, minus >> 1  # the band moved down by one row
        shift = j - bound - 1
        place = places.get(b[j - 1], 0)
        equal = (place >> shift if shift >= 0 else place << -shift) & full
        level = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        right_plus = (minus | ~(level | plus)) & full
        right_minus = level & plus
        low = rows - j + bound  # bit of the last row of the table
        if low >= width - 1:
            score += not level & last
        else:
            score += (right_plus >> low & 1) - (right_minus >> low & 1)
        above_plus, above_minus = (right_plus << 1 | 1) & full, right_minus << 1 & full
        plus = above_minus | ~(level | above_plus) & full
        minus = level & above_plus
    return score if score <= bound else None
