"""Covering masks: keys under which all pairs within a radius collide.

Each position gets a non-zero vector of r+1 bits. A table is a non-zero vector
v; it keeps the positions whose vector has an odd product with v. Any r positions
span at most r of r+1 dimensions, so some v is orthogonal to all of them: in that
table none of the r differences is kept, and the pair has equal keys. There are
2^(r+1) - 1 tables, and each keeps at least about half of the positions.
"""

from __future__ import annotations


def covering_tables(positions: int, radius: int) -> list[list[int]]:
    """For each table, the positions that it keeps."""
    vectors = 2 ** (radius + 1) - 1
    given = [p % vectors + 1 for p in range(positions)]
    return [
        [p for p in range(positions) if bin(given[p] & v).count("1") % 2]
        for v in range(1, vectors + 1)
    ]
