"""The line dedup's definition in plain Python, for comparison."""

import re
import struct

import xxhash


def _h(data, seed=42):
    v = xxhash.xxh64_intdigest(data, seed=seed)
    return v - (1 << 64) if v >> 63 else v


def _chain(values):
    h = 42
    for v in values:
        # each value is hashed with the hash so far as one more field
        seed = _h(struct.pack("<q", h)) % (1 << 64)
        h = _h(struct.pack("<q", v), seed)
    return h


def line_table(text):
    out = []
    for no, line in enumerate((text or "").split("\n"), 1):
        w = len(re.findall(r"[^ \t\n\x0b\f\r]+", line))
        if w:
            out.append((no, _h(line.strip(" ").encode()), w))
    return out


def grams(lines, noise):
    out = []
    for i in range(len(lines)):
        w, n = 0, 0
        while w < noise and i + n < len(lines):
            w += lines[i + n][2]
            n += 1
        out.append((_chain(x[1] for x in lines[i : i + n]), i, n) if w >= noise else None)
    return out


def selected(lines, noise, guarantee):
    all_ = grams(lines, noise)
    chosen = set()
    for i in range(len(lines)):
        best, w, j = None, 0, i
        while j < len(lines) and w <= guarantee - noise:
            if all_[j] and (best is None or all_[j] < best):
                best = all_[j]
            w += lines[j][2]
            j += 1
        if best:
            chosen.add(best)
    return chosen


def matching(own, other, words):
    n = w = 0
    for a, b in zip(own, other):
        if w >= words or a[1] != b[1]:
            break
        n, w = n + 1, w + a[2]
    return n


def deleted(rows, noise, guarantee):
    """{(id, text): sorted line numbers} for rows (id, text)."""
    least = -(2**63)
    docs = sorted(
        {(least if i is None else i, _h((t or "").encode()), i, t) for i, t in rows},
        key=lambda r: r[:2],
    )
    tables = [line_table(t) for *_, t in docs]
    first, places = {}, []
    for k, lines in enumerate(tables):
        for g, at, n in sorted(selected(lines, noise, guarantee), key=lambda x: x[1]):
            places.append((g, k, at, n))
            first.setdefault(g, (k, at, n))
    gone = {}
    for g, k, at, n in places:
        fk, fat, fn = first[g]
        if (fk, fat) == (k, at):
            continue
        own, other = tables[k], tables[fk]
        left = matching(own[:at][::-1], other[:fat][::-1], guarantee)
        right = matching(own[at + n :], other[fat + fn :], guarantee)
        for i in range(at - left, at + n + right):
            gone.setdefault((docs[k][2], docs[k][3]), set()).add(own[i][0])
    return {k: sorted(v) for k, v in gone.items()}
