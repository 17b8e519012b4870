"""The passage dedup's definition in plain Python, for comparison."""

import xxhash


def corpus_order(rows):
    """Rows in corpus order: by id, null first, then by the text's hash."""

    def key(row):
        h = xxhash.xxh64_intdigest((row[1] or "").encode(), seed=42)
        return (-(2**63) if row[0] is None else row[0], h - (1 << 64) if h >> 63 else h)

    return sorted(set(rows), key=key)


def repeated(docs, length):
    """Words of spans of ``length`` words that any earlier place has too."""
    seen, out = set(), []
    for _, text in docs:
        words, gone = (text or "").split(), set()
        for i in range(len(words) - length + 1):
            span = tuple(words[i : i + length])
            if span in seen:
                gone.update(range(i, i + length))
            seen.add(span)
        out.append(gone)
    return out
