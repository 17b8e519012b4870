"""Secret scans: fixed patterns and sliding-window entropy (operator 10).

Candidate strings are runs of key characters. Within a candidate a window of
fixed length slides over each stretch of one character class; its Shannon
entropy follows from counts that change by two characters per step. Windows
above the class's threshold that overlap or touch become a span of kind ``entropy``,
unless the allow-list names the candidate or a word in the window. They stand beside
what the fixed patterns found, and say how random a value is that a pattern only names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stratalake.llm.common import map_texts

# --- fixed values: the base patterns, in the order in which kinds are listed ---
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE_CHARS = 6
# A run of these characters is matched whole, so a least length in the pattern
# finds just the runs that are long enough.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
# -------------------------------------------------------------------------------

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")

# A window that holds one of these words is no secret.
ALLOWED_WORDS = r"(?i)example|sample|dummy|placeholder|changeme"
# Whole candidates that are none: ids, words joined by signs or by capitals, figures.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^([A-Za-z]?[a-z]*|[A-Z]+)([_/+=-]+([A-Za-z]?[a-z]*|[A-Z]+))*$",
    r"^([A-Z]?[a-z]{2,})+$",
    r"^[0-9/_+=-]+$",
)


@dataclass(frozen=True)
class EntropyClass:
    """A stretch pattern, what a stretch must hold, and the least bits of a window."""

    stretch: str
    needs: tuple[str, ...]
    bits: float


CLASSES = (
    EntropyClass(r"[0-9a-f]+|[0-9A-F]+", (r"[0-9]", r"[A-Fa-f]"), 3.0),
    EntropyClass(r"[A-Za-z0-9+/_=-]+", (r"[0-9]", r"[a-z]", r"[A-Z]"), 3.9),
    EntropyClass(r"[a-z0-9]+", (r"[0-9].*[0-9].*[0-9]", r"[g-z]"), 3.6),
    EntropyClass(r"[A-Z0-9]+", (r"[0-9].*[0-9]", r"[G-Z]"), 3.5),
    EntropyClass(r"[A-Za-z]+", (r"[A-Z]{2}", r"[a-z][A-Z][a-z][A-Z]|[A-Z][a-z][A-Z][a-z]"), 3.7),
)


def window_entropies(text: str, width: int) -> list[float]:
    """Shannon entropy in bits of every window of ``width`` characters.

    With counts c over a window, H = log2(width) - sum(c * log2 c) / width. A
    step takes one character out and one in, so only two counts change.
    """
    if len(text) < width:
        return []
    part = [0.0] + [c * math.log2(c) for c in range(1, width + 2)]  # one more comes in first
    counts: dict[str, int] = {}
    total = 0.0
    out = []
    for i, new in enumerate(text):
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += part[c + 1] - part[c]
        if i >= width:
            old = text[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += part[c - 1] - part[c]
        if i >= width - 1:
            out.append(math.log2(width) - total / width)
    return out


class SecretScanner:
    """Finds spans in one text; built once per Python worker."""

    def __init__(
        self,
        classes: Sequence[EntropyClass],
        allowed: Sequence[str],
        width: int,
        words: str = ALLOWED_WORDS,
    ):
        self.classes = [
            (re.compile(c.stretch), [re.compile(n) for n in c.needs], c.bits) for c in classes
        ]
        self.allowed = [re.compile(p) for p in allowed]
        self.words = re.compile(words)
        self.width = width

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed patterns."""
        found = [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_VALUE_CHARS
        ]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def entropy(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of random stretches; spans of a text never overlap."""
        found: list[tuple[int, int, int]] = []
        for candidate in CANDIDATE.finditer(text):
            word, at = candidate.group(), candidate.start()
            if any(p.search(word) for p in self.allowed):
                continue
            named = [m.span() for m in self.words.finditer(word)]
            spans = sorted(s for c in self.classes for s in self._windows(word, named, *c))
            for start, end in _united(spans):
                found.append((at + start, 3, at + end))
        return found

    def _windows(self, word, named, stretch, needs, bits):
        for run in stretch.finditer(word):
            part, begin = run.group(), run.start()
            if len(part) < self.width or not all(n.search(part) for n in needs):
                continue
            for i, h in enumerate(window_entropies(part, self.width)):
                start, end = begin + i, begin + i + self.width
                if h >= bits and not any(s < end and start < e for s, e in named):
                    yield start, end


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap or touch made one."""
    made: list[tuple[int, int]] = []
    for start, end in spans:
        if made and start <= made[-1][1]:
            made[-1] = (made[-1][0], max(end, made[-1][1]))
        else:
            made.append((start, end))
    return made


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(
    docs: DataFrame,
    classes: Sequence[EntropyClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    width: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Spans of secrets in every whole text, a row per input row.

    Returns the id, ``n_assign``, ``n_access``, ``n_hex``, ``n_entropy`` (long),
    ``base_spans`` and ``spans`` (``kind:start:end`` by start, then kind,
    comma-joined; code points, end exclusive) and ``base_sha256``. The scan is one
    pass over the rows and shuffles nothing. A null text counts as empty: no spans, the digest of the
    empty string. Repeated rows and null ids come out as they went in; other
    columns are ignored. The allow-list suppresses entropy spans only.
    """

    def work(texts: list[str]) -> dict[str, list]:
        scanner = SecretScanner(classes, allowed, width)
        out: dict[str, list] = {
            name: []
            for name in (
                "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "base_spans", "spans"
            )
        }
        for text in texts:
            base = scanner.base(text)
            more = scanner.entropy(text)
            kinds = [kind for _, kind, _ in base]
            out["n_assign"].append(kinds.count(0))
            out["n_access"].append(kinds.count(1))
            out["n_hex"].append(kinds.count(2))
            out["n_entropy"].append(len(more))
            shown = listed(base)
            out["base_sha256"].append(hashlib.sha256(shown.encode()).hexdigest())
            out["base_spans"].append(shown)
            out["spans"].append(listed(sorted(base + more)) if more else shown)
        return out

    schema = (
        f"{id_col} {dict(docs.dtypes)[id_col]}, n_assign long, n_access long, n_hex long, "
        "n_entropy long, base_sha256 string, base_spans string, spans string"
    )
    return map_texts(docs, schema, work, (id_col,), text_col)
