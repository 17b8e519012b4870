"""State names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.schemas import STATES

_ACCENTED = "áàâãçéêíóôõúü"
_PLAIN = "aaaaceeiooouu"


def _folded(text: Column) -> Column:
    return F.translate(F.lower(F.trim(text)), _ACCENTED, _PLAIN)


def state_code(state: Column) -> Column:
    """Two-letter code of a state given by code or name; other text gives null."""
    pairs = []
    for code, name in STATES:
        pairs += [F.lit(name.lower()), F.lit(code), F.lit(code.lower()), F.lit(code)]
    return F.try_element_at(F.create_map(*pairs), _folded(state))
