"""Column-name normalisation."""

from __future__ import annotations

import re

_SEP = re.compile(r"[ -]+")
_NOT_WORD = re.compile(r"[^a-z0-9_]+")


def normalized_alias(name: str | None) -> str:
    """Lower case; runs of spaces/dashes → '_'; other characters dropped;
    '_' put in front of a leading digit.  ``None``/'' → ''."""
    if not name:
        return ""
    s = _NOT_WORD.sub("", _SEP.sub("_", name.lower()))
    if s[:1].isdigit():
        s = "_" + s
    return s
