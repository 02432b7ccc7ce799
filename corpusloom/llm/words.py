"""Words as the problems define them: longest runs of letters or digits, compared without case and accents."""

from __future__ import annotations

import re
import unicodedata

_MARKS = re.compile("[̀-ͯ]+")
_OTHER = re.compile(r"[\W_]+")
_ASCII = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(256)).lower()


def plain(text: str) -> str:
    """The words of a text, folded, with one space between them."""
    if text.isascii():
        return b" ".join(text.encode().translate(_ASCII).split()).decode()
    folded = _MARKS.sub("", unicodedata.normalize("NFD", text)).casefold()
    return _OTHER.sub(" ", folded).strip()
