"""Helpers shared by the text operators: the shared work folder, held-out rows and blocks of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from settleflow.sources.work import dropped, stored, work_folder  # noqa: F401  for the operators

_OTHER = re.compile(r"[^\w\x00-\x7F]")
_SPACED = bytes(k if k > 127 or chr(k).isalnum() else 32 for k in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cased runs of letters and digits, as UTF-8."""
    text = text.lower()
    return (text if text.isascii() else _OTHER.sub(" ", text)).encode().translate(_SPACED).split()


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def word_blocks(data: bytes, keep: int = 0, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text split at ASCII whitespace, in blocks of about ``size`` bytes.

    Each block but the first begins with the last ``keep`` words of the one before, so memory stays
    bounded for very long texts and no run of ``keep + 1`` words is lost.
    """
    tail: list[bytes] = []
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            rest = data[end:end + size].split(None, 1)
            while len(rest) == 1 and not data[end:end + 1].isspace() and end + size < len(data):
                end += size  # a word longer than a block
                rest = data[end:end + size].split(None, 1)
            while end < len(data) and not data[end:end + 1].isspace():
                end += 1
        words = tail + data[at:end].split()
        at = end
        if words:
            yield words
        tail = words[-keep:] if keep else []
