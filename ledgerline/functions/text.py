"""Bytes → text, text repair and key building."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What survives cleaning (",-@" is a range), the mark of a byte that
# could not be decoded and its replacement, the archive suffix length, the key width.
DROPPED_CHARACTERS = r'[^a-zA-Z0-9,-@+_ "\n]'
UNDECODABLE = "�"
REPAIRED = "ç"
SUFFIX_LENGTH = 4
COMPANY_KEY_LENGTH = 8


# What cleaning removes from Latin-1 text, which has no other characters than these 256.
_LATIN1 = bytes(range(256)).decode("latin-1")
_DROPPED_LATIN1 = "".join(re.findall(DROPPED_CHARACTERS, _LATIN1))
KEPT_VISIBLE = "".join(c for c in _LATIN1 if c not in _DROPPED_LATIN1 and not c.isspace())


def decode_latin1(raw: Column) -> Column:
    return F.decode(raw.cast("binary"), "ISO-8859-1")


def decode_utf8(raw: Column) -> Column:
    """UTF-8 text, U+FFFD in place of every byte that is none."""
    return F.make_valid_utf8(raw.cast("string"))


def clean(raw: Column) -> Column:
    """Latin-1 bytes → text without the characters that cleaning removes.

    Deleting listed characters gives what replacing by pattern does, several times faster.
    """
    return F.translate(decode_latin1(raw), _DROPPED_LATIN1, "")


def repair(text: Column) -> Column:
    return F.replace(text, F.lit(UNDECODABLE), F.lit(REPAIRED))


def strip_suffix(name: Column, length: int = SUFFIX_LENGTH) -> Column:
    return F.substring(name, F.lit(1), F.greatest(F.length(name) - length, F.lit(0)))


def build_key(*parts: Column) -> Column:
    """The parts in one text, NULL as soon as one of them is."""
    return F.concat(*parts)


def key_prefix(key: Column) -> Column:
    return F.substring(key, 1, COMPANY_KEY_LENGTH)
