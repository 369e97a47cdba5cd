"""Column expressions over texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column | str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


def n_of(text: Column, chars: str) -> Column:
    """How many characters of the text match the character class ``chars``."""
    return F.regexp_count(text, F.lit(chars)).cast("long")


def bucket(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.pmod(F.crc32(F.coalesce(text, F.lit("")).cast("binary")), F.lit(n)).cast("int")
