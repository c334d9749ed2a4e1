"""CUSIP form and check digit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that a CUSIP may hold, in order of their values 0 to 38.
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ*@#"


def character_value(cusip: Column, place: int) -> Column:
    """The value of the character at a place (1-based); missing for others."""
    character = F.substring(cusip, place, 1)
    at = F.position(character, F.lit(ALPHABET))
    return F.when((character != "") & (at > 0), at - 1)


def is_well_formed(cusip: Column) -> Column:
    """Eight characters of the alphabet and a digit."""
    return (F.length(cusip) == 9) & cusip.rlike("^[0-9A-Z*@#]{8}[0-9]$")


def has_valid_check_digit(cusip: Column) -> Column:
    """Whether the ninth digit is the check digit of the others; missing unless well formed."""
    total = F.lit(0)
    for place in range(1, 9):
        value = character_value(cusip, place) * (2 - place % 2)
        total = total + F.floor(value / 10) + value % 10
    return F.when(is_well_formed(cusip), (10 - total % 10) % 10 == F.substring(cusip, 9, 1).try_cast("int"))
