"""Text cleaning as native column expressions. NULL in gives NULL out."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearloom.fixed import SENTINEL

_BLANKS = " \t\n\r\x0b\x0c"


def without_sentinel(text: Column, sentinel: str = SENTINEL) -> Column:
    """Remove every occurrence of ``sentinel``; matched literally, not as a regex."""
    return F.replace(text, F.lit(sentinel), F.lit(""))


def title_name(text: Column) -> Column:
    """``"  uNiTeD sTaTeS "`` becomes ``"United States"``.

    Trims spaces only, and a hyphen does not start a new word.
    """
    return F.initcap(F.lower(F.trim(text)))


def short_name(text: Column) -> Column:
    """The part of a formal name before its first comma or bracket, trimmed."""
    head = F.substring_index(F.substring_index(text, ",", 1), "(", 1)
    return F.btrim(head, F.lit(_BLANKS))
