"""Finding partners for names that are spelt differently on both sides of a join."""

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.operators.joins import skew_safe_join

# Letters that have a plain form but do not decompose into it.
_PLAIN = {"ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ı": "i"}
_KEY = "__match_key"


def _folding() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and the letters without them."""
    found = dict(_PLAIN)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code).lower()
        base = unicodedata.normalize("NFD", letter)[0]
        if len(letter) == 1 and base != letter and base.isascii():
            found[letter] = base
    return "".join(found), "".join(found.values())


def match_key(name: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """What differently spelt forms of a name have in common.

    Case, accents, and which of blanks, hyphens, dots and apostrophes stand
    between its words do not count, and ``&`` is ``and``. ``aliases`` gives for
    a name the one it stands for; both may be spelt in any of these ways.
    """
    marked, plain = _folding()

    def folded(text: Column) -> Column:
        letters = F.translate(F.lower(text), marked, plain)
        words = F.regexp_replace(F.regexp_replace(letters, r"\p{M}", ""), "&", " and ")
        return F.trim(F.regexp_replace(words, r"[\s\-_.'’]+", " "))

    key = folded(name)
    if not aliases:
        return key
    pairs = [folded(F.lit(x)) for pair in aliases.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def reconciled_panel(
    emissions: DataFrame,
    temperatures: DataFrame,
    aliases: Mapping[str, str] | None = None,
    salts: int = 1,
) -> DataFrame:
    """As ``country_panel``, joining names by ``match_key``; names as in the emissions.

    Two names of one side with the same key and year each get a row, so look at
    ``ambiguous_names`` first. Rows without a name find no partner.
    """
    left = emissions.withColumn(_KEY, match_key(F.col("Country"), aliases))
    right = temperatures.withColumn(_KEY, match_key(F.col("Country"), aliases)).drop("Country")
    return skew_safe_join(left, right, ["Year", _KEY], "inner", salts).drop(_KEY)


def _names(df: DataFrame, side: str, aliases: Mapping[str, str] | None) -> DataFrame:
    named = df.filter(F.col("Country").isNotNull()).groupBy("Country").agg(F.count("*").alias("rows"))
    key = match_key(F.col("Country"), aliases).alias("match_key")
    return named.select(F.lit(side).alias("side"), "Country", key, "rows")


def unmatched_names(
    emissions: DataFrame, temperatures: DataFrame, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """The names on either side whose key the other side has not, with their rows."""
    left = _names(emissions, "emissions", aliases)
    right = _names(temperatures, "temperatures", aliases)
    found = left.join(right, "match_key", "left_anti").unionByName(
        right.join(left, "match_key", "left_anti")
    )
    return found.select("side", "Country", "match_key", "rows")


def ambiguous_names(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Keys that several names of one table share, with these names in order."""
    by_key = _names(df, "", aliases).groupBy("match_key")
    found = by_key.agg(F.sort_array(F.collect_list("Country")).alias("names"))
    return found.filter(F.size("names") > 1)
