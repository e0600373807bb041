"""Driver-side string rules for column, dataset and database names."""

import re

from yearloom.fixed import CHARS_TO_DROP, CHARS_TO_UNDERSCORE

_STORABLE = str.maketrans(CHARS_TO_UNDERSCORE, "_" * len(CHARS_TO_UNDERSCORE), CHARS_TO_DROP)


def storable_name(name: str) -> str:
    """A column name Parquet accepts: separators become ``_``, brackets go."""
    return name.translate(_STORABLE)


def compact_name(name: str) -> str:
    """A column name without its spaces."""
    return name.replace(" ", "")


def database_name(user: str) -> str:
    """A database name from a user name or mail address.

    The ASCII letters and digits before the ``@``, if there is one.
    """
    name = re.sub(r"[^A-Za-z0-9]", "", user.partition("@")[0])
    if not name:
        raise ValueError(f"no letter or digit in user name {user!r}")
    return name
