"""Reading ``key:value,key:value`` payload strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def payload_map(payload: Column) -> Column:
    """The whole payload as a map. Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``.

    Nothing is trimmed, only the first ``:`` of a pair splits it, a pair without
    ``:`` maps to NULL, and the last of several equal keys wins.
    """
    return F.str_to_map(payload, F.lit(","), F.lit(":"))


def payload_value(payload: Column, key: str) -> Column:
    """``payload_map(payload)[key]`` without building the map.

    The jobs need one or two keys of a payload, so they look for the last
    ``,key:`` in the text. This allocates no map, stays inside whole-stage code
    and does not depend on the session's map-key policy. A later pair that is the
    bare key hides the value, as NULL is then the last entry of that key.
    """
    pairs = F.concat(F.lit(","), payload, F.lit(","))
    marker = F.lit(f",{key}:")
    rest = F.substring_index(pairs, f",{key}:", -1)
    found = F.contains(pairs, marker) & ~F.contains(rest, F.lit(f",{key},"))
    return F.when(found, F.substring_index(rest, ",", 1))
