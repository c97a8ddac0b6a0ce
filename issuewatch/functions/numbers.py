"""Korean unit numbers (`1.2천` = 1200, `4.3만` = 43000, `3백만` = 3000000).

The first unit token gives the base (product of its unit values); all unit tokens
are removed; the rest is read as a decimal and `int(value * base)` truncates toward
zero, as the reference does (`0.29백` -> 28). Native expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit characters and their values; a unit token is one of 십 백 천
# followed by 만, or a single one of 십 백 천 만.
UNIT_TOKEN = "[십백천]만|[십백천만]"
UNIT_VALUES = [("십", 10), ("백", 100), ("천", 1000), ("만", 10000)]


def korean_number(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    tok = F.regexp_extract(x, UNIT_TOKEN, 0)
    base = F.lit(1).cast("bigint")
    for ch, v in UNIT_VALUES:
        base = base * F.when(F.contains(tok, F.lit(ch)), F.lit(v)).otherwise(F.lit(1))
    num = F.trim(F.regexp_replace(x, UNIT_TOKEN, "")).try_cast("double")
    return (num * base.cast("double")).try_cast("bigint")
