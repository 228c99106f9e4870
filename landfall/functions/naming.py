"""Pascal/camel case to snake_case, for column names and for column values.

One regex pass, then lower case. The same rule is applied to names (plain
Python ``re``; names are schema metadata held by the driver) and to values
(``regexp_replace`` inside the JVM, so it stays in whole-stage codegen).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where a word ends, a lower-case letter or digit followed by an
# upper-case letter. An underscore goes between them; the result is lowered.
_WORD_END = r"([a-z0-9])([A-Z])"


def pascal_to_snake(name: str) -> str:
    """``SalesOrderID`` -> ``sales_order_id``; ``XMLData`` -> ``xmldata``."""
    return re.sub(_WORD_END, r"\1_\2", name).lower()


def snake_case(col: Column | str) -> Column:
    """Column version of :func:`pascal_to_snake` (JVM regex, no Python UDF)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.regexp_replace(c, _WORD_END, "$1_$2"))
