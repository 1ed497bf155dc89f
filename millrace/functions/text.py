"""Text column functions: line splitting, JVM-style token split, prefixes.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and are pushed through the optimiser like any other projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators recognised by Hadoop's line reader.
LINE_BREAK = r"\r\n|\r|\n"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_lines(text) -> Column:
    """Lines of a text the way a line reader yields them from a file.

    Splits on ``\\n``, ``\\r`` or ``\\r\\n``; a final terminator does not start
    a new (empty) line, and an empty text has no lines.
    """
    t = _col(text)
    parts = F.split(t, LINE_BREAK, -1)
    return (F.when(t.isNull(), F.lit(None))
            .when(t == "", F.array().cast("array<string>"))
            .when(t.rlike(r"(\r|\n)\z"), F.slice(parts, 1, F.size(parts) - 1))
            .otherwise(parts))


def jvm_split_space(line) -> Column:
    """``line.split(" ")`` with Java semantics.

    Leading and inner empty tokens are kept, trailing empty tokens dropped;
    ``""`` gives ``[""]`` and a line of spaces only gives no tokens.
    Spark's ``split`` keeps trailing empties, hence the right-trim of spaces.
    """
    s = _col(line)
    trimmed = F.rtrim(s)  # Spark's rtrim strips the space character only
    return (F.when(s.isNull(), F.lit(None))
            .when(s == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def prefix(c, text: str) -> Column:
    """``text + value`` (null stays null)."""
    return F.concat(F.lit(text), _col(c))
