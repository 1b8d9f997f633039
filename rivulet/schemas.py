"""Record schemas. Nothing is inferred: every source is read with one of these."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


TEXT, LONG, INT, TIME = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()

LINE = _schema(("line", TEXT))
WORD_COUNT = _schema(("word", TEXT), ("count", LONG))
CLICK = _schema(("user", TEXT), ("url", TEXT), ("timestamp", LONG))
USER_BEHAVIOR = _schema(
    ("userId", TEXT), ("itemId", TEXT), ("categoryId", TEXT), ("behavior", TEXT), ("timestamp", LONG)
)
ITEM_VIEW_COUNT = _schema(("itemId", TEXT), ("count", LONG), ("windowStart", LONG), ("windowEnd", LONG))
ORDER_EVENT = _schema(("orderId", TEXT), ("eventType", TEXT), ("timestamp", LONG))
USER_EVENT = _schema(("userId", TEXT), ("eventType", TEXT), ("timestamp", LONG))
LOGIN_EVENT = _schema(("user", TEXT), ("eventType", TEXT), ("timestamp", LONG))
KEY_VALUE = _schema(("k", TEXT), ("v", INT))
PUNCTUATED = _schema(("seq", LONG), ("kind", TEXT), ("word", TEXT), ("ts", LONG), ("wm", LONG))
