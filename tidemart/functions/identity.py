"""ID-number validation (F1)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from tidemart.functions.binding import let

# Labels, digit weights, check digits by remainder, number format.
BAD_LENGTH = "无效长度"
BAD_FORMAT = "格式错误"
BAD_CHECK = "校验码错误"
VALID = "有效身份证"
WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
CHECK_DIGITS = "10X98765432"
ID_FORMAT = (
    r"\A[1-9][0-9]{5}(18|19|20)[0-9]{2}(0[1-9]|10|11|12)"
    r"([0-2][1-9]|10|20|30|31)[0-9]{3}[0-9Xx]\z"
)
EDGE_BLANKS = r"\A[\x00-\x20]+|[\x00-\x20]+\z"


def utf16_length(text: Column) -> Column:
    """Length in 16-bit units, which is how the JVM counts."""
    return F.octet_length(F.encode(text, "UTF-16BE")) / 2


def validate_id_card(id_number: Column) -> Column:
    def label(s: Column) -> Column:
        weighted = reduce(
            add,
            [(F.ascii(F.substring(s, i + 1, 1)) - 48) * w for i, w in enumerate(WEIGHTS)],
        )
        check = F.lit(CHECK_DIGITS).substr((weighted % 11 + 1).cast("int"), F.lit(1))
        return (
            F.when(s.isNull(), F.lit(None).cast("string"))
            .when(utf16_length(s) != 18, BAD_LENGTH)
            .when(~s.rlike(ID_FORMAT), BAD_FORMAT)
            .when(F.substring(s, 18, 1) != check, BAD_CHECK)
            .otherwise(VALID)
        )

    return let(F.regexp_replace(id_number, EDGE_BLANKS, ""), label)
