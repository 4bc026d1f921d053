"""Function names for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemart.functions import amount, identity


def _digit_sum() -> str:
    return " + ".join(
        f"(ascii(substring(t, {i + 1}, 1)) - 48) * {w}" for i, w in enumerate(identity.WEIGHTS)
    )


def register(spark: SparkSession) -> None:
    """Create the SQL functions as inlined expressions; SQL casts the arguments to the declared types first."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION validate_id_card(id_number STRING) RETURNS STRING
        RETURN SELECT CASE
            WHEN t IS NULL THEN NULL
            WHEN octet_length(encode(t, 'UTF-16BE')) <> 36 THEN '{identity.BAD_LENGTH}'
            WHEN NOT t RLIKE r'{identity.ID_FORMAT}' THEN '{identity.BAD_FORMAT}'
            WHEN substring(t, 18, 1) <> substring('{identity.CHECK_DIGITS}', ({_digit_sum()}) % 11 + 1, 1)
                THEN '{identity.BAD_CHECK}'
            ELSE '{identity.VALID}' END
        FROM (SELECT regexp_replace(id_number, r'{identity.EDGE_BLANKS}', '') AS t)
        """
    )
    units = ", ".join(f"'{u}'" for u in amount.UNITS)
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION convert_number_chinese_amount(x DECIMAL(36, 2))
        RETURNS STRING
        RETURN SELECT CASE WHEN v < 100000000000000000 THEN concat(
            array_join(transform(sequence(1, length(w)), i -> CASE
                WHEN substring(w, i, 1) = '0' THEN ''
                ELSE concat(substring('{amount.DIGITS}', int(substring(w, i, 1)) + 1, 1),
                            array({units})[length(w) - i],
                            if(substring(w, i + 1, 1) = '0', '{amount.DIGITS[0]}', '')) END), ''),
            '{amount.YUAN}',
            CASE WHEN c = 0 THEN '{amount.WHOLE}' ELSE concat(
                if(c >= 10, concat(substring('{amount.DIGITS}', c div 10 + 1, 1), '{amount.JIAO}'), ''),
                if(c % 10 > 0, concat(substring('{amount.DIGITS}', c % 10 + 1, 1), '{amount.FEN}'), ''))
            END) END
        FROM (SELECT v, string(floor(v)) AS w, int((v - floor(v)) * 100) AS c
              FROM (SELECT if(x < 0, CAST(0 AS DECIMAL(36, 2)), x) AS v))
        """
    )
