"""Text forms."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_text(number: Column) -> Column:
    """Shortest decimal text of a double: plain from 1e-4 up to 1e16, else ``1e-05`` style.

    Spark's own cast turns to exponents below 1e-3 and from 1e7 on; the tape must not.
    """
    text = number.cast("string")
    size = F.abs(number)
    plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    # 1.0E-5 -> 1e-05, 1.5E22 -> 1.5e+22
    mantissa = F.regexp_replace(F.regexp_extract(text, "^(.*)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, "E(.*)$", 1).try_cast("int")
    scientific = F.format_string(
        "%se%s%02d", mantissa, F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent)
    )
    return (
        F.when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
