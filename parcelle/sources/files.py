"""CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.functions.text import collapse_blanks


def write_csv(df: DataFrame, path: str, squeeze: bool = False, mode: str = "errorifexists") -> None:
    """Rows as CSV part files with a header and every field in quotes.

    Quotes inside a field are doubled and a missing value is an empty field.
    ``squeeze`` collapses whitespace in all text columns.
    """
    rows = df
    if squeeze:
        rows = df.withColumns({
            f.name: collapse_blanks(F.col(f.name))
            for f in df.schema.fields if isinstance(f.dataType, T.StringType)
        })
    (
        rows.write.mode(mode)
        .option("header", True).option("quoteAll", True)
        .option("escape", '"').option("nullValue", "").option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
