"""CSV export of listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.vocab import EXPORT_FIELDS


def export_rows(listings: DataFrame) -> DataFrame:
    """The fixed export columns; arrays joined by ', ', other columns left out."""
    kinds = {f.name: f.dataType.typeName() for f in listings.schema.fields}
    out = []
    for name in EXPORT_FIELDS:
        if name not in kinds:
            out.append(F.lit(None).cast("string").alias(name))
        elif kinds[name] == "array":
            out.append(F.array_join(name, ", ", "None").alias(name))
        else:
            out.append(F.col(name))
    return listings.select(*out)


def write_csv(listings: DataFrame, path: str) -> None:
    """Quotes are doubled and empty values left empty, as spreadsheet programs expect."""
    (export_rows(listings).write.mode("overwrite")
     .options(header=True, escape='"', emptyValue="").csv(path))
