"""Column helpers that turn nested values into flat text for comparisons and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

CODE_PARTS = ["billing_code_type", "billing_code_type_version", "billing_code", "description"]


def code_list_text(c: Column) -> Column:
    """covered_services / bundled_codes as ``type:version:code:description`` joined by ``|``."""
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[p] for p in CODE_PARTS])), "|")


def arrays_as_text(df: DataFrame) -> DataFrame:
    """Every array column joined into one string (``,`` between scalars); NULL stays NULL."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            if isinstance(f.dataType.elementType, StructType):
                cols.append(code_list_text(F.col(f.name)).alias(f.name))
            else:
                cols.append(F.array_join(F.col(f.name), ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
