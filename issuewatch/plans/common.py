"""Small helpers shared by the registered query plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (top level) so engines agree on the last bits."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            out.append(F.transform(F.col(f.name), lambda x: F.round(x.cast("double"), digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
