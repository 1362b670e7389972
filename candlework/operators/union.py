"""Union of frames whose columns differ."""

from pyspark.sql import DataFrame


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    union = frames[0]
    for df in frames[1:]:
        union = union.unionByName(df, allowMissingColumns=True)
    return union
