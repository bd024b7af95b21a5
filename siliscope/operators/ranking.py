"""Global RANK over scores with few distinct values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """Add ``RANK() OVER (ORDER BY score DESC)`` for each ``rank name -> score column``.

    A window without partitions would move every row into one task. The scores
    must come from fixed point lists, which bound the number of combinations:
    counting the rows per combination (combined before the shuffle) and ranking
    that small table gives the same numbers. Spark chooses how to join it back.
    """
    scores = list(dict.fromkeys(ranks.values()))
    ranked = df.groupBy(*scores).agg(F.count(F.lit(1)).alias("_rows"))
    for name, score in ranks.items():
        up_to_here = F.sum("_rows").over(Window.orderBy(F.col(score).desc_nulls_last()))
        same_score = F.sum("_rows").over(Window.partitionBy(score))
        ranked = ranked.withColumn(name, up_to_here - same_score + 1)
    ranked = ranked.select(*[F.col(s).alias(f"_rank_{s}") for s in scores], *ranks)
    same = F.lit(True)
    for s in scores:
        same = same & F.col(s).eqNullSafe(F.col(f"_rank_{s}"))
    return df.join(ranked, same, "inner").drop(*[f"_rank_{s}" for s in scores])
