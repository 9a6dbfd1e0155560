"""The best similar items of each item."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.schemas import CONTRACTS, WEIGHTED_COUNTS

# Which of two rows of a pair stays, the larger in these columns, one after the other.
_LARGER = ("score", "pair_count", "to_cart_count", "favorite_count", "click_count", "view_count", "unique_users", "unique_sessions")


@dataclass(frozen=True)
class TopK:
    top_k: int = 20
    source: str = "behavioral"
    min_pair_count: int | None = None
    min_unique_users: int | None = None
    min_unique_sessions: int | None = None
    deduplicate: bool = True

    def __post_init__(self) -> None:
        if self.top_k <= 0:
            raise ValueError("top_k must be positive")

    def select(self, scores: DataFrame) -> DataFrame:
        """Ranked recommendations with their counts; ties go to the smaller similar id."""
        df = scores.filter("item_id IS NOT NULL AND similar_item_id IS NOT NULL AND score IS NOT NULL AND item_id <> similar_item_id")
        for c in ("pair_count", "unique_users", "unique_sessions"):
            if (least := getattr(self, f"min_{c}")) is not None:
                df = df.filter(F.col(c) >= least)
        if self.deduplicate:
            first = Window.partitionBy("item_id", "similar_item_id").orderBy(*[F.desc(c) for c in _LARGER])
            df = df.withColumn("_first", F.row_number().over(first)).filter("_first = 1").drop("_first")
        best = Window.partitionBy("item_id").orderBy(F.desc("score"), "similar_item_id")
        ranked = df.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= self.top_k).withColumn("source", F.lit(self.source))
        more = [c for c in CONTRACTS["pair_scores"] if c not in CONTRACTS["recommendations"] and c in df.columns or c in WEIGHTED_COUNTS and c in df.columns]
        return ranked.select(*CONTRACTS["recommendations"], *dict.fromkeys(more))
