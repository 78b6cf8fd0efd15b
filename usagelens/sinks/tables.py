"""Result tables as Parquet, and the check every load starts with."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Exactly the ``required`` columns of ``df``; ``ValueError`` naming those it lacks."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(sorted(missing))}")
    return df.select(*required)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its row count, so that a write needs no second pass."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def overwrite(df: DataFrame, path: str) -> int:
    """Replace the Parquet table at ``path``; returns the rows written."""
    df, written = counted(df)
    df.write.mode("overwrite").parquet(path)
    return written.get["rows"]
