"""Rows of a table known by their content, so that any columns and repeated rows may occur."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``k, x, id, text, row``: hashes of id and text and of the text alone, the text with null as
    empty, and the whole row. Rows equal in id and text have one key; their results are equal."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.xxhash64(F.col(id_col), text).alias("k"),
        F.xxhash64(text).alias("x"),
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.struct("*").alias("row"),
    )


def keep(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose ``k, x`` are in ``keys``, one of equal ones, with all columns."""
    rows = keyed(docs, id_col, text_col).select("k", "x", "row")
    again = F.row_number().over(Window.partitionBy("k", "x").orderBy("x"))
    stay = rows.join(keys.select("k", "x"), ["k", "x"], "left_semi").withColumn("again", again)
    return stay.filter("again = 1").select("row.*")
