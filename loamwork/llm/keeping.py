"""Rows of a table by marks on (doc_id, text), where neither doc_id nor the two together need be unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.session import materialise


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, null like empty, beside a doc_id."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


class Carried:
    """Columns that an operator carries along and returns in one struct, so that their names cannot clash with its own.

    While it works they are two columns: the text, which it reads anyway, and __carried.
    """

    def __init__(self, keep: Sequence[str]):
        self.keep = [*dict.fromkeys(keep)]
        rest = [c for c in self.keep if c != "text"]
        self.columns = ["__carried"] * bool(rest) + ["text"] * ("text" in self.keep)
        self.folded = [F.struct(*(F.col(f"`{c}`") for c in rest)).alias("__carried")] * bool(rest)

    def row(self) -> list[Column]:
        """The struct ``row`` with all the columns in order, or nothing."""
        if not self.keep:
            return []
        return [F.struct(*(F.col("text") if c == "text" else F.col(f"__carried.`{c}`").alias(c) for c in self.keep)).alias("row")]


def kept_rows(docs: DataFrame, marks: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, key) is kept in ``marks`` (doc_id, key, kept; one row for each row).

    A null doc_id equals another. Of rows that are equal in doc_id and key one stays: the
    first in the order of the other columns. Only marks of rows that go, or that are
    repeated, are joined with ``docs``; any other columns of ``docs`` stay as they are.
    """
    marks = materialise(marks.groupBy(F.col("doc_id").alias("__of"), F.col("key").alias("__mark")).agg(F.max("kept").alias("__kept"), F.count("*").alias("__n")), "row-marks")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col("doc_id").alias("__id"), key.alias("__key"))

    def matching(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right.select("__of", "__mark"), F.col("__id").eqNullSafe(F.col("__of")) & (F.col("__key") == F.col("__mark")), how)

    out = matching(rows, marks.filter("NOT __kept"), "left_anti")
    repeated = marks.filter("__kept AND __n > 1")
    if not repeated.isEmpty():
        first = Window.partitionBy("__id", "__key").orderBy("__other")
        others = F.to_json(F.struct(*(F.col(f"__row.`{c}`") for c in docs.columns if c != "text")))
        again = matching(out, repeated, "left_semi").withColumn("__other", others).withColumn("__at", F.row_number().over(first)).filter("__at = 1")
        out = matching(out, repeated, "left_anti").unionByName(again.select("__row", "__id", "__key"))
    return out.select("__row.*")
