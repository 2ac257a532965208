"""Documents as lines and back. (doc_id, line_no, sub_no) is the key and the order; every operator on
lines keeps one window specification, so one exchange on doc_id serves a chain of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markdown import is_fence, page_number
from ..functions.text import blank, one_break, strip


def by_doc(*more: str):
    return Window.partitionBy("doc_id", *more).orderBy("line_no", "sub_no")


def before(*more: str):
    return by_doc(*more).rowsBetween(Window.unboundedPreceding, -1)


def so_far(*more: str):
    return by_doc(*more).rowsBetween(Window.unboundedPreceding, 0)


def after(*more: str):
    return by_doc(*more).rowsBetween(1, Window.unboundedFollowing)


def explode_lines(docs: DataFrame, text: str = "md", all_breaks: bool = False) -> DataFrame:
    """doc_id, line_no (from 0), sub_no, line. A null text has one null line, an empty one an empty line."""
    source = one_break(F.col(text)) if all_breaks else F.col(text)
    return docs.select("doc_id", F.posexplode_outer(F.split(source, "\n", -1)).alias("line_no", "line")).select(
        "doc_id", F.coalesce("line_no", F.lit(0)).alias("line_no"), F.lit(0).alias("sub_no"), "line"
    )


def assemble(lines: DataFrame, text: str = "md") -> DataFrame:
    """One text per document from its lines, in order; documents without a line are not there."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "sub_no", "line")))
    joined = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return lines.groupBy("doc_id").agg(F.when(F.count("line") > 0, joined).alias(text))


def with_fences(lines: DataFrame) -> DataFrame:
    """in_fence: within a fenced block or on one of its fence lines."""
    odd = F.coalesce(F.sum(is_fence(F.col("line")).cast("int")).over(before()), F.lit(0)) % 2 == 1
    return lines.withColumn("is_fence", F.coalesce(is_fence(F.col("line")), F.lit(False))).withColumn("in_fence", odd | F.col("is_fence"))


def with_pages(lines: DataFrame) -> DataFrame:
    """page: the last page marker at or before the line; null in the preamble."""
    return lines.withColumn("page", F.last(page_number(F.col("line")), ignorenulls=True).over(so_far()))


def rewrite(lines: DataFrame, changed: Column) -> DataFrame:
    """Put ``changed`` where it isn't null."""
    return lines.withColumn("line", F.coalesce(changed, F.col("line")))


def neighbours(lines: DataFrame) -> DataFrame:
    """previous and next line, and the nearest that are not blank (empty text where there is none)."""
    shown = F.when(~blank(F.col("line")), strip(F.col("line")))
    return lines.withColumns(
        {
            "line_before": F.lag("line").over(by_doc()),
            "line_after": F.lead("line").over(by_doc()),
            "shown_before": F.coalesce(F.last(shown, ignorenulls=True).over(before()), F.lit("")),
            "shown_after": F.coalesce(F.first(shown, ignorenulls=True).over(after()), F.lit("")),
        }
    )


