"""Writers of what a run produces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmonitor.operators.publish import items_feed


def write_items_csv(docs: DataFrame, path: str) -> None:
    """CSV feed (UTF-8, header in each part file), replaced on every run."""
    items_feed(docs).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def write_publish(records: DataFrame, path: str) -> None:
    """Publish records, one folder per year; rows of a year are gathered first (in parts of
    the advised size), so that not every task writes a file for every year."""
    records.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(path)


def write_report(heading: DataFrame, items: DataFrame, path: str) -> None:
    """Report as text: the heading, then all items in crawl order.

    Items are range-sorted, so reading the part files by name gives the text.
    """
    heading.select(F.concat_ws("\n\n", "subject", "heading").alias("value")).write.mode(
        "overwrite"
    ).text(f"{path}/heading")
    items.orderBy("crawl_seq", "member_path").select(
        F.concat("item_text", F.lit("\n")).alias("value")
    ).write.mode("overwrite").text(f"{path}/items")
