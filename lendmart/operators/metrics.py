"""Typed metric snapshots from stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.html_cards import cards
from ..functions.scalars import metric_value
from ..schemas import METRIC_LABELS

# Where a published figure sits in the page.
BLOCK, BLOCK_CLASS, TITLE, VALUE = "div", "col-md-3 col-12", "p", "h5"


def with_cards(pages: DataFrame, block: str = BLOCK, cls: str | None = BLOCK_CLASS,
               title: str = TITLE, value: str = VALUE) -> DataFrame:
    """Pages with their (label, value) pairs as the array ``cards`` in place of the markup."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, cards(F.col("html"), block, cls, title, value).alias("cards"))


def extract_labeled(pages: DataFrame, block: str = BLOCK, cls: str | None = BLOCK_CLASS,
                    title: str = TITLE, value: str = VALUE) -> DataFrame:
    """One row (page_id, ordinal, label, value) per block that has both parts."""
    found = with_cards(pages.select("page_id", "html"), block, cls, title, value)
    return found.select("page_id", F.posexplode("cards").alias("ordinal", "card")).select(
        "page_id", "ordinal", F.col("card.label"), F.col("card.value")
    )


def metric_snapshot(carded: DataFrame, labels=METRIC_LABELS,
                    created_at: str | Column = "created_at", keep=("page_id",)) -> DataFrame:
    """One wide row per page, only if all labels and the time are present.

    The last card of a label counts, even when its value is unreadable. A page
    carries all its cards in one row, so this is a projection without a shuffle.
    """
    time = F.col(created_at) if isinstance(created_at, str) else created_at

    def last(label: str) -> Column:
        of_label = F.filter("cards", lambda card: card["label"] == label)
        return metric_value(F.try_element_at(of_label, F.lit(-1))["value"]).alias(label)

    # The row is made by a generator, so the check for gaps reads finished values; below a
    # plain projection it would compute every one of them a second time.
    values = F.struct(*[last(label) for label in labels], time.alias("created_at"))
    wide = carded.select(*keep, F.explode(F.array(values)).alias("_values"))
    whole = F.lit(True)
    for label in [*labels, "created_at"]:
        whole = whole & F.col("_values")[label].isNotNull()
    return wide.where(whole).select(*keep, "_values.*")
