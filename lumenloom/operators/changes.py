"""Versions of rows: change images, latest row per key, updates and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenloom.functions.collections import list_append
from lumenloom.operators.firsts import WINDOW_SECONDS, fifo_dedup
from lumenloom.operators.ordered import previous_row, with_neighbours

__all__ = ["VIEWS", "WINDOW_SECONDS", "apply_updates", "cdc_images", "content_id", "fifo_dedup", "upsert_latest", "versions", "with_old_image"]

# View type -> (new image shown, old image shown).
VIEWS = {
    "KEYS_ONLY": (False, False),
    "NEW_IMAGE": (True, False),
    "OLD_IMAGE": (False, True),
    "NEW_AND_OLD_IMAGES": (True, True),
}


def with_old_image(df: DataFrame, keys: list[str], seq: str, deleted: Column | None = None) -> DataFrame:
    """Adds ``old_image``: the previous version of the row's key, null if there was none

    or if it was a deletion."""
    image = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    if deleted is not None:
        image = F.when(~deleted, image)
    return previous_row(df, keys, [seq], image, "old_image")


def cdc_images(
    df: DataFrame, keys: list[str], seq: str, view: str = "NEW_AND_OLD_IMAGES",
    deleted: Column | None = None,
) -> DataFrame:
    """Change events of a version log: event name, keys, and the images the view shows."""
    show_new, show_old = VIEWS[view]
    gone = deleted if deleted is not None else F.lit(False)
    image = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    versions = with_old_image(df, keys, seq, gone)
    name = F.when(gone, "REMOVE").when(F.col("old_image").isNull(), "INSERT").otherwise("MODIFY")
    nothing = F.when(F.lit(False), image)
    events = versions.select(
        *keys,
        seq,
        name.alias("event_name"),
        (F.when(~gone, image) if show_new else nothing).alias("new_image"),
        (F.col("old_image") if show_old else nothing).alias("old_image"),
        F.col("old_image").isNull().alias("_fresh"),
    )
    # removing what is not there changes nothing
    return events.where((F.col("event_name") != "REMOVE") | ~F.col("_fresh")).drop("_fresh")


def upsert_latest(base: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the one with the highest sequence; ``new`` wins a tie with ``base``.

    max_by combines before the shuffle, so a key with many versions stays cheap.
    """
    both = base.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    row = F.struct(*[F.col(c) for c in base.columns if c not in keys])
    latest = both.groupBy(*keys).agg(F.max_by(row, F.struct(seq, "_new")).alias("_row"))
    return latest.select(*keys, "_row.*").select(*base.columns)


def apply_updates(
    base: DataFrame,
    changes: DataFrame,
    keys: list[str],
    set_values: list[str] = (),
    add_numbers: list[str] = (),
    append_lists: list[str] = (),
    set_if_missing: list[str] = (),
    op: str = "op",
    condition: Column | None = None,
) -> DataFrame:
    """Base rows after one change per key: op is put, update or delete.

    A put replaces the row; an update sets the given attributes (a null leaves
    them), adds numbers (a missing one counts as 0), appends to lists and fills
    what is missing; an update of a missing row creates it; a delete removes it.
    ``condition`` looks at the base row through columns named as in ``base``: a
    change whose condition fails is not applied. ``changes`` holds one row per
    key: fold several first, with ``upsert_latest``.
    """
    values = [c for c in base.columns if c not in keys]
    held = base.withColumn("_here", F.lit(True))
    if condition is not None:
        held = held.withColumn("_ok", F.coalesce(condition, F.lit(False)))
    incoming = changes.select(
        *keys,
        F.col(op).alias("_op"),
        *[(F.col(c) if c in changes.columns else F.lit(None)).alias(f"_n_{c}") for c in values],
    )
    both = held.join(incoming, keys, "full")
    here = F.coalesce("_here", F.lit(False))
    allowed = F.coalesce("_ok", F.lit(False)) if condition is not None else F.lit(True)
    active = F.when(allowed, F.col("_op"))

    def after(c: str) -> Column:
        old, new = F.col(c), F.col(f"_n_{c}")
        updated = old
        if c in set_values:
            updated = F.coalesce(new, old)
        elif c in add_numbers:
            updated = F.when(new.isNull(), old).otherwise(F.coalesce(old, F.lit(0)) + new)
        elif c in append_lists:
            updated = F.when(new.isNull(), old).otherwise(list_append(old, new))
        elif c in set_if_missing:
            updated = F.coalesce(old, new)
        return F.when(active == "put", new).when(active == "update", updated).otherwise(old).alias(c)

    kept = (here & (F.coalesce(active, F.lit("")) != "delete")) | (
        ~here & F.coalesce(active.isin("put", "update"), F.lit(False))
    )
    return both.where(kept).select(*[after(c) if c in values else F.col(c) for c in base.columns])


def versions(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Every version with its number from 1, and from when to when it held (end open)."""
    told = with_neighbours(df, keys, [ts], following={"valid_to": F.col(ts)}, totals={"version": F.lit(1)})
    return told.withColumn("is_current", F.col("valid_to").isNull()).select(*df.columns, "version", "valid_to", "is_current")


def content_id(body: Column) -> Column:
    """The de-duplication id of a message that brings none."""
    return F.md5(body)
