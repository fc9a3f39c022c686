"""State of devices from the patches sent to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_state(patches: DataFrame) -> DataFrame:
    """(device, section, key, value): what each section holds after all patches.

    A patch row has device, seq, section, key, value; a null value removes the key,
    a null key stands for a null section, which removes all of it. Both steps are
    aggregates that combine before the shuffle, so a busy device stays cheap.
    """
    cleared = patches.where("key IS NULL").groupBy("device", "section").agg(
        F.max("seq").alias("_cleared")
    )
    latest = (
        patches.where("key IS NOT NULL")
        .groupBy("device", "section", "key")
        .agg(F.max("seq").alias("_seq"), F.max_by(F.struct("value"), "seq").alias("_value"))
    )
    alive = latest.join(cleared, ["device", "section"], "left").where(
        "_cleared IS NULL OR _seq > _cleared"
    )
    return alive.select("device", "section", "key", F.col("_value.value").alias("value")).where(
        "value IS NOT NULL"
    )


def compact_patches(patches: DataFrame) -> DataFrame:
    """The patches that still matter: the last one per key, and per section the last null."""
    return patches.groupBy("device", "section", "key").agg(
        F.max_by(F.struct("value"), "seq").alias("_value"), F.max("seq").alias("seq")
    ).select("device", "seq", "section", "key", F.col("_value.value").alias("value"))


def state_versions(patches: DataFrame) -> DataFrame:
    """(device, version): the number of accepted patches; a patch may have many rows."""
    return patches.select("device", "seq").distinct().groupBy("device").agg(
        F.count("*").alias("version")
    )


def state_documents(patches: DataFrame) -> DataFrame:
    """(device, version, state): one map of maps per device.

    A document is one row by definition; with very many keys use ``merge_state``.
    """
    sections = merge_state(patches).groupBy("device", "section").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("values")
    )
    state = sections.groupBy("device").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", F.to_json("values"))))).alias("state")
    )
    return state_versions(patches).join(state, "device", "left")
