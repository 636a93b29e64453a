"""Small sets as bits of whole numbers: a set unites over rows with ``bit_or`` (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

#: Bits of one mask.
WIDTH = 56

#: Slots of a week: its days, and one for rows without a day.
WEEK_SLOTS = 8


def mask_names(members: int, slots: int = 1) -> list[str]:
    """Names of the masks that a set of ``members`` takes, each with ``slots`` bits."""
    return [f"mask_{k}" for k in range(-(-members // (WIDTH // slots)))]


def row_masks(member: Column, members: int, slot: Column | None = None, slots: int = 1) -> list[Column]:
    """A row's masks, with one bit set: its ``slot`` of its ``member``, both counted from 0."""
    per = WIDTH // slots
    at = (slot if slot is not None else F.lit(0)) + member % per * slots
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))
    names, none = mask_names(members, slots), F.lit(0).cast("bigint")
    if len(names) == 1:
        return [F.coalesce(bit, none).alias(names[0])]
    return [F.when(F.floor(member / per) == k, bit).otherwise(none).alias(name) for k, name in enumerate(names)]


def held(masks: list[str], wanted: Iterable[tuple[int, Iterable[int], str | None]], slots: int = 1) -> Column:
    """Those of ``wanted``, each (member, slots of which one is set, name), that the masks hold: array<struct<slot, name>>.

    ``slot`` is the first of the slots asked for.
    """
    def cell(member: int, taken: Iterable[int], name: str | None) -> Column:
        which, k = divmod(member, WIDTH // slots)
        bits = sum(1 << (slots * k + s) for s in taken)
        return F.struct(F.lit(which).alias("mask"), F.lit(bits).cast("bigint").alias("bits"),
                        F.lit(min(taken)).alias("slot"), F.lit(name).cast("string").alias("name"))

    values = F.array(*masks)
    found = F.filter(F.array(*[cell(*w) for w in wanted]), lambda c: F.get(values, c["mask"]).bitwiseAND(c["bits"]) != 0)
    return F.transform(found, lambda c: F.struct(c["slot"].alias("slot"), c["name"].alias("name")))
