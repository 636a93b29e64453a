"""Business expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from kpiloom.constants import AGE_BANDS, PARTIALLY_REFUNDED, SEGMENTS, TOTAL, UNCLASSIFIED, UNIT_MEASURE
from kpiloom.functions.numbers import safe_ratio

#: Smallest integer that a score may round to.
INT_MIN = -2**31


def qty_normalise(qty: Column, measure: Column, net_weight: Column) -> Column:
    """Pieces: quantity as is for goods sold by unit, else divided by net weight."""
    return F.when(measure != UNIT_MEASURE, safe_ratio(qty, net_weight)).otherwise(qty.cast("double"))


def qty_cap(picked: Column, requested: Column) -> Column:
    """Picked quantity, at most the requested one; a null pick stays null."""
    return F.when(picked > requested, requested).otherwise(picked)


def line_value(price: Column, qty: Column) -> Column:
    return price * qty


def refund_value(status: Column, full: Column, picked: Column) -> Column:
    """Net value of a line: the picked value once the order was partly refunded."""
    return F.when(status == PARTIALLY_REFUNDED, picked).otherwise(full)


def nps_bucket(score: Column) -> Column:
    """-1 detractor, 0 neutral, 1 promoter; scores count as the integer (of 32 bits) that they round to, halves away from 0.

    The limits lie at the halves, so that no score has to be rounded.
    """
    s = score.try_cast("double")
    return F.when(s <= INT_MIN - 0.5, F.lit(None)).when(s < 6.5, -1).when(s < 8.5, 0).when(s < 10.5, 1)


def age_band(range_text: Column) -> Column:
    """Band of the leading integer of an age range such as ``18 - 24``."""
    start = F.regexp_extract(range_text, r"^\s*[+]?([0-9]+)(\s|-|$)", 1).try_cast("int")
    young, mid, mature, senior = AGE_BANDS
    return (F.when(start < 30, young).when(start < 45, mid).when(start < 60, mature)
            .when(start.isNotNull(), senior).otherwise(UNCLASSIFIED))


def segment_map(segment: Column, valid: Iterable[str] = SEGMENTS) -> Column:
    return F.when(segment.isin(*valid), segment).otherwise(UNCLASSIFIED)


def blank_to_total(label: Column, default: str = TOTAL, blanks: Iterable[str] = ("", "None", "nan")) -> Column:
    """Label, or ``default`` where it is null or one of ``blanks`` after trimming."""
    text = F.trim(label)
    return F.when(text.isNull() | text.isin(*blanks), default).otherwise(text)


def total_label(key: str, label: str = TOTAL, unmapped: str | None = None) -> Column:
    """Subtotal label inside a grouping-sets aggregate.

    Uses ``grouping`` so that a null key is not taken for the subtotal; such rows
    keep a null key or get ``unmapped``.
    """
    value = F.coalesce(F.col(key), F.lit(unmapped)) if unmapped is not None else F.col(key)
    return F.when(F.grouping(key) == 1, label).otherwise(value)


def store_label(node: Column, stores: Mapping[str, str]) -> Column:
    """Store name of a node id, null for ids outside ``stores`` (a small config map)."""
    label = F.lit(None).cast("string")
    for node_id, name in stores.items():
        label = F.when(node.cast("string") == node_id, name).otherwise(label)
    return label


def store_names(stores: Mapping[str, str]) -> list[str]:
    """The different names of ``stores``."""
    return [name for name in dict.fromkeys(stores.values()) if name is not None]


def store_number(node: Column, stores: Mapping[str, str]) -> Column:
    """Number of a node's store in ``store_names``, from 1; 0 for nodes without one."""
    place = {name: k for k, name in enumerate(store_names(stores), 1)}
    ids = F.array(*[F.lit(node_id) for node_id in stores]).cast("array<string>")
    numbers = F.array(F.lit(0), *[F.lit(place.get(name, 0)) for name in stores.values()])
    # the node is named once: each mention would be computed again for every row
    return F.coalesce(F.get(numbers, F.array_position(ids, node.cast("string")).cast("int")), F.lit(0))


def value_status(value: Column, good_from: float, neutral_from: float | None = None,
                 higher_better: bool = True) -> Column:
    """``good`` / ``neutral`` / ``bad`` against fixed limits; null stays null."""
    reached = (lambda limit: value >= limit) if higher_better else (lambda limit: value <= limit)
    status = F.when(reached(good_from), "good")
    if neutral_from is not None:
        status = status.when(reached(neutral_from), "neutral")
    return status.when(value.isNotNull(), "bad")
