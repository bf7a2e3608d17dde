"""Column helpers for arrays and label ids."""

import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LABEL_IDS
from .text import col


def argmax(scores) -> Column:
    """0-based position of the first largest element."""
    scores = col(scores)
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def pad_to(values, length, filler) -> Column:
    """Append ``filler`` up to ``length`` elements; longer arrays stay as they are."""
    values = col(values)
    missing = F.greatest(length - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(filler), missing))


def literal_map(entries) -> Column:
    """A constant string map; Catalyst folds it to one literal."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def lookup(entries, key) -> Column:
    """The value of a key in a constant string map of many entries, NULL for an unknown key.

    The map is a literal dealt into buckets by checksum, so that few entries are compared for each key.
    """
    buckets = [{} for _ in range(max(1, len(entries) // 8))]
    for k, v in entries.items():
        buckets[zlib.crc32(k.encode()) % len(buckets)][k] = v
    held = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    place = F.pmod(F.crc32(col(key).cast("binary")), F.lit(len(buckets))).cast("int")
    return F.try_element_at(F.get(held, place), col(key))


def label_id(label) -> Column:
    """Label text to id, NULL for an unknown label."""
    return F.try_element_at(literal_map(LABEL_IDS), col(label)).cast("int")


def id_label(label_id_col) -> Column:
    """Label id to text, NULL for an unknown id."""
    names = {str(number): name for name, number in LABEL_IDS.items()}
    return F.try_element_at(literal_map(names), col(label_id_col).cast("string"))
