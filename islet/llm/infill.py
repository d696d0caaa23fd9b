"""Fill-in-middle texts by a pipeline of ``pyarrow.compute`` calls per batch.

A text is split into units (a run of ASCII letters, or any other code point),
held as one list array per batch.  The lists are flattened beside the index of
their parent row, a unit's ordinal is its place less that of its row's first,
and two cuts by row give each unit a role.  The units of a role are filtered
out, rebuilt into lists and joined into one piece a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from islet.llm.common import text_chunks

#: Marks of the prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")

# A unit over UTF-8 bytes: letters, another ASCII byte, or a lead byte and its followers.
_UNIT = rb"[A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\x80-\xFF][\x80-\xBF]*"
_END = b"\xff"  # a byte that UTF-8 never has


def draws(doc_id: Column, epoch: int = 1) -> list[Column]:
    """Four numbers below 2**32 from the id and the epoch: the first four
    groups of eight digits of a SHA-256.  A null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{epoch}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _mod(x, m):
    return pc.subtract(x, pc.multiply(pc.divide(x, m), m))


def _rebuilt(units, keep, counts) -> pa.Array:
    """The kept units as one joined piece a row of ``counts`` units."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)]).cast(pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, units.filter(keep)), b"")


def infill(texts: pa.Array, h: list[pa.Array], plain_percent: int = 10, spm_percent: int = 20, marks=MARKS) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of texts without nulls."""
    raw = texts.cast(pa.binary())
    lists = pc.split_pattern(pc.replace_substring_regex(raw, pattern=_UNIT, replacement=b"\\0" + _END), pattern=_END)
    held = pc.list_value_length(lists).cast(pa.int64())  # with an empty one after the last unit
    n = pc.subtract(held, 1)
    first = pc.subtract(pc.cumulative_sum(held), held)
    parent, units = pc.list_parent_indices(lists), pc.list_flatten(lists)
    ordinal = pc.subtract(pa.array(np.arange(len(units))), first.take(parent))

    x, y = (_mod(v, pc.add(n, 1)) for v in h[:2])
    low, high = pc.min_element_wise(x, y), pc.max_element_wise(x, y)
    below_low, below_high = pc.less(ordinal, low.take(parent)), pc.less(ordinal, high.take(parent))
    prefix = _rebuilt(units, below_low, low)
    middle = _rebuilt(units, pc.and_not(below_high, below_low), pc.subtract(high, low))
    suffix = _rebuilt(units, pc.and_not(pc.less(ordinal, n.take(parent)), below_high), pc.subtract(n, high))

    marked = pc.equal(n, 0)
    for mark in marks:
        marked = pc.or_(marked, pc.match_substring(raw, mark.encode()))
    plain = pc.or_(marked, pc.greater_equal(_mod(h[2], pa.scalar(100)), 100 - plain_percent))
    spm = pc.less(_mod(h[3], pa.scalar(100)), spm_percent)
    p, s, m = (pa.scalar(mark.encode()) for mark in marks)
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b"")
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b"")
    none = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(prefix.cast(pa.string())).cast(pa.int64())),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(middle.cast(pa.string())).cast(pa.int64())),
        "output": pc.if_else(plain, raw, pc.if_else(spm, spm_text, psm_text)).cast(pa.string()),
    }


def fill_in_middle(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", epoch: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(row: the columns ``keep``, n, form, prefix_chars, middle_chars, output).

    Two cuts among a text's n units, drawn from its id and the epoch, part it
    into prefix, middle and suffix; ``psm`` and ``spm`` say in which order the
    output has them, ``plain`` that it is the text itself.  Null texts are
    empty; empty texts, those that hold a mark and ``plain_percent`` of the
    others are plain, with null prefix_chars and middle_chars.  Null ids draw
    like an empty id, repeated rows alike.  An empty table gives no rows.
    Nothing is shuffled, and about 2 MB of text (or one longer text) is held
    at a time.
    """
    given = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"), *[x.alias(f"h{i}") for i, x in enumerate(draws(docs[doc_id], epoch))])
    kinds = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}
    schema = T.StructType([given.schema["row"], *[T.StructField(k, v) for k, v in kinds.items()]])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for lo, hi, *_ in text_chunks(b.column("text")):
                part = b.slice(lo, hi - lo)
                out = infill(part.column("text"), [part.column(f"h{i}") for i in range(4)], plain_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([part.column("row"), *[out[k] for k in kinds]], ["row", *kinds])

    return given.mapInArrow(batches, schema)


def restored(output: Column, form: Column, marks=MARKS) -> Column:
    """The text, from an output and its form alone.  A mark holds its first
    character nowhere else, so the pieces around it never make another."""
    parts = F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks), -1)
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(1), part(3), part(2))).otherwise(F.concat(part(2), part(3), part(1)))
