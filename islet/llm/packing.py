"""Token sequences of one length, packed first-fit decreasing.

Documents become token ids with an end id, cut into full pieces and a rest.
Pieces go to randomised groups of bounded size, and each group is packed on
its own: the largest piece first, each into the first sequence with room,
which a tournament tree over the sequences' free room finds in log time.
What room is left is then filled by cutting the pieces of the emptiest
sequences, so that a group leaves no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from islet.llm import byte_pairs
from islet.llm.common import scalar, stage, text_chunks

GROUP_PIECES = 8192  # mean number of pieces in a group


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The sequence of each piece, in the order given: the first with room.

    A tournament tree holds the most free room of each half: a piece goes left
    while the left half has room.  Sequences not begun yet are free leaves.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        out.append(node - leaves)
        room[node] -= size
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return out


def pack_group(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start in it, length); sizes fall, none is above
    ``capacity``.  All sequences are full but the last few, whose lengths are
    the powers of two of what is left."""
    bins: list[list[tuple[int, int, int]]] = []
    for i, b in enumerate(first_fit(sizes, capacity)):
        if b == len(bins):
            bins.append([])
        bins[b].append((i, 0, sizes[i]))
    full, part = [], []
    for b in bins:
        used = sum(p[2] for p in b)
        (full if used == capacity else part).append((used, b))
    part.sort(key=lambda x: -x[0])
    done, lo, hi = [b for _, b in full], 0, len(part) - 1
    spare: list[tuple[int, int, int]] = []  # pieces of the emptiest sequence, the largest first
    for lo in range(len(part)):
        used, b = part[lo]
        if lo > hi:
            break
        while used < capacity and (spare or hi > lo):
            if not spare:
                spare = part[hi][1]
                hi -= 1
            i, start, n = spare.pop()
            take = min(n, capacity - used)
            b.append((i, start, take))
            used += take
            if take < n:
                spare.append((i, start + take, n - take))
        done.append(b)
    rest = done.pop() if done and sum(p[2] for p in done[-1]) < capacity else []
    rest += spare[::-1]
    left = sum(p[2] for p in rest)
    rest.reverse()
    while left:
        size = min(capacity, 1 << (left.bit_length() - 1))
        b, used = [], 0
        while used < size:
            i, start, n = rest.pop()
            take = min(n, size - used)
            b.append((i, start, take))
            used += take
            if take < n:
                rest.append((i, start + take, n - take))
        done.append(b)
        left -= size
    return done


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, end: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids): full pieces and a
    rest of each document's ids and end id; ids (little-endian unsigned 32-bit)
    of the rests only, or of all pieces."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    held = docs.sparkSession.sparkContext.broadcast(byte_pairs.load(vocabulary))  # the size of its file, whatever the documents
    given = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([given.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")], T.StructField("ids", T.BinaryType())])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_pairs.Encoder(*held.value)
        for b in it:
            for lo, hi, *_ in text_chunks(b.column("text")):
                part = b.slice(lo, hi - lo)
                ids, counts = encoder.texts(part.column("text").to_pylist())
                row, start, length, crcs, total, kept = [], [], [], [], [], []
                first = 0
                for r, n in enumerate(counts.tolist()):
                    own = np.append(ids[first : first + n].astype("<u4"), np.uint32(end))
                    first += n
                    for at in range(0, n + 1, capacity):
                        raw = own[at : at + capacity].tobytes()
                        row.append(r)
                        start.append(at)
                        length.append(len(raw) // 4)
                        crcs.append(zlib.crc32(raw))
                        total.append(n + 1)
                        kept.append(raw if with_ids or len(raw) < 4 * capacity else None)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crcs, total)], pa.array(kept, pa.binary())], schema.names)

    return given.mapInArrow(batches, schema)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, end: int = 0, doc_id: str = "doc_id", text: str = "text", group_pieces: int = GROUP_PIECES, seed: int = 7, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences: (doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, ids).

    A document is its ids and the end id; null texts are empty, so have the
    end id alone.  Rows may repeat and ids be null: each row is packed once.
    Equal pieces of equal ids are one row with a count until they are dealt
    to groups, every copy to another group in turn.  A sequence has
    ``capacity`` ids or a smaller power of two of them; each group leaves fewer
    than log2(capacity) + 1 of the latter.  ids are there with ``with_ids``.  An empty table
    gives no rows.  Reruns agree.
    """
    cut = pieces(docs, vocabulary, capacity, end, doc_id, text, with_ids)
    names = cut.columns
    cut = stage(cut.groupBy(*names).agg(F.count(F.lit(1)).alias("copies")), "pieces")
    groups = max(1, -(-(scalar(cut, F.sum("copies")) or 0) // group_pieces))
    home = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "length", "ids_crc32"), F.lit(groups))
    dealt = cut.withColumn("home", home).withColumn("j", F.explode(F.sequence(F.lit(0), F.least("copies", F.lit(groups)).cast("int") - 1)))
    dealt = dealt.withColumn("copies", F.floor(F.col("copies") / groups).cast("long") + (F.col("j") < F.col("copies") % groups).cast("long"))
    dealt = dealt.withColumn("group", F.pmod(F.col("home") + F.col("j"), F.lit(groups)).cast("int")).drop("home", "j")
    schema = T.StructType([*[dealt.schema[c] for c in names if c != "ids"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), dealt.schema["ids"]])

    def packed(group: pa.Table) -> pa.Table:
        keys = [("length", "descending"), *[(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "doc_tokens")]]
        group = group.take(pc.sort_indices(group, sort_keys=keys))
        copies = group.column("copies").to_numpy()
        which = np.repeat(np.arange(len(group)), copies)
        sizes = group.column("length").to_numpy()[which]
        base = int(group.column("group")[0].as_py()) << 32
        begin, crcs, raw = group.column("start").to_pylist(), group.column("ids_crc32").to_pylist(), group.column("ids").to_pylist()
        own = group.column("length").to_pylist()
        row, start, length, sums, sequence, offset, ids = [], [], [], [], [], [], []
        for s, held in enumerate(pack_group(sizes.tolist(), capacity)):
            at = 0
            for i, skip, n in held:
                r = int(which[i])
                row.append(r)
                start.append(begin[r] + skip)
                length.append(n)
                cut_ids = raw[r][4 * skip : 4 * (skip + n)] if raw[r] is not None else None
                sums.append(crcs[r] if n == own[r] else zlib.crc32(cut_ids))
                sequence.append(base + s)
                offset.append(at)
                ids.append(cut_ids if with_ids else None)
                at += n
        taken = group.select(["doc_id", "doc_tokens"]).take(pa.array(row, pa.int64()))
        long = lambda x: pa.array(x, pa.int64())
        return pa.table({"doc_id": taken.column("doc_id"), "start": long(start), "length": long(length), "ids_crc32": long(sums), "doc_tokens": taken.column("doc_tokens"), "sequence_id": long(sequence), "offset": long(offset), "ids": pa.array(ids, pa.binary())})

    return dealt.groupBy("group").applyInArrow(packed, schema)
