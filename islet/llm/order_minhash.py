"""Document fingerprints by Order MinHash, in built-in functions only.

k-mers are runs of ``K`` words, each numbered by its occurrence in the text,
so a repeated k-mer counts as several.  Each of ``M`` orders ranks the
numbered k-mers by a hash; the ``L`` smallest are put back into the order of
the text and hashed as a tuple.  The share of equal tuples of two texts falls
with their edit distance: moved passages change the order, and so the tuples.

The orders are rotations of one 40-bit hash: order j ranks by (hash - r_j)
modulo 2**40, so its L smallest k-mers follow r_j in the sorted list of hashes.
One sort and a binary search an order take the place of M passes.

A k-mer is held as a long: 40 bits of hash above 24 bits of its place.  Texts
of 2**24 k-mers and more share places among neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, L, M = 3, 2, 32
PLACE = 24
_MASK = (1 << PLACE) - 1
_POWERS = [1 << b for b in range(30, -1, -1)]
BLOCK_ROWS = 4000  # documents of a block of the id order
MAX_BLOCKS = 10_000


def _longs(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _rotations(m: int) -> list[int]:
    """m fixed pseudo-random signed longs."""
    out, x = [], 0x243F6A8885A308D3
    for _ in range(m):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(x - (1 << 63))
    return out


def _below(items: Column, value: Column, powers: Column) -> Column:
    """How many of the sorted items are less than value."""
    return F.aggregate(powers, F.lit(0).cast("long"), lambda at, p: F.when(F.coalesce(F.get(items, (at + p - 1).cast("int")) < value, F.lit(False)), at + p).otherwise(at))


def _hash(v: Column) -> Column:
    return F.shiftrightunsigned(v, PLACE)


def with_signature(df: DataFrame, text: str, out: str, k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """Adds ``out``: an array of m longs.  A text of fewer than k words is one
    k-mer; null, empty and blank texts have none and share one signature."""
    w, a, e, at = (F.col(f"_omh_{x}") for x in ("words", "kmers", "numbered", "places"))
    empty = F.array_repeat(F.lit(0).cast("long"), 0)  # its type holds no nulls, so Spark sorts plain longs
    df = df.withColumn("_omh_words", F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda x: x != ""))
    n = F.greatest(F.size(w) - (k - 1), F.least(F.size(w), F.lit(1)))

    def kmer(i):
        place = F.when(F.size(w) < 1 << PLACE, i).otherwise(F.shiftright(i, 31 - PLACE))
        return F.shiftleft(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), PLACE).bitwiseOR(place.cast("long"))

    df = df.withColumn("_omh_kmers", F.sort_array(F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), kmer)).otherwise(empty)))

    def numbered(v, i):
        again = _hash(F.get(a, i - 1)) == _hash(v)
        before = F.aggregate(_longs(_POWERS), F.lit(0).cast("long"), lambda c, p: F.when(F.coalesce(_hash(F.get(a, (i - c - p).cast("int"))) == _hash(v), F.lit(False)), c + p).otherwise(c))
        return F.when(again, F.shiftleft(F.xxhash64(_hash(v), before), PLACE).bitwiseOR(v.bitwiseAND(F.lit(_MASK)))).otherwise(v)

    df = df.withColumn("_omh_numbered", F.sort_array(F.transform(a, numbered)))
    powers = F.array(F.filter(_longs(_POWERS), lambda p: p <= F.size(e)))  # bound once a text, not once an order
    df = df.withColumn("_omh_places", F.get(F.transform(powers, lambda ps: F.transform(_longs(_rotations(m)), lambda r: _below(e, r, ps))), F.lit(0)))

    def chosen(i, t):
        return F.get(e, ((i + t) % F.size(e)).cast("int"))

    if l == 2:
        def signed(i):
            x, y = chosen(i, 0), chosen(i, 1)
            return F.when(x.bitwiseAND(F.lit(_MASK)) <= y.bitwiseAND(F.lit(_MASK)), F.xxhash64(_hash(x), _hash(y))).otherwise(F.xxhash64(_hash(y), _hash(x)))
    else:
        def signed(i):
            placed = F.transform(F.sequence(F.lit(0), F.lit(l - 1)), lambda t: F.shiftleft(chosen(i, t), 64 - PLACE).bitwiseOR(_hash(chosen(i, t))))
            return F.xxhash64(F.transform(F.sort_array(placed), lambda v: v.bitwiseAND(F.lit((1 << (64 - PLACE)) - 1))))

    df = df.withColumn(out, F.when(F.size(e) > 0, F.transform(at, signed)).otherwise(F.array_repeat(F.lit(0).cast("long"), m)))
    return df.drop("_omh_words", "_omh_kmers", "_omh_numbered", "_omh_places")


def as_string(signature: Column) -> Column:
    """Eight hexadecimal digits a tuple."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples, 0 to 1."""
    low = F.lit(0xFFFFFFFF)
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x.bitwiseAND(low) == y.bitwiseAND(low)), lambda x: x)) / F.size(a)


def with_next(df: DataFrame, doc_id: str, cols: list[str]) -> DataFrame:
    """Adds next_<col> of the next row by descending id, null ids last; after
    the last row comes the first.  Equal ids go by a hash of their first
    column.  Rows are cut into blocks at quantiles of the id; the top row of a
    block also goes to the end of the block above, so no window spans blocks.
    """
    tie = F.xxhash64(cols[0])
    rows, none = df.agg(F.count(F.lit(1)), F.min(F.when(F.col(doc_id).isNull(), tie))).first()
    n = int(min(MAX_BLOCKS, max(1, rows // BLOCK_ROWS)))
    tops = df.agg(F.percentile_approx(doc_id, [(i + 1) / n for i in range(n)], max(10_000, 10 * n))).first()[0]
    tops = sorted(set(tops or []))
    last = len(tops) - 1
    ids = F.col(doc_id)
    powers = _longs([p for p in _POWERS if p <= max(1, len(tops))])
    block = F.when(ids.isNull(), F.lit(-1)).otherwise(_below(_longs(tops), ids, powers).cast("int")) if tops else F.lit(-1)
    df = df.withColumn("_block", block).withColumn("_tie", tie)
    above = F.when(F.col("_block") == last, F.lit(-1 if none is not None else 0)).otherwise(F.col("_block") + 1)
    is_top = (F.col("_tie") == F.lit(none)) if not tops else F.when(ids.isNull(), F.col("_tie") == F.lit(none)).otherwise(F.get(_longs(tops), F.greatest(F.col("_block"), F.lit(0))) == ids)
    ghost = F.struct(above.alias("b"), F.lit(True).alias("g"))
    own = F.struct(F.col("_block").alias("b"), F.lit(False).alias("g"))
    df = df.withColumn("_at", F.explode(F.when(is_top, F.array(own, ghost)).otherwise(F.array(own))))
    order = Window.partitionBy("_at.b").orderBy("_at.g", ids.desc_nulls_last(), "_tie")
    df = df.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in cols], F.lead(F.lit(1)).over(order).alias("_more"))
    return df.filter("not _at.g").drop("_block", "_tie", "_at", "_more")


def edits(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> the document's and its edited text's fingerprints.

    The edited text has its last floor(n_chars / 3) code points replaced by
    the first as many (or all) of the next document.  Null texts are empty.
    Columns: doc_id, n_chars, edited, signature, next_signature,
    edited_signature.  An empty table gives no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = with_next(with_signature(docs, "text", "signature"), "doc_id", ["text", "signature"])
    n = F.length("text").cast("long")
    cut = F.floor(n / 3).cast("int")
    docs = docs.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), (n - cut).cast("int")), F.col("next_text").substr(F.lit(1), cut)))
    docs = docs.select("doc_id", n.alias("n_chars"), "edited", "signature", "next_signature")
    return with_signature(docs, "edited", "edited_signature")
