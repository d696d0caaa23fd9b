"""Language identification of whole, possibly mixed texts.

Words are runs of ASCII letters and non-ASCII characters of the lower-cased
text.  The word's script, by ranges of code points, leaves the languages that
use it; each of those scores the word by its byte trigrams (word ends
included).  Viterbi then labels the words with one language each, where a
switch costs ``SWITCH`` nats, so that runs of one label are spans.

Most texts keep one language throughout.  Whether that is their best path is
decided for many texts at once: no run of words may gain more than ``SWITCH``
by any other language.  Only the others take Viterbi's steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.llm.common import share, text_chunks

UNKNOWN = "und"
BUCKETS = 1 << 15  # of hashed trigrams
SMOOTH = 0.5
SWITCH = 16.0
#: Different texts of each language, at about this number, that a model is fitted on.
FIT_ROWS = 5000
#: A language uses a script from this share of its letters on.
USES = 0.01

#: Scripts by ranges of code points, to blocks of 64.
SCRIPTS = {
    "latin": [(0x00C0, 0x024F), (0x1E00, 0x1EFF)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
COMMON, OTHER = 0, len(SCRIPTS) + 1  # no letters; letters of no script above


def _script_table() -> np.ndarray:
    """Script by lead byte and second byte of a character in UTF-8."""
    out = np.zeros(1 << 16, np.uint8)
    out.reshape(256, 256)[ord("a") : ord("z") + 1] = 1
    for lead in range(0xC2, 0xF5):
        for second in range(0x80, 0xC0):
            lo = ((lead & 31) << 6) | (second & 63) if lead < 0xE0 else ((lead & 15) << 12) | ((second & 63) << 6) if lead < 0xF0 else 0x10000
            known = [i + 1 for i, ranges in enumerate(SCRIPTS.values()) for a, b in ranges if a <= lo + (0 if lead < 0xE0 else 63) and lo <= b]
            plain = lead == 0xC2 or 0x2000 <= lo < 0x2C00 or 0x2E00 <= lo < 0x2E80 or 0x3000 <= lo < 0x3040  # signs and punctuation
            out[(lead << 8) | second] = known[0] if known else COMMON if plain else OTHER
    return out


_SCRIPT = _script_table()
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


@dataclass
class Model:
    """langs; log-probabilities (BUCKETS, langs); scripts x langs in use."""

    langs: list[str]
    logp: np.ndarray
    uses: np.ndarray


def _features(data: np.ndarray, offs: np.ndarray):
    """Per word: start, script, letters; per byte of words: word, trigram."""
    inside = _LETTER[data]
    before = np.concatenate(([False], inside[:-1]))
    cuts = offs[(offs > 0) & (offs < len(data))]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    plain = np.where(inside, data, 0x20).astype(np.uint32)
    left, right = np.concatenate(([np.uint32(32)], plain[:-1])), np.concatenate((plain[1:], [np.uint32(32)]))
    left[cuts], right[cuts - 1] = 32, 32
    h = left[at] * np.uint32(0x9E3779B1) ^ plain[at] * np.uint32(0x85EBCA6B) ^ right[at] * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    grams = (h >> np.uint32(17)).astype(np.int64)
    second = np.concatenate((data[1:], [0]))[at].astype(np.int64)
    scripts = _SCRIPT[(data[at].astype(np.int64) << 8) | second]
    lead = (data[at] & 0xC0) != 0x80
    if not len(starts):
        return starts, starts, starts, first, grams
    script = np.maximum.reduceat(scripts, first).astype(np.int64)
    return starts, script, np.where(script > 0, np.add.reduceat(lead.astype(np.int64), first), 0), first, grams


def sample(labelled: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """About ``rows`` different texts of each lang, by a hash of the text, one
    row for each; at least one text of each lang."""
    draw = F.shiftrightunsigned(F.xxhash64("text"), 12)
    texts = labelled.select("lang", draw.alias("draw")).distinct()
    share = texts.groupBy("lang").agg((F.lit(float(rows)) / F.count(F.lit(1)) * (1 << 52)).alias("below"), F.min("draw").alias("least"))
    # a row for each lang, as the model has a column for each
    kept = labelled.withColumn("draw", draw).join(F.broadcast(share), "lang").filter((F.col("draw") < F.col("below")) | (F.col("draw") == F.col("least")))
    return kept.select("lang", "draw", "text").dropDuplicates(["lang", "draw"]).select("lang", "text")


def fit(labelled: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model of labelled(text, lang); null texts and langs teach nothing.

    Fitted on a sample of about ``rows`` different texts a language.  What reaches the
    driver is a table of BUCKETS counts a language.
    """
    labelled = labelled.select(F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), object)
            for lo, hi, data, offs in text_chunks(batch["text"]):
                starts, script, letters, first, grams = _features(data, offs)
                doc = np.searchsorted(offs, starts, "right") - 1
                ends = np.concatenate((first[1:], [len(grams)]))
                own = langs[lo:hi][doc] if len(doc) else langs[:0]
                for lang in set(own):
                    mine = own == lang
                    c = counts.setdefault(lang, np.zeros(BUCKETS + OTHER + 1, np.int64))
                    c[:BUCKETS] += np.bincount(grams[np.repeat(mine, ends - first)], minlength=BUCKETS)
                    c[BUCKETS:] += np.bincount(script[mine], letters[mine], OTHER + 1).astype(np.int64)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at])], names=["lang", "bucket", "n"])

    rows_ = sample(labelled, rows).mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(rows_.lang))
    c = np.zeros((BUCKETS + OTHER + 1, len(langs)))
    c[rows_.bucket.to_numpy(np.int64), np.searchsorted(langs, rows_.lang.to_numpy(str)) if langs else []] = rows_.n.to_numpy(float)
    grams, scripts = c[:BUCKETS] + SMOOTH, c[BUCKETS:]
    uses = scripts >= USES * np.maximum(scripts[1:].sum(0), 1)
    uses[~uses.any(1)] = True  # a script of no language tells nothing
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), uses)


def word_scores(model: Model, script: np.ndarray, letters: np.ndarray, first: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Log-likelihoods (words, langs), the best of each word's being 0."""
    scores = np.add.reduceat(model.logp[grams], first, axis=0).astype(np.float64)
    scores[~model.uses[script]] = -1e4
    scores -= scores.max(1, keepdims=True)
    scores = np.maximum(scores, -2 * SWITCH)  # one word alone never decides
    scores[(letters == 0) | ~model.uses[script].any(1) | (script == OTHER) & model.uses[script].all(1)] = 0
    return scores


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each row, with ``switch`` for each change of label."""
    best, back = scores[0].copy(), np.empty(scores.shape, np.int32)
    stay = np.arange(scores.shape[1])
    for t in range(1, len(scores)):
        top = int(best.argmax())
        back[t] = np.where(best >= best[top] - switch, stay, top)
        best = np.maximum(best, best[top] - switch) + scores[t]
    out = np.empty(len(scores), np.int64)
    out[-1] = best.argmax()
    for t in range(len(scores) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def paths(scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi's labels of the words of many texts."""
    n = np.diff(bounds)
    full = np.flatnonzero(n)
    if not len(full):
        return np.zeros(0, np.int64)
    top = np.add.reduceat(scores, bounds[full], axis=0).argmax(1)
    labels, text = np.repeat(top, n[full]), np.repeat(np.arange(len(full)), n[full])
    gain = np.cumsum(scores - np.take_along_axis(scores, labels[:, None], 1), axis=0)
    gain -= np.concatenate((np.zeros((1, scores.shape[1])), gain))[bounds[full]][text]
    apart = 1e7 * text[:, None]  # a running minimum that starts anew with each text
    low = np.minimum.accumulate(gain - apart, axis=0) + apart
    most = np.maximum.reduceat((gain - np.minimum(low, 0)).max(1), bounds[full])
    for i in np.flatnonzero(most > switch):
        lo, hi = bounds[full[i]], bounds[full[i] + 1]
        labels[lo:hi] = viterbi(scores[lo:hi], switch)
    return labels


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def label(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs -> (row, lang_pred, score, spans).

    ``row`` is a struct of all columns of docs.  lang_pred labels most letters
    (the first in order of langs, if several), score is its share of the
    letters, ``spans`` the labelled runs of words (start, end: code points of
    the lower-cased text).  If all letters are among signs (such as letterlike
    symbols), lang_pred is the first of langs and score 0.  Texts that are null or without letters, or any
    text under a model without langs, are ``und`` with score 0 and no spans.
    """
    shared = share(docs.sparkSession, model)
    rows = docs.select(F.struct("*").alias("row"), F.when(F.col(text).rlike(r"\p{L}"), F.lower(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch["text"], 1 << 20):
                pred, score, spans = [UNKNOWN] * (hi - lo), np.zeros(hi - lo), [[] for _ in range(hi - lo)]
                if m.langs and len(data):
                    starts, script, letters, first, grams = _features(data, offs)
                    bounds = np.searchsorted(starts, offs)
                    scores = word_scores(m, script, letters, first, grams) if len(starts) else np.zeros((0, len(m.langs)))
                    labels = paths(scores, bounds)
                    doc = np.repeat(np.arange(hi - lo), np.diff(bounds))
                    held = np.bincount(doc * len(m.langs) + labels, letters, (hi - lo) * len(m.langs)).reshape(-1, len(m.langs))
                    total = held.sum(1)
                    some = np.flatnonzero(total)
                    score[some] = held.max(1)[some] / total[some]
                    best = held.argmax(1)
                    for d in np.flatnonzero(batch["text"][lo:hi].is_valid().to_numpy(zero_copy_only=False)):
                        pred[d] = m.langs[best[d]]
                    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                    new = np.ones(len(labels), bool)
                    new[1:] = (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])
                    at = np.flatnonzero(new)
                    after = np.concatenate((starts[at[1:]], [len(data)])) if len(at) else at
                    for k, e in zip(at.tolist(), after.tolist()):
                        d = doc[k]
                        if total[d]:
                            base = chars[offs[d]]
                            spans[d].append({"start": int(chars[starts[k]] - base), "end": int(chars[min(e, offs[d + 1])] - base), "lang": m.langs[labels[k]]})
                yield pa.RecordBatch.from_arrays([batch["row"][lo:hi], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(spans, SPANS)], names=["row", "lang_pred", "score", "spans"])

    from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

    span = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())])
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("spans", ArrayType(span))])
    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32(doc_id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
