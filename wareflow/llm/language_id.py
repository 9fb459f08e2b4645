"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds, for every slot, a bit mask of languages. Setting an n-gram sets the
language's bit in its `HASHES` slots; looking it up takes the AND of the slots' masks and so gives all
languages that list the n-gram in one step. A text adds up, for each language, how many of its n-grams
have the language's bit (popcounts per bit slice). A bit is also set by chance with the probability
fill**HASHES, known for each language from the filter itself; the popcounts are corrected for it before
the largest decides.

A language lists an n-gram if its rate there is at least `share` of the highest rate among all
languages. Rates are counted over all training rows. The filter has 2**SLOT_BITS slots, a fixed size,
whatever the number of n-grams; up to 63 languages.

n-grams are four bytes of the lower-cased text in UTF-8, with every ASCII byte that is no letter taken
as a blank, so they also see where words begin and end. Two blanks stand before and after each text, so
every text with a letter has n-grams, and the first and last word have their borders.

Defined cases: a null text, or one without any letter, is `und` with score 0; so is every text if
nothing was learned; equal counts go to the first language in alphabetical order; rows with a null
text or language do not train.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareflow.llm.arrays import map_columns, mix, quoted, set_aside, text_chunks
from wareflow.operators.shared import shared_folder, stored

SLOT_BITS = 20
HASHES = 3
SHARE = 0.2
UNKNOWN = "und"
_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [c if 97 <= c <= 122 else 32 for c in range(128)]


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram at every byte, and whether it lies inside one text and has a letter."""
    n = len(data) - 3
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    b = _FOLD[data].astype(np.uint32)
    gram = (b[:n] << 24) | (b[1 : n + 1] << 16) | (b[2 : n + 2] << 8) | b[3:]
    inside = gram != 0x20202020
    for edge in offsets[1:-1]:
        inside[max(0, edge - 3) : edge] = False
    return gram, inside


def _framed(text: Column) -> Column:
    return F.concat(F.lit("  "), F.lower(text), F.lit("  "))


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows (text, lang); each task adds up its own batches first."""

    def count(batches):
        held: dict[str, list] = {}

        def joined(parts: list):
            grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(grams)).astype(np.int64)
            return grams, n

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                gram, inside = _grams(data, offsets)
                at = np.flatnonzero(inside)
                row = np.searchsorted(offsets, at, "right") - 1
                names, code = np.unique(langs[lo:hi].astype(str), return_inverse=True)
                for k, lang in enumerate(names):
                    parts = held.setdefault(str(lang), [])
                    parts.append(np.unique(gram[at[code[row] == k]], return_counts=True))
                    if len(parts) > 16:
                        held[str(lang)] = [joined(parts)]
        for lang, parts in held.items():
            grams, n = joined(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    partial = rows.select("text", "lang").mapInArrow(count, "lang string, gram bigint, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, langs: list[str], masks: np.ndarray):
        self.langs, self.masks = langs, masks
        bits = (masks[:, None] >> np.arange(len(langs), dtype=masks.dtype)) & 1 if langs else np.zeros((1, 0))
        self.chance = bits.mean(axis=0) ** HASHES


def _slots(gram: np.ndarray) -> list[np.ndarray]:
    spread = mix(gram.astype(np.uint64) + _U(0x632BE59BD9B4E019))
    return [((spread >> _U(k * SLOT_BITS)) & _U((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(HASHES)]


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE) -> Model:
    """Learns from every row whose text and language are not null."""
    named = rows.select(F.col(quoted(text)).alias("text"), F.col(quoted(lang)).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = stored(gram_counts(named.withColumn("text", _framed(F.col("text")))), shared_folder(rows.sparkSession), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros(1, np.uint8))
    if len(langs) > 63:
        raise ValueError("at most 63 languages")
    total = F.create_map(*[F.lit(x) for name in langs for x in (name, float(totals[name]))])
    rate = counts.withColumn("rate", F.col("n") / total[F.col("lang")])
    # the languages of one n-gram: at most as many rows as languages
    best = rate.withColumn("best", F.max("rate").over(Window.partitionBy("gram")))
    bit = F.create_map(*[F.lit(x) for i, name in enumerate(langs) for x in (name, 1 << i)])
    listed = best.where(F.col("rate") >= share * F.col("best")).groupBy("gram").agg(F.bit_or(bit[F.col("lang")].cast("bigint")).alias("mask"))

    def slots(grams: pa.Array) -> list:
        return [np.stack(_slots(grams.to_numpy(zero_copy_only=False)), axis=1).tolist()]

    placed = map_columns(listed, slots, ["gram"], ["mask"], "slots array<bigint>").select("mask", F.explode("slots").alias("slot"))
    filled = placed.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    masks = np.zeros(1 << SLOT_BITS, np.uint64 if len(langs) > 8 else np.uint8)
    masks[filled["slot"].to_numpy(np.int64)] = filled["mask"].to_numpy(np.int64)
    return Model(langs, masks)


def predict(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the language and its corrected share among all languages' counts (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(texts: pa.Array, readable: pa.Array) -> list:
        m = shared.value
        readable = np.array(readable.to_pylist(), object).astype(bool)
        names, values = [], []
        for lo, hi, data, offsets in text_chunks(texts):
            gram, inside = _grams(data, offsets)
            at = np.flatnonzero(inside)
            row = np.searchsorted(offsets, at, "right") - 1
            mask = np.bitwise_and.reduce([m.masks[s] for s in _slots(gram[at])]) if m.langs else None
            seen = np.bincount(row, minlength=hi - lo).astype(float)
            corrected = np.zeros((hi - lo, max(1, len(m.langs))))
            for k in range(len(m.langs)):
                hits = np.bincount(row, weights=((mask >> mask.dtype.type(k)) & mask.dtype.type(1)).astype(float), minlength=hi - lo)
                corrected[:, k] = np.clip((hits - seen * m.chance[k]) / max(1e-9, 1 - m.chance[k]), 0, None)
            best, whole = corrected.argmax(axis=1), corrected.sum(axis=1)
            for i in range(hi - lo):
                ok = readable[lo + i] and bool(m.langs)
                names.append(m.langs[best[i]] if ok else UNKNOWN)
                values.append(float(corrected[i, best[i]] / whole[i]) if ok and whole[i] else 0.0)
        return [pa.array(names, pa.string()), values]

    given, names = set_aside(docs)
    own = F.col(names[text])
    ready = given.withColumns({"_lower": _framed(own), "_readable": F.coalesce(own.rlike(r"\p{L}"), F.lit(False))})
    out = map_columns(ready, decide, ["_lower", "_readable"], list(names.values()), "_lang string, _score double")
    kept = [F.col(n).alias(c) for c, n in names.items() if c.lower() not in (lang.lower(), score.lower())]
    return out.select(*kept, F.col("_lang").alias(lang), F.col("_score").alias(score))
