"""Language identification by partial matching.

Each language has a tree of byte contexts of up to ORDER bytes with counts. A
byte that was seen after the longest known context costs ``log2((n + q) / c)``
bits (n bytes and q different ones seen there, c of this one); otherwise an
escape, ``log2((n + q) / q)`` bits, leads to the next shorter context, where the
bytes of the longer one no longer count. After order 0, the bytes never seen
are equally likely. The statistics are frozen, so a text's code length is the
sum over its bytes, and the language with the shortest code is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ddl, lean, mix64, slices, stage, text_buffer, workers_import_us

#: longest context in bytes; labelled text learned from, in bytes: per language
#: (texts in hash order up to it) and over all languages together
ORDER, TRAIN_BYTES, TRAIN_TOTAL = 3, 4 << 20, 32 << 20
#: bits of a text's hash that a step of choosing looks at, of 60
BITS, ALL_BITS = 12, 60
#: one document of so many is held out of learning
FOLDS = 5
UNKNOWN = "und"


def grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Every byte with the ORDER before it, as one number; line breaks stand before a text."""
    n = len(offsets) - 1
    buffer = np.full(len(raw) + ORDER * n, 10, np.uint8)
    at = np.arange(len(raw)) + np.repeat(ORDER * np.arange(1, n + 1), np.diff(offsets))
    buffer[at] = raw
    code = np.zeros(len(raw), np.uint32)
    for back in range(ORDER, -1, -1):
        code = (code << np.uint32(8)) | buffer[at - back]
    return code


class ContextTree:
    """The counts of one language, by order: grams of j + 1 bytes under contexts of j."""

    def __init__(self, gram: np.ndarray, count: np.ndarray):
        self.levels = []
        for j in range(ORDER + 1):
            key, group = np.unique(gram & np.uint32((1 << 8 * (j + 1)) - 1), return_inverse=True)
            seen = np.bincount(group, weights=count).astype(np.int64)
            context, of = np.unique(key >> np.uint32(8), return_inverse=True)
            self.levels.append({"key": key, "seen": seen, "context": context,
                                "n": np.bincount(of, weights=seen).astype(np.int64), "q": np.bincount(of)})
            if j:  # what the bytes known here count in the context one shorter
                low = self.levels[j - 1]
                shorter = np.searchsorted(low["key"], key & np.uint32((1 << 8 * j) - 1))
                self.levels[j]["below"] = np.bincount(of, weights=low["seen"][shorter]).astype(np.int64)

    @staticmethod
    def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_keys, keys), max(len(sorted_keys) - 1, 0))
        return at, sorted_keys[at] == keys if len(sorted_keys) else np.zeros(len(keys), bool)

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Exact code lengths of the last bytes of ``gram``."""
        out = np.zeros(len(gram))
        todo = np.arange(len(gram))
        minus_n, minus_q = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
        for j in range(ORDER, -1, -1):
            level = self.levels[j]
            key = gram[todo] & np.uint32((1 << 8 * (j + 1)) - 1)
            at, known = self._find(level["context"], key >> np.uint32(8))
            n = np.where(known, level["n"][at], 0) - minus_n[todo]
            q = np.where(known, level["q"][at], 0) - minus_q[todo]
            sym, found = self._find(level["key"], key)
            found &= known
            some = n > 0
            cost = np.zeros(len(todo))
            cost[some] = np.log2((n + q)[some] / np.where(found, level["seen"][sym], q)[some])
            out[todo] += cost
            if j:
                minus_n[todo] = np.where(known, level["below"][at], 0)
                minus_q[todo] = np.where(known, level["q"][at], 0)
            todo = todo[~found]
        out[todo] += np.log2(max(256 - len(self.levels[0]["key"]), 1))
        return out


class CodeLengths:
    """Code lengths of all grams met in learning, for all languages, by an open hash table;
    others are worked out from the trees when they come up."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        self.trees = [ContextTree(*c) for c in counts]
        self.known = np.unique(np.concatenate([g for g, _ in counts]))
        self.bits = np.stack([t.bits(self.known) for t in self.trees])
        self.mask = np.uint64((1 << max(4, int(4 * len(self.known)).bit_length())) - 1)
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        left, place = np.arange(len(self.known), dtype=np.int32), self._home(self.known)
        while len(left):  # every free slot takes one; the others try the next
            free = self.slots[place] < 0
            self.slots[place[free]] = left[free]
            stays = self.slots[place] == left
            left, place = left[~stays], (place[~stays] + np.uint64(1)) & self.mask

    def _home(self, gram: np.ndarray) -> np.ndarray:
        return mix64(gram.astype(np.uint64)) & self.mask

    def look_up(self, gram: np.ndarray) -> np.ndarray:
        """Positions in ``known``, or -1."""
        place = self._home(gram)
        out = self.slots[place]
        wrong = np.flatnonzero((out >= 0) & (self.known[out] != gram))
        place = place[wrong]
        while len(wrong):
            place = (place + np.uint64(1)) & self.mask
            out[wrong] = self.slots[place]
            again = (out[wrong] >= 0) & (self.known[out[wrong]] != gram[wrong])
            wrong, place = wrong[again], place[again]
        return out

    def of_texts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text in every language: ``[languages, texts]``."""
        out = np.zeros((len(self.languages), len(offsets) - 1))
        some = np.flatnonzero(np.diff(offsets))
        if len(some) == 0:
            return out
        gram = grams(raw, offsets)
        at = self.look_up(gram)
        new = np.flatnonzero(at < 0)
        extra, back = np.unique(gram[new], return_inverse=True)
        at[new] = len(self.known) + back
        for row, bits, tree in zip(out, self.bits, self.trees):
            all_bits = np.concatenate([bits, tree.bits(extra)])
            row[some] = np.add.reduceat(all_bits[at], offsets[some])
        return out


def _edges(sizes: DataFrame, per_language: int, total: int) -> dict[str, tuple[int, int]]:
    """For every label of ``sizes(lang, h, size)`` the hash at which its budget runs out and
    the bytes left for that text. The bucket of hashes that holds it is refined, as in mixing."""
    done, budget, out, low = 0, None, {}, {}
    while done < ALL_BITS:
        shift = ALL_BITS - done - BITS
        inside = sizes
        if low:  # only the bucket in which a label's budget runs out
            prefix = F.element_at(F.create_map(*[F.lit(x) for k, v in low.items() for x in (k, v[0])]), F.col("lang"))
            inside = sizes.where(F.col("lang").isin(*low)).where(F.shiftright("h", shift + BITS) == prefix)
        hist = (inside.groupBy("lang", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        if budget is None:
            budget = min(per_language, total // max(1, sizes.select("lang").distinct().count()))
        owed = (F.element_at(F.create_map(*[F.lit(x) for k, v in low.items() for x in (k, v[1])]), F.col("lang"))
                if low else F.lit(max(1, budget)))
        by = Window.partitionBy("lang").orderBy("bucket")
        # the bucket in which the budget runs out, or else the last
        rows = (hist.withColumn("sofar", F.coalesce(F.sum("b").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn("owed", owed).where("sofar < owed").groupBy("lang")
                .agg(F.max(F.struct("bucket", F.expr("owed - sofar").alias("left"), "lo", "hi")).alias("e"))
                .select("lang", "e.*").collect())
        low = {r.lang: (r.bucket, r.left) for r in rows if r.lo < r.hi}
        out |= {r.lang: (r.hi, r.left) for r in rows if r.lo == r.hi}
        done += BITS
        if not low:
            break
    return out


def learn(docs: DataFrame, per_language: int = TRAIN_BYTES, total: int = TRAIN_TOTAL) -> CodeLengths | None:
    """Trees of every label of ``docs(lang, text)``.

    Learned from each language's distinct texts in the order of their hashes, up
    to ``per_language`` bytes (less where there are so many languages that
    ``total`` would be passed); of the text that passes the budget, only as many
    of its first characters as there are bytes left, but one at least. So every
    label with a text is learned, and what reaches the driver is bounded: at
    most one gram a byte.
    """
    hashed = docs.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0)).withColumn(
        "h", F.xxhash64("text").bitwiseAND(F.lit((1 << ALL_BITS) - 1)))
    sizes = stage(hashed.groupBy("lang", "h").agg(F.max(F.octet_length("text")).cast("long").alias("size")), "texts")
    edges = _edges(sizes, per_language, total)
    if not edges:
        return None
    of = lambda k: F.element_at(F.create_map(*[F.lit(x) for lang, e in edges.items() for x in (lang, e[k])]), F.col("lang"))
    chosen = (hashed.select("lang", "h", "text", of(0).alias("edge"), of(1).cast("int").alias("left")).where("h <= edge")
              .select("lang", "h", F.expr("if(h = edge, left(text, left), text)").alias("text")).distinct())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            langs = np.asarray(batch.column(0).to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs):
                parts = []
                for lo, hi in slices(offsets):
                    code = grams(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    own = np.repeat(langs[lo:hi] == lang, np.diff(offsets[lo:hi + 1]))
                    parts.append(np.unique(code[own], return_counts=True))
                for gram, n in parts:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)),
                                                      pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counts = (chosen.select("lang", "text").mapInArrow(lean(work), "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    by = {k: (g["gram"].to_numpy().astype(np.uint32), g["n"].to_numpy()) for k, g in counts.groupby("lang")}
    names = sorted(by)
    return CodeLengths(names, [by[k] for k in names]) if names else None


def predict(docs: DataFrame, model: CodeLengths | None) -> DataFrame:
    """``docs`` with ``lang_pred, score, bits_per_byte``.

    ``score`` is the probability of the prediction when all languages are as
    likely beforehand. Only the text is read.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*own, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("bits_per_byte"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = "lang_pred string, score double, bits_per_byte double"
    text_at = own.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = pa.array([*m.languages, UNKNOWN])
        for batch in batches:
            raw, offsets = text_buffer(batch.column(text_at))
            for lo, hi in slices(offsets):
                bits = m.of_texts(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                part, size = batch.slice(lo, hi - lo), np.diff(offsets[lo:hi + 1])
                lettered = part.column(len(own)).to_numpy(zero_copy_only=False)
                best = bits.argmin(axis=0)
                least = bits.min(axis=0)
                score = np.where(lettered, 1 / np.exp2(least - bits).sum(axis=0), 0.0)
                rate = least / np.maximum(size, 1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(own)], names.take(pa.array(np.where(lettered, best, len(m.languages)))),
                     pa.array(score), pa.array(rate, mask=size == 0)], names=[*own, "lang_pred", "score", "bits_per_byte"])

    return docs.select(*own, letters.alias("_letters")).mapInArrow(lean(work), f"{ddl(docs.select(*own).schema)}, {added}")


def held_out() -> Column:
    """Whether a document is kept out of learning; not for rows without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def identify(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Predictions for every row of ``docs(doc_id, text, lang, ...)``, learned from its own labels.

    Learns from rows with an id, a label and a text that are not held out;
    ``keep`` names the columns of the result beside the predictions.

    Defined cases: null texts and texts without a letter are ``und`` with score
    0; with nothing to learn from, all rows are; at a tie the first label in
    order; repeated rows are predicted alike; an empty table gives an empty
    result; columns of ``docs`` that carry one of the added names are replaced.
    """
    workers_import_us(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    model = learn(labelled.select("lang", "text"))
    keep = docs.columns if keep is None else keep
    asked = docs.withColumn("held_out", held_out()).select(*dict.fromkeys([*keep, "held_out", "text"]))
    return predict(asked, model).select(*dict.fromkeys([*keep, "held_out", "lang_pred", "score", "bits_per_byte"]))
