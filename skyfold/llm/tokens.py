"""Token ids of the public word tokenizer, and token counts of every document.

The tokenizer drops white space and encodes every pre-token for itself, so a
text's ids are those of its pre-tokens in a row, and the library is asked once
for each new one. Words that hold other characters than ASCII and Latin
letters, or one of the tokenizer's special strings, are asked for as a whole:
the tokenizer never joins across white space, and special strings hold none.
"""

from __future__ import annotations

import gc
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, lean, slices, stage, text_buffer, worker_table, workers_import_us

#: ASCII and precomposed Latin letters: their lower case, normal form and letter
#: class are the same in every Unicode version
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
PLAIN = re.compile(f"[!-~{_LATIN}{WHITE}]*")
WORDS = re.compile(f"[^{WHITE}]+")
#: pre-tokens of lower-cased plain text (fixed by the vocabulary file)
PRE_TOKENS = re.compile(f"[a-z{_LATIN}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^a-z0-9{_LATIN}{WHITE}]+")
SPECIAL = "<|"
#: bytes that units and ids kept in each of a worker's two generations may take, pre-tokens
#: asked of the library at once, and bytes of text whose units are learned together
KEPT_BYTES, ASKED, LEARN_BYTES = 60 << 20, 500, 4 << 20
#: what a kept unit takes beside its own bytes and its ids
_ENTRY = 160


class UnitIds:
    """Ids of a text's units, as little-endian unsigned 32-bit bytes, by the library."""

    def __init__(self, path: str, kept: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library, self.kept = Tokenizer.from_file(path), kept
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    @staticmethod
    def units(text: str) -> list[str]:
        """A text's pre-tokens, or whole words where they are not plain, in order."""
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return PRE_TOKENS.findall(text.lower())
        out = []
        for w in WORDS.findall(text):
            if PLAIN.fullmatch(w) and SPECIAL not in w:
                out += PRE_TOKENS.findall(w.lower())
            else:
                out.append(w)
        return out

    def _of_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of any words, each asked for itself."""
        for e in self.library.encode_batch_fast(words, add_special_tokens=False):
            yield np.array(e.ids, dtype="<u4").tobytes()

    def _of_parts(self, parts: list[str]) -> Iterator[bytes]:
        """Ids of plain pre-tokens: in a row, each ends at the next id that ends one."""
        rows = [" ".join(parts[lo:lo + ASKED]) for lo in range(0, len(parts), ASKED)]
        for e in self.library.encode_batch_fast(rows, add_special_tokens=False):
            ids = np.array(e.ids, dtype="<u4")
            ends, raw, at = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist(), ids.tobytes(), 0
            for end in ends:
                yield raw[at:end]
                at = end

    def learn(self, units: set[str]) -> dict[str, bytes]:
        """Ids of all ``units``; the table returned holds at least these."""
        collects = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and each pass would walk the whole table
        try:
            if self.held > self.kept:
                self.old, self.new, self.held = self.new, {}, 0
            new, old, parts, whole = self.new, self.old, [], []
            for u in units.difference(new):
                ids = old.get(u)
                if ids is not None:
                    new[u] = ids
                    self.held += _ENTRY + len(u) + len(ids)
                elif PLAIN.fullmatch(u) and SPECIAL not in u:
                    parts.append(u)
                else:
                    whole.append(u)
            new.update(zip(whole, self._of_words(whole), strict=True))
            new.update(zip(parts, self._of_parts(parts), strict=True))
            for asked in (whole, parts):
                self.held += (_ENTRY * len(asked) + sum(map(len, asked))
                              + sum(map(len, map(new.__getitem__, asked))))
            return new
        finally:
            if collects:
                gc.enable()


    def streams(self, texts: list[list[str]]) -> Iterator[bytes]:
        """Ids of every text, given as its units: looked up once, new units learned together."""
        get = self.new.get
        found = [list(map(get, units)) for units in texts]
        holes = [[i for i, ids in enumerate(f) if ids is None] if None in f else () for f in found]
        ids = self.learn({units[i] for units, h in zip(texts, holes) for i in h})
        for units, f, h in zip(texts, found, holes):
            for i in h:
                f[i] = ids[units[i]]
            yield b"".join(f)


def unit_ids(path: str, kept: int = KEPT_BYTES) -> UnitIds:
    """This worker's table for a vocabulary file; it outlives a task."""
    return worker_table(("units", path, kept), lambda: UnitIds(path, kept))


def decoded(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    at, whole = offsets.tolist(), raw.tobytes()
    return [whole[a:b].decode() for a, b in zip(at, at[1:])]


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------------------
# Token counts
# ---------------------------------------------------------------------------

#: documents expected in the sample that chooses the common units, and the
#: number and length (bytes) of common units: what is sent to every worker is
#: at most COMMON_UNITS * (COMMON_BYTES + 8) bytes, whatever the input (the join of
#: all others takes 0.80 x the input of disk with these, 1.94 x with a quarter of them)
SAMPLE_DOCS, COMMON_UNITS, COMMON_BYTES = 12288, 1 << 18, 40


def _frequencies(docs: DataFrame, common: dict[str, int]) -> DataFrame:
    """Per document: bytes, tokens of its common units, and its other units with counts."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for lo, hi in slices(offsets, LEARN_BYTES):
                sums, units, counts, bounds = [], [], [], [0]
                for text in decoded(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]):
                    tokens = 0
                    for u, n in Counter(UnitIds.units(text)).items():
                        p = known.get(u)
                        if p is None:
                            units.append(u)
                            counts.append(n)
                        else:
                            tokens += n * p
                    sums.append(tokens)
                    bounds.append(len(units))
                n, bounds = hi - lo, pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(np.arange(row, row + n)),
                     pa.array(np.diff(offsets[lo:hi + 1])), pa.array(sums, pa.int64()),
                     pa.ListArray.from_arrays(bounds, pa.array(units, pa.string())),
                     pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int32()))],
                    names=["doc_id", "row", "n_bytes", "common", "units", "counts"])
                row += n

    return docs.mapInArrow(lean(work), "doc_id long, row long, n_bytes long, common long, "
                                 "units array<string>, counts array<int>")


def _piece_counts(units: DataFrame, path: str) -> DataFrame:
    """``unit, pieces``: the library is asked once for each row of ``units``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = unit_ids(path)
        for batch in batches:
            listed = batch.column(0).to_pylist()
            ids = book.learn(set(listed))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(ids[u]) // 4 for u in listed], pa.int32())], names=["unit", "pieces"])

    return units.mapInArrow(lean(work, tables=True), "unit string, pieces int")


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Units common in a bounded sample are counted first and sent to every worker;
    they are most of a text. All others go through a join: pieces are counted
    once for each distinct unit of the corpus, joined to the documents' unit
    frequencies, and summed. No ids are kept. The sample only decides which way
    a unit takes, so the counts are exact whatever it holds.

    Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
    are counted each for itself; special strings count as the library's default
    has them; an empty table gives an empty result; other columns are ignored.
    """
    workers_import_us(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    total = docs.count()
    part = min(1.0, SAMPLE_DOCS / max(total, 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
    exploded = lambda df: df.select("row", F.explode(F.arrays_zip("units", "counts")).alias("f")).select(
        "row", F.col("f.units").alias("unit"), F.col("f.counts").alias("n"))
    frequent = (exploded(_frequencies(sample, {})).where(F.octet_length("unit") <= COMMON_BYTES)
                .groupBy("unit").agg(F.sum("n").alias("n")).where("n > 1")
                .orderBy(F.desc("n"), "unit").limit(COMMON_UNITS))
    common = {r.unit: r.pieces for r in _piece_counts(frequent.select("unit"), path).collect()}

    table = stage(_frequencies(docs, common), "frequencies")
    rest = exploded(table)
    pieces = _piece_counts(rest.select("unit").distinct(), path)
    sums = rest.join(pieces, "unit").groupBy("row").agg(F.sum(F.col("n").cast("long") * F.col("pieces")).alias("others"))
    return (table.select("doc_id", "row", "n_bytes", "common").join(sums, "row", "left")
            .select("doc_id", "n_bytes", (F.col("common") + F.coalesce("others", F.lit(0))).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
