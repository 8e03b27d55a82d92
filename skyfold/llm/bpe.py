"""Byte-level BPE by speculation and verification.

A text is cut into words by the vocabulary's pre-tokenizer, and new words are
worked on many at a time. Greedy longest matches propose tokens. A sequence of
tokens is the one that merging gives exactly if every two neighbours are
compatible, that is if merging their joined bytes gives these two again; this
is told for all pairs at once by undoing merges, last first, on both sides of
the border and asking whether the tokens that meet there would have been merged
earlier. Only words with an incompatible pair are merged rank by rank.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, lean, slices, text_buffer, worker_table, workers_import_us

#: letters whose class is the same in every Unicode version, beside ASCII
_LATIN = "À-ÖØ-öø-ɏ"
#: texts of these characters are cut here, others by the library
PLAIN = re.compile(f"[\t-\r -~{_LATIN}]*")
#: words of a plain text (fixed by the vocabulary's pre-tokenizer)
WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9{_LATIN}]+"
                   "|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: words longer than this are worked on alone and never kept; bytes of words and
#: ids that each of a worker's two generations keeps; bytes of text worked on at once
LONG, KEPT_BYTES, TEXT_BYTES = 256, 16 << 20, 4 << 20
#: what a kept word costs beside its bytes
_ENTRY = 150
_NEVER = np.int64(1 << 40)

def byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary file: printable
    bytes stand for themselves, the others for 256, 257, ... in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Merges:
    """Tables of a vocabulary file, and the words a worker has met."""

    def __init__(self, path: str, kept: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library, self.kept = Tokenizer.from_file(path), kept
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        self.byte_of = {c: b for b, c in enumerate(byte_chars())}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.special = special
        self.specials = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) or "(?!)")
        pieces = {i: bytes(map(self.byte_of.__getitem__, t)) for t, i in vocabulary.items() if t not in special}
        pieces |= {i: t.encode() for t, i in special.items()}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.of_byte = np.array([vocabulary[c] for c in byte_chars()], np.int64)
        self._merges([m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]], vocabulary)
        self._trie({i: p for i, p in pieces.items() if p and self.pieces[i] == p and i not in special.values()})
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _merges(self, merges: list[list[str]], vocabulary: dict[str, int]) -> None:
        n = len(self.pieces)
        left, right, product = (np.array(x, np.int64) for x in zip(
            *[(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges])) if merges else [np.empty(0, np.int64)] * 3
        if len(np.unique(product)) < len(product):
            raise ValueError("a token is made by two merges")
        # the merge that makes a token: its rank (-1: a byte) and its parts
        self.made, self.left, self.right = np.full(n, -1), np.arange(n), np.arange(n)
        self.made[product] = np.arange(len(product))
        self.left[product], self.right[product] = left, right
        key = left << 32 | right
        order = np.argsort(key)
        self.pair_keys, self.pair_ranks = np.append(key[order], -1), np.append(order, _NEVER)
        self.product = product

    def _trie(self, pieces: dict[int, bytes]) -> None:
        """Prefixes of all tokens that merging their own bytes gives back."""
        ids, words = list(pieces), list(pieces.values())
        whole = [i for i, t in zip(ids, self.merge(words)) if len(t) == 1 and t[0] == i]
        node, accept = {b"": 0}, {}
        for i in whole:
            p = pieces[i]
            for end in range(1, len(p) + 1):
                node.setdefault(p[:end], len(node))
            accept[node[p]] = i
        key = np.array([node[p[:-1]] << 8 | p[-1] for p in node if p], np.int64)
        to = np.array([v for p, v in node.items() if p], np.int64)
        order = np.argsort(key)
        self.step_keys, self.step_to = np.append(key[order], -1), np.append(to[order], -1)
        self.accepts = np.full(len(node), -1)
        self.accepts[list(accept)] = list(accept.values())
        self.steps: dict[int, int] = {}

    # -- merging ------------------------------------------------------------

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each two tokens; beyond all ranks where there is none."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys[:-1], key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Tokens of words by exact merging: the lowest rank first, the leftmost of equals."""
        out: list[np.ndarray] = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._merge_long(w)
        short.sort(key=lambda i: len(words[i]))
        for lo in range(0, len(short), 4096):  # words of about one length
            part = short[lo:lo + 4096]
            for i, tokens in zip(part, self._merge_rows([words[i] for i in part])):
                out[i] = tokens
        return out

    def _merge_rows(self, words: list[bytes]) -> list[np.ndarray]:
        size = np.array([len(w) for w in words])
        width = max(1, int(size.max()))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        rows = np.where(np.arange(width) < size[:, None], self.of_byte[raw], -1)
        at, column = np.arange(len(words)), np.arange(width - 1)
        while len(at) and width > 1:
            now = rows[at]
            ranks = np.where(now[:, 1:] >= 0, self.rank(now[:, :-1], now[:, 1:]), _NEVER)
            first = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), first]
            more = best < _NEVER
            at, now, first, best = at[more], now[more], first[more], best[more]
            moved = np.where(column > first[:, None], now[:, 1:], now[:, :-1])
            moved[np.arange(len(at)), first] = self.product[best]
            rows[at, :-1], rows[at, -1] = moved, -1
        return [r[r >= 0] for r in rows]

    def _merge_long(self, word: bytes) -> np.ndarray:
        tokens = self.of_byte[np.frombuffer(word, np.uint8)]
        ranks = self.rank(tokens[:-1], tokens[1:])
        heap = [(int(ranks[i]), int(i)) for i in np.flatnonzero(ranks < _NEVER)]
        heapq.heapify(heap)
        token, n = tokens.tolist(), len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        look = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist()))

        def offer(i: int, j: int) -> None:
            r = look.get(token[i] << 32 | token[j])
            if r is not None:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j >= n or look.get(token[i] << 32 | token[j]) != r:
                continue  # one of the two has been merged since
            token[i], token[j] = int(self.product[r]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return np.array([t for t in token if t >= 0], np.int64)

    # -- speculation and verification -----------------------------------------

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joined bytes of tokens ``a`` and ``b`` gives ``a, b`` again.

        Going back in time, the later made of the two is taken apart; the tokens
        then at the border were neighbours until that merge, so they must not
        have one of a lower rank (nor, at a right token, of its own: of equal
        ranks the leftmost pair goes first).
        """
        ok, at = np.ones(len(a), bool), np.arange(len(a))
        until = np.full(len(a), _NEVER)
        while len(at):
            fine = self.rank(a, b) >= until
            ok[at[~fine]] = False
            of_a, of_b = self.made[a], self.made[b]
            going = fine & ((of_a >= 0) | (of_b >= 0))
            at, a, b, of_a, of_b = at[going], a[going], b[going], of_a[going], of_b[going]
            undo_a = of_a > of_b
            until = np.where(undo_a, of_a, of_b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches: ``(tokens, word of each)``, words in order."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words])
        at = end - [len(w) for w in words]
        word = np.flatnonzero(at < end)
        at, end = at[word], end[word]
        node, token, upto = (np.zeros(len(word), np.int64) for _ in range(3))
        tokens, owners = [], []
        while len(word):  # all words a byte further at a time
            key = np.where(at < end, node << 8 | raw[np.minimum(at, end - 1)], -2)
            step = np.searchsorted(self.step_keys[:-1], key)
            on = self.step_keys[step] == key
            node = np.where(on, self.step_to[step], 0)
            at = at + on
            hit = on & (self.accepts[node] >= 0)
            token, upto = np.where(hit, self.accepts[node], token), np.where(hit, at, upto)
            tokens.append(token[~on])  # no longer match: the longest so far is proposed
            owners.append(word[~on])
            at = np.where(on, at, upto)
            left = on | (at < end)
            word, at, end, node, token, upto = (x[left] for x in (word, at, end, node, token, upto))
        if not tokens:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        return tokens[order], owners[order]

    def _propose_long(self, word: bytes) -> np.ndarray:
        if not self.steps:
            self.steps = dict(zip(self.step_keys.tolist(), self.step_to.tolist()))
        out, at, accepts, get = [], 0, self.accepts.tolist(), self.steps.get
        while at < len(word):
            node, end, token, upto = 0, at, -1, at
            while end < len(word) and (node := get(node << 8 | word[end])) is not None:
                end += 1
                if accepts[node] >= 0:
                    token, upto = accepts[node], end
            out.append(token)
            at = upto
        return np.array(out, np.int64)

    def tokens(self, words: list[bytes]) -> list[np.ndarray]:
        """Tokens of any words."""
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        found, owner = self.propose([words[i] for i in short])
        bounds = np.searchsorted(owner, np.arange(len(short) + 1))
        long_ = [i for i, w in enumerate(words) if len(w) > LONG]
        parts = [found, *[self._propose_long(words[i]) for i in long_]]
        bounds = np.concatenate([bounds, len(found) + np.cumsum([len(p) for p in parts[1:]], dtype=np.int64)])
        found = np.concatenate(parts)
        inner = np.ones(max(len(found) - 1, 0), bool)  # pairs within a word
        inner[bounds[(bounds > 0) & (bounds < len(found))] - 1] = False
        pairs = np.flatnonzero(inner)
        bad = pairs[~self.compatible(found[pairs], found[pairs + 1])]
        at = short + long_
        out = dict(zip(at, np.split(found, bounds[1:-1]) if at else []))
        failed = [at[k] for k in np.unique(np.searchsorted(bounds, bad, side="right") - 1)]
        out.update(zip(failed, self.merge([words[i] for i in failed])))
        return [out[i] for i in range(len(words))]

    # -- texts ----------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Words of a text without special strings, in order."""
        if PLAIN.fullmatch(text):
            return WORDS.findall(text)
        cut = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in cut]

    def _keep(self, word: str, ids: bytes) -> None:
        if len(word) <= LONG:
            self.new[word] = ids
            self.held += _ENTRY + len(word) + len(ids)

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids, as little-endian 32-bit bytes, of all ``words``."""
        if self.held > self.kept:
            self.old, self.new, self.held = self.new, {}, 0
        out, ask = {}, []
        for w in words:
            ids = self.new.get(w)
            if ids is None and (ids := self.old.get(w)) is not None:
                self._keep(w, ids)
            if ids is None:
                ask.append(w)
            else:
                out[w] = ids
        for w, tokens in zip(ask, self.tokens([w.encode() for w in ask])):
            out[w] = tokens.astype("<i4").tobytes()
            self._keep(w, out[w])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; special strings are their own ids, as the library's default has them."""
        cut = []
        for t in texts:
            parts, at = [], 0
            for m in self.specials.finditer(t):
                parts += [self.words(t[at:m.start()]), self.special[m.group()]]
                at = m.end()
            cut.append([*parts, self.words(t[at:] if at else t)])
        book = self.learn({w for parts in cut for p in parts if isinstance(p, list) for w in p})
        return [np.frombuffer(b"".join([b"".join(map(book.__getitem__, p)) if isinstance(p, list)
                                        else p.to_bytes(4, "little") for p in parts]), "<i4") for parts in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are not UTF-8 become U+FFFD, ids beyond the vocabulary nothing."""
        pieces, n = self.pieces, len(self.pieces)
        return b"".join([pieces[i] for i in ids if i is not None and 0 <= i < n]).decode("utf-8", errors="replace")


def merges(path: str) -> Merges:
    """This worker's tables of a vocabulary file; they outlive a task."""
    return worker_table(("merges", path), lambda: Merges(path))


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns called by number: whatever their names, Arrow batches can take them."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the column ``ids``, an array of the token ids of ``text``; with
    ``decoded``, also a column of that name with the text decoded from them (in the
    same task, which spares a second worker).

    Defined cases: a null or empty text has no ids and decodes to an empty text;
    special strings are one id each; a word of any length is worked on whole, in
    memory in proportion to it; repeated rows are encoded each for itself;
    columns named like a result are replaced, all others stay; an empty table
    gives an empty result.
    """
    workers_import_us(docs.sparkSession)
    added = [ids, *([decoded] if decoded else [])]
    rest = docs.select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c not in added])
    names, at = [*rest.columns, *added], rest.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = merges(path)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(at))
            for lo, hi in slices(offsets, TEXT_BYTES):
                where, whole = (offsets[lo:hi + 1] - offsets[lo]).tolist(), raw[offsets[lo]:offsets[hi]].tobytes()
                found = book.encode([whole[a:b].decode() for a, b in zip(where, where[1:])])
                bounds = np.cumsum([0, *map(len, found)])
                columns = [*batch.slice(lo, hi - lo).columns,
                           pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(found), pa.int32()))]
                if decoded:
                    columns.append(pa.array([book.decode(f.tolist()) for f in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = ["array<int>", "string"][:len(added)]
    return _numbered(rest).mapInArrow(lean(work, tables=True), ", ".join([ddl(rest.schema), *[f"`{c}` {k}" for c, k in zip(added, kinds)]]))


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the column ``text`` decoded from their ``ids``.

    Defined cases: null and empty ``ids`` decode to an empty text; null ids and ids
    beyond the vocabulary to nothing; bytes that are not UTF-8 to U+FFFD; a column
    named like the result is replaced; an empty table gives an empty result.
    """
    workers_import_us(rows.sparkSession)
    rest = rows.select(*[F.col(f"`{c.replace('`', '``')}`") for c in rows.columns if c != text])
    names, at = [*rest.columns, text], rest.columns.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = merges(path)
        for batch in batches:
            texts = [book.decode(i or []) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return _numbered(rest).mapInArrow(lean(work, tables=True), f"{ddl(rest.schema)}, `{text}` string")
