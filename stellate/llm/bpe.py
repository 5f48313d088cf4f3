"""Byte-level BPE encoding and decoding by speculation and verification.

Method. A text is cut into words as the vocabulary's pre-tokeniser does. For every new
distinct word a greedy longest match over the vocabulary *proposes* tokens. All adjacent
token pairs of all proposals are then *verified* together in numpy: a token sequence is
the merge result exactly when no merge crosses a boundary between neighbours at the time
both stand there. Only words with a failing pair go through the exact merge loop.

Edge cases: a null text is an empty text (no ids); very long texts are worked on whole, in
slices of rows; repeated rows give repeated results; extra input columns are ignored; an
empty table gives an empty result. Strings of special tokens in a text become their ids.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import lists, sha256_of_list, slices, text_input

#: Words kept by a Python worker between batches; the cache starts anew beyond it.
CACHED_WORDS = 800_000
#: Bytes of text cut into words at once: the strings take some ten times as much.
SLICE = 1 << 19
#: Words up to this many bytes are merged in a plain list, longer ones over a heap.
SHORT_WORD = 64
#: Fixed value: the public pattern that cuts text for byte-level BPE.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Scripts for which ``regex`` and the tokenizer's own engine class every character alike;
#: a text with any other character is cut by the tokenizer's own pre-tokeniser.
OTHER_SCRIPTS = regex.compile("[^\u0000-ӿ‐-⁠₠-₿ぁ-ゖァ-ヺ一-龥가-힣]")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BytePair:
    """Encoder and decoder over one vocabulary file of the ``tokenizers`` format."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(f"({regex.escape(s)})" for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.library = Tokenizer.from_file(path)
        alphabet = byte_alphabet()
        self.to_chars = {b: c for b, c in alphabet.items()}
        back = {c: b for b, c in alphabet.items()}
        vocab: dict[str, int] = spec["model"]["vocab"]
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * n
        for s, i in vocab.items():
            self.bytes_of[i] = bytes(back.get(c, 32) for c in s)
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        # rank: when a token is made (-1 for single bytes); halves of the merge that makes it
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.empty(len(merges), np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            keys[r] = i << 32 | j
            self.merge[i, j] = (r, k)
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = r, i, j
        self.never, self.made = len(merges), [self.merge[vocab[a], vocab[b]][1] for a, b in merges]
        self.rank_of_pair = {k: r for r, k in enumerate(keys.tolist())}
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        whole = self.rank >= 0
        ids = np.flatnonzero(whole)
        reachable = self.stays(self.left[ids], self.right[ids], self.rank[ids], self.rank[ids])
        usable = {i for i in vocab.values() if self.rank[i] < 0} | set(ids[reachable].tolist())
        self.token = {s: i for s, i in vocab.items() if i in usable}
        self.prefixes = {s[:k] for s in self.token for k in range(1, len(s) + 1)}
        self.cache: dict[str, bytes] = {}
        self.code = np.dtype(np.uint16 if n <= 1 << 16 else np.int32)

    def stays(self, a: np.ndarray, b: np.ndarray, pa_: np.ndarray | None = None, pb: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbouring tokens: whether no merge crosses their boundary.

        The boundary is followed back in time: of the two tokens that touch it the one made
        later is split into its halves, down to single bytes. A merge of the touching two
        would have come first if its rank is below that of the left one's own next merge
        (which lies further left, so it also wins a tie) and not above the right one's.
        """
        never = np.int64(1) << 40
        left, right = a.copy(), b.copy()
        left_until = np.full(len(a), never) if pa_ is None else pa_.copy()
        right_until = np.full(len(a), never) if pb is None else pb.copy()
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            x, y = left[live], right[live]
            key = x.astype(np.int64) << 32 | y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[at] == key, self.pair_ranks[at], never)
            ok[live[(merged < left_until[live]) & (merged <= right_until[live]) & (merged < never)]] = False
            rx, ry = self.rank[x], self.rank[y]
            go_left, go_right = live[rx > ry], live[(ry >= rx) & (ry >= 0)]
            left_until[go_left], left[go_left] = self.rank[left[go_left]], self.right[left[go_left]]
            right_until[go_right], right[go_right] = self.rank[right[go_right]], self.left[right[go_right]]
            live = live[ok[live] & ((rx >= 0) | (ry >= 0))]
        return ok

    def propose(self, chars: str) -> list[int]:
        out, at, n = [], 0, len(chars)
        token, prefixes = self.token, self.prefixes
        while at < n:
            end, best, best_end = at + 1, None, at
            while end <= n and (piece := chars[at:end]) in prefixes:
                if (hit := token.get(piece)) is not None:
                    best, best_end = hit, end
                end += 1
            if best is None:
                raise ValueError(f"byte {chars[at]!r} is not in the vocabulary")
            out.append(best)
            at = best_end
        return out

    def merge_exactly(self, chars: str) -> list[int]:
        """The merge loop itself, lowest rank first and leftmost among equals (heap over a
        linked list, so a very long word costs n log n)."""
        ids = [self.token[c] for c in chars]
        if len(ids) <= SHORT_WORD:
            return self.merge_short(ids)
        n = len(ids)
        nxt, prev, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = self.merge[a, b][1], False, nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
            for left, right in ((prev[i], i), (i, nxt[i])):
                if left >= 0 and right >= 0 and (m := self.merge.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (m[0], left, ids[left], ids[right]))
        return [t for t, live in zip(ids, alive, strict=True) if live]

    def merge_short(self, ids: list[int]) -> list[int]:
        """The same for a short word: ranks of neighbouring pairs in a plain list."""
        never, rank, made = self.never, self.rank_of_pair.get, self.made
        ranks = [rank(a << 32 | b, never) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (r := min(ranks)) != never:
            i = ranks.index(r)
            ids[i] = made[r]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | ids[i], never)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 32 | ids[i + 1], never)
        return ids

    def learn(self, words: set[str]) -> None:
        """Put the ids of new distinct words into the cache, as bytes."""
        words = list(words)
        spelled = [w.encode().decode("latin-1").translate(self.to_chars) for w in words]
        proposed = [self.propose(s) for s in spelled]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        of = np.repeat(np.arange(len(words)), lengths)
        inside = np.flatnonzero(of[1:] == of[:-1])
        pairs, where = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        fails = ~self.stays(pairs >> 32, pairs & 0xFFFFFFFF)
        coded, width = flat.astype(self.code).tobytes(), self.code.itemsize
        ends = (np.cumsum(lengths) * width).tolist()
        self.cache.update(zip(words, (coded[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        for i in np.unique(of[inside[fails[where]]]).tolist():
            self.cache[words[i]] = np.array(self.merge_exactly(spelled[i]), self.code).tobytes()

    def words(self, text: str) -> list[str]:
        if OTHER_SCRIPTS.search(text) is None:
            return WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """Words, with special tokens as pieces of their own."""
        if self.cut is None or self.cut.search(text) is None:
            return self.words(text)
        out: list[str] = []
        for part in self.cut.split(text):
            if part:
                out.extend([part] if part in self.special else self.words(part))
        return out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces(t) for t in texts]
        distinct = set().union(*cut) if cut else set()
        if len(self.cache) > CACHED_WORDS:
            self.cache = {}
        self.cache.update({s: self.code.type(i).tobytes() for s, i in self.special.items()})
        self.learn(distinct.difference(self.cache))
        find = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(find, c)), self.code).astype(np.int32) for c in cut]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> BytePair:
    return BytePair(path)


def _code(path: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches, limit=SLICE):
            ids = bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            columns = [batch.column(0), lists(flat, [len(x) for x in ids])]
            if decode:
                columns.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    return run


def encode_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", decode: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` and, with ``decode``, the text that the ids decode to.

    A map over the input partitions: no shuffle, no state beyond a bounded word cache.
    ``vocabulary`` is a path that every executor has (as installed with the tokenizers).
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", decoded string" * decode
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(_code(vocabulary, decode), schema)


def token_digests(encoded: DataFrame) -> DataFrame:
    """One digest row per document from the real ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_of_list(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
