"""Byte-level BPE encoding and decoding with a tokenizer file's vocabulary and merges.

A pre-token's bytes become a doubly linked list of symbols. A priority queue holds the merges that are
possible between neighbours, by (rank, position); the best is taken, its two symbols become one, and the
pairs which that makes are queued. Entries whose symbols have changed since are stale and skipped.
Decoding concatenates the vocabulary's strings, turned back into bytes.

Each Python worker remembers what it has met, so that the queue only runs for what is new: the ids of
pre-tokens, and of pieces (a word with the white space before it) the ids, their decimals and the bytes
they decode to. Both tables have two generations of bounded size: what is met again moves to the newer
one, so common entries stay and rare ones go. The tables never change a result.

Edge cases: null and empty texts have no tokens and decode to the empty text; the string of an added
token (such as <|endoftext|>) in a text becomes that token, as the tokenizers library does (op4 counts
such a string as ordinary text); repeated documents each get a row; very long pre-tokens take time in
proportion to their length times its logarithm and aren't remembered; an empty table has no rows; further
columns are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import table

#: Unicode's White_Space property.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Each pre-token lies within one piece: white space and what follows it up to the next white space.
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: The pre-tokenizer's fixed pattern, with white space spelt out.
_PRE_TOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: What a worker remembers of pieces and of pre-tokens, in bytes; what an entry has besides its characters, and the most characters of what is remembered.
TABLE_BYTES, ENTRY, LONGEST = 400_000_000, 300, 64


def byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Remembered:
    """What a worker has met, in two generations: when the newer is full, it becomes the older, and the older goes."""

    def __init__(self, size: int):
        self.size, self.held, self.newer, self.older = size, 0, {}, {}

    def find(self, key: str):
        """What is known of a key, else None; an older entry becomes a newer one."""
        if (out := self.newer.get(key)) is None and (out := self.older.get(key)) is not None:
            self.add(key, out)
        return out

    def add(self, key: str, value) -> None:
        if len(key) > LONGEST:
            return
        if self.held >= self.size:
            self.held, self.older, self.newer = 0, self.newer, {}
        self.held += ENTRY + 4 * len(key)
        self.newer[key] = value


def unsupported(spec: dict) -> list[str]:
    """What a tokenizer file asks for that the encoder doesn't do."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    out = [x for x in ("normalizer", "truncation", "padding") if spec.get(x)]
    out += [x for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(x)]
    if model.get("type", "BPE") != "BPE":
        out.append(f"model {model['type']}")
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space", True) or not before.get("use_regex", True):
        out.append("pre_tokenizer")
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        out.append("decoder")
    return out + [f"{x} of {t['content']}" for t in spec.get("added_tokens") or [] for x in ("lstrip", "rstrip", "single_word") if t.get(x)]


#: Ids as 32-bit integers, the same as decimals joined by commas, and the bytes that they decode to.
Piece = tuple[bytes, str, bytes]


class BytePairEncoder:
    """Encoder and decoder of a byte-level BPE tokenizer file of the tokenizers library; other files are refused."""

    def __init__(self, path: str, table_bytes: int = TABLE_BYTES):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if found := unsupported(spec):
            raise ValueError(f"{path} asks for what this encoder doesn't do: {', '.join(found)}")
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        characters = byte_characters()
        values = {c: b for b, c in characters.items()}
        self.first = [vocabulary[characters[b]] for b in range(256)]
        #: By rank the id that a merge makes, and by the id of its first symbol the ranks by the second.
        self.made: list[int] = []
        nothing: dict[int, int] = {}
        self.ranks: list[dict[int, int]] = [nothing] * (1 + max(vocabulary.values()))
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.made.append(vocabulary[a + b])
            if self.ranks[vocabulary[a]] is nothing:
                self.ranks[vocabulary[a]] = {}
            self.ranks[vocabulary[a]][vocabulary[b]] = rank
        #: The same for two bytes; -1 where they don't merge.
        self.pairs = [[self.ranks[a].get(b, -1) for b in self.first] for a in self.first]
        self.bytes_of = {i: bytes(values[c] for c in token) for token, i in vocabulary.items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: content.encode() for content, i in added.items()}
        self.decimals = list(map(str, range(1 + max(self.bytes_of))))
        self.added = {content: self.as_piece([i]) for content, i in added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.tokens, self.known = Remembered(table_bytes // 10), Remembered(table_bytes * 4 // 10)  # in two generations each

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        n = len(data)
        symbols = [self.first[b] for b in data]
        pairs = self.pairs
        # of each symbol: the entry (rank and place in one number) of its merge with the next one, if there is one
        shift = 12 if n <= 4096 else 32
        entries = [-1 if (x := pairs[a][b]) < 0 else x << shift | i for i, (a, b) in enumerate(zip(data, data[1:]))]
        queue = [x for x in entries if x >= 0]
        if not queue:
            return symbols
        heapq.heapify(queue)
        entries.append(-1)
        before, after, places = list(range(-1, n - 1)), list(range(1, n + 1)), (1 << shift) - 1
        pop, push, ranks, made = heapq.heappop, heapq.heappush, self.ranks, self.made
        while queue:
            entry = pop(queue)
            i = entry & places
            if entries[i] != entry:
                continue  # stale: a symbol of the pair has changed since
            j = after[i]
            new = symbols[i] = made[entry >> shift]
            symbols[j] = entries[j] = entries[i] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := ranks[new].get(symbols[k])) is not None:
                    entries[i] = x = x << shift | i
                    push(queue, x)
            if (h := before[i]) >= 0:
                if (x := ranks[symbols[h]].get(new)) is None:
                    entries[h] = -1
                else:
                    entries[h] = x = x << shift | h
                    push(queue, x)
        return [s for s in symbols if s >= 0]

    def as_piece(self, ids: list[int]) -> Piece:
        return array("i", ids).tobytes(), ",".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids))

    def piece(self, piece: str) -> Piece:
        """What is remembered of a piece, or is worked out now."""
        if (out := self.known.find(piece)) is None:
            ids: list[int] = []
            if piece.isalpha() or piece[0] == " " and piece[1:].isalpha():  # letters alone are one pre-token
                ids = self.merge(piece.encode())
            else:
                for token in _PRE_TOKEN.findall(piece):
                    if (found := self.known.newer.get(token)) is not None:
                        ids += memoryview(found[0]).cast("i")
                    elif (packed := self.tokens.find(token)) is not None:
                        ids += memoryview(packed).cast("i")
                    else:
                        own = self.merge(token.encode())
                        self.tokens.add(token, array("i", own).tobytes())
                        ids += own
            out = self.as_piece(ids)
            self.known.add(piece, out)
        return out

    def pieces(self, text: str | None) -> list[Piece]:
        """A text's pieces in order."""
        out: list[Piece] = []
        parts = self.split_added.split(text or "") if self.split_added else [text or ""]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part])
            else:
                met, piece = self.known.newer.get, self.piece
                out += [met(x) or piece(x) for x in _PIECE.findall(part)]
        return out

    def encode(self, text: str | None) -> list[int]:
        return array("i", b"".join(ids for ids, _, _ in self.pieces(text))).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[tuple[str, int], BytePairEncoder] = {}


def encoder(path: str, table_bytes: int = TABLE_BYTES) -> BytePairEncoder:
    """The worker's encoder for a tokenizer file: made once and kept while the worker lives."""
    if (path, table_bytes) not in _encoders:
        _encoders[path, table_bytes] = BytePairEncoder(path, table_bytes)
    return _encoders[path, table_bytes]


def public_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file, which every machine has for itself."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _encode_batches(batches: Iterator[pa.RecordBatch], tokenizer: str | None, with_ids: bool, table_bytes: int) -> Iterator[pa.RecordBatch]:
    own = encoder(tokenizer or public_path(), table_bytes)
    collected = gc.isenabled()
    gc.disable()  # nothing here refers to itself, and looking through full tables takes time
    try:
        yield from _encoded(own, batches, with_ids)
    finally:
        if collected:
            gc.enable()


def _encoded(own: BytePairEncoder, batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    digest = lambda data: hashlib.sha256(data).hexdigest()
    for batch in batches:
        values, counts, digests, sums = [], [], [], []
        for text in batch.column(1):
            found = own.pieces(text.as_py())
            ids, decimals, decoded = zip(*found, strict=True) if found else ((), (), ())
            packed = b"".join(ids)
            if with_ids:
                values.append(packed)
            counts.append(len(packed) // 4)
            digests.append(digest(",".join(decimals).encode()))
            sums.append(digest(b"".join(decoded).decode("utf-8", "replace").encode()))
        columns = {"id": batch.column(0).cast(pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(digests, pa.string()), "decoded_sha256": pa.array(sums, pa.string())}
        if with_ids:
            offsets = pa.array([0, *accumulate(counts)], pa.int32())
            columns["ids"] = pa.ListArray.from_arrays(offsets, pa.Array.from_buffers(pa.int32(), sum(counts), [None, pa.py_buffer(b"".join(values))]))
        yield pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, *, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """id, n_tokens and digests of the ids and of the decoded text of every whole text, and its ids unless with_ids is False.

    tokenizer: a byte-level BPE file of the tokenizers library, at this path on every machine; by default the public one.
    table_bytes: what each Python worker remembers of pieces it has met; less takes more time and gives the same result.
    """
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(lambda batches: _encode_batches(batches, tokenizer, with_ids, table_bytes), schema)


def decode(encoded: DataFrame, *, tokenizer: str | None = None, doc_id: str = "id", ids: str = "ids") -> DataFrame:
    """(id, text) of rows of ids; null is an empty text."""

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer or public_path())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(x.as_py() or []) for x in batch.column(1)], pa.string())], ["id", "text"])

    return encoded.select(F.col(doc_id).cast("long").alias("id"), F.col(ids).alias("ids")).mapInArrow(decode_batches, "id long, text string")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), with_ids=False).withColumnRenamed("id", "doc_id")
