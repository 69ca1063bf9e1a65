"""Token alignment of two tokenizers over a corpus, by distinct segments.

A is a byte-level BPE file of the tokenizers library, B a BPE model of sentencepiece. Both encode a text with one
space before it. Byte offsets where tokens of both end cut a text into groups, and all pairs of A's and B's tokens in
a group are links. Steps:

1. Cut: texts are cut before runs of white space that begin with a space and follow another character. That is done
   only if cuts_hold() has verified that no token of either vocabulary reaches across such a place and that neither
   tokenizer looks further than that; otherwise a whole text is one segment, and results are the same. A text becomes
   a list of numbers of its segments within a block of some `BLOCK_BYTES` of text. A block's distinct segments are
   dealt to ranges of their hashes, of which there are as many as keep each at about `RANGE_BYTES` of text.
2. Align: the distinct segments of a range are encoded and aligned once, many at a time as one text.
3. Join back: each block that holds a segment of the range gets its groups. A segment has at most one entry a block,
   however frequent it is.
4. Compose: a block's documents are put together from their lists of numbers and the groups of the block's segments:
   tokens, groups, links, and how often each pair of ids is linked. For each pair, the documents that hold it are
   counted by block and summed over blocks.
5. Rank: the counts of a block's pairs go back to the block, and every document sums them over its links.

Groups are kept as the text that the digest is of, `a1,a2|b1;a3|b2,b3`; numbers and texts between steps are compressed.

A document whose tokens don't give back its bytes (a character that only stands for a space) has no tokens. Edge
cases: null and empty texts have none either; strings of special tokens are plain text; a text without a space is one
segment, and very long texts are lists of numbers like others, in a block of their own; repeated documents count
each; rows without an id are kept with a null id; an empty table has no rows; further columns are not looked at. Ids are integers.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tideline.llm.bpe import byte_characters, public_path
from tideline.llm.tables import stored, table

#: Text in a block; a longer text is a block of its own.
BLOCK_BYTES = 6_000_000
#: Text whose segments a range has about.
RANGE_BYTES = 16_000_000
#: Segments that are encoded at a time.
_AT_ONCE = 4_000
_SPACE = "▁"
#: A space after other white space; at such places no cut is made.
_ODD = re.compile(r"[^\S ] ")


def _piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def cuts_hold(a: str, b: str) -> bool:
    """Whether both tokenizers encode the parts before and after a cut as if the other weren't there."""
    with open(a, encoding="utf-8") as file:
        spec = json.load(file)
    rule, model = spec.get("pre_tokenizer") or {}, spec["model"]
    by_rule = spec.get("normalizer") is None and rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space") and not model.get("dropout")
    values = {c: b for b, c in byte_characters().items()}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    across = re.compile(r"\S ")
    if not by_rule or any(across.search(bytes(values[c] for c in token).decode("utf-8", "replace")) for token in model["vocab"] if token not in special):
        return False
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(b, "rb") as file:
        proto.ParseFromString(file.read())
    norm, trained = proto.normalizer_spec, proto.trainer_spec
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not trained.treat_whitespace_as_suffix
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    return plain and trained.model_type == trained.BPE and not any(p.type == kinds.USER_DEFINED or p.type == kinds.NORMAL and _SPACE in p.piece.lstrip(_SPACE) for p in proto.pieces)


def segments(text: str) -> list[str]:
    """A text's segments, each without the space that begins it."""
    parts = text.split(" ")
    if not (text.startswith(" ") or text.endswith(" ") or "  " in text or _ODD.search(text)):
        return parts
    out, open_ = [], False
    for part in parts:
        if open_:
            out[-1] += " " + part
        else:
            out.append(part)
        open_ = not out[-1] or out[-1][-1].isspace()
    if len(out) > 1 and not out[-1]:  # a last single space stays with its word: B can't encode it alone
        out[-2:] = [out[-2] + " "]
    return out


def packed(data: bytes) -> bytes:
    """Compressed bytes, with their length in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _numbers_as_text(values: np.ndarray, after: np.ndarray) -> bytes:
    """Decimals of the values, each followed by a byte of `after`."""
    digits = 1 + sum((values >= 10**k).astype(np.int64) for k in range(1, 10))
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = after
    for k in range(int(digits.max(initial=0))):
        has = digits > k
        out[ends[has] - 2 - k] = 48 + values[has] // 10**k % 10
    return out.tobytes()


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), _piece_model(b)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        values = {c: v for v, c in byte_characters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(values.get(c, 0) for c in token)
        ids, piece = range(self.b.vocab_size()), self.b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace(_SPACE, " ").encode() for i in ids]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes))

    def encode(self, part: str) -> tuple[list[int], list[int]]:
        return self.a.encode(" " + part, add_special_tokens=False).ids, self.b.encode(part, num_threads=1)

    def groups(self, parts: list[str]) -> list[bytes] | None:
        """The groups of segments that are encoded as one text, as text each; None if the tokens don't give back its bytes."""
        text = " ".join(parts)
        in_a, in_b = self.encode(text)
        whole = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, in_a)) != whole or b"".join(map(self.b_bytes.__getitem__, in_b)) != whole:
            return None
        a, b = np.array(in_a, np.int64), np.array(in_b, np.int64)
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.intersect1d(ends_a, ends_b)
        of_a, of_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        side = np.r_[2 * of_a, 2 * of_b + 1]
        order = np.argsort(side, kind="stable")
        values, side = np.r_[a, b][order], side[order]
        after = np.full(len(values), ord(","), np.uint8)
        last = np.r_[side[1:] != side[:-1], True]
        after[last] = np.where(side[last] % 2, ord(";"), ord("|"))
        sizes = np.array([1 + len(p.encode()) for p in parts])
        segment_ends = np.searchsorted(ends, np.cumsum(sizes))  # of each segment its last group
        after[np.searchsorted(side, 2 * segment_ends + 1, "right") - 1] = ord("\n")
        return _numbers_as_text(values, after).split(b"\n")[:-1]

    def align(self, parts: list[str]) -> list[bytes]:
        """The groups of distinct segments as text; empty where the tokens don't give back a segment's bytes."""
        out: list[bytes] = [b""] * len(parts)
        joined = [i for i, p in enumerate(parts) if p and not p[-1].isspace()]  # what follows the others isn't a cut
        alone = sorted(set(range(len(parts))) - set(joined))
        for at in range(0, len(joined), _AT_ONCE):
            some = joined[at : at + _AT_ONCE]
            found = self.groups([parts[i] for i in some])
            if found is None:
                alone += some
            else:
                for i, x in zip(some, found, strict=True):
                    out[i] = x
        for i in alone:
            out[i] = (self.groups([parts[i]]) or [b""])[0]
        return out

    def align_whole(self, parts: list[str]) -> list[bytes]:
        """The same, each segment encoded for itself."""
        return [(self.groups([p]) or [b""])[0] for p in parts]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """The worker's tokenizers, loaded once."""
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


class _Numbers(dict):
    """Numbers of segments in the order they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = out = len(self)
        return out


#: Rows of documents have the numbers of their segments; rows of ranges have numbers and segments of a block.
_CUT = pa.schema([("block", pa.int64()), ("id", pa.int64()), ("range", pa.int64()), ("numbers", pa.binary()), ("segments", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch], block_bytes: int, ranges: int, cut: bool) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 40
    known, size = _Numbers(), 0
    docs: list[dict] = []

    def written() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(docs, _CUT)

    def dealt() -> Iterator[pa.RecordBatch]:
        """The block's segments by range."""
        names = [x.encode() for x in known]
        dealt_to = np.array([zlib.crc32(x) for x in names], np.int64) * ranges >> 32
        order = np.argsort(dealt_to, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(dealt_to[order]) != 0, True]) if len(order) else [0]
        rows = []
        for at, to in zip(edges[:-1], edges[1:], strict=True):
            own = order[at:to]
            some = [names[i] for i in own.tolist()]
            data = np.array([len(x) for x in some], np.uint32).tobytes() + b"".join(some)
            rows.append({"block": block, "range": int(dealt_to[own[0]]), "numbers": own.astype(np.uint32).tobytes(), "segments": packed(data)})
            if len(rows) == 1000:
                yield pa.RecordBatch.from_pylist(rows, _CUT)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, _CUT)

    for batch in batches:
        for id_, value in zip(batch.column(0).cast(pa.int64()), batch.column(1), strict=True):
            text = value.as_py() or ""
            if size and size + len(text) > block_bytes:
                yield written()
                yield from dealt()
                known, size, docs, block = _Numbers(), 0, [], block + 1
            size += len(text)
            numbers = np.fromiter(map(known.__getitem__, (segments(text) if cut else [text]) if text else []), np.uint32)
            planes = numbers.view(np.uint8).reshape(-1, 4).T  # low bytes first, then the others, which are alike
            docs.append({"block": block, "id": id_.as_py(), "numbers": packed(planes.tobytes())})
        yield written()
        docs = []
    yield from dealt()


_GROUPS = pa.schema([("block", pa.int64()), ("numbers", pa.binary()), ("groups", pa.binary())])


def _align(batches: Iterator[pa.RecordBatch], a: str, b: str, cut: bool) -> Iterator[pa.RecordBatch]:
    """For each block that has segments of one range, their numbers and groups."""
    known, held = _Numbers(), []
    for batch in batches:
        for block, numbers, data in zip(*[batch.column(batch.schema.get_field_index(n)) for n in ("block", "numbers", "segments")], strict=True):
            numbers, data = numbers.as_py(), unpacked(data.as_py())
            sizes = np.frombuffer(data, np.uint32, len(numbers) // 4).tolist()
            at, own = 4 * len(sizes), []
            for n in sizes:
                own.append(known[data[at : at + n]])
                at += n
            held.append((block.as_py(), numbers, own))
    own = aligner(a, b)
    groups = (own.align if cut else own.align_whole)([x.decode() for x in known])
    for at in range(0, len(held), 1000):
        some = held[at : at + 1000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in some], pa.int64()), pa.array([n for _, n, _ in some], pa.binary()), pa.array([packed(b"\n".join(map(groups.__getitem__, i)) + b"\n") for _, _, i in some], pa.binary())], schema=_GROUPS)


class _Dictionary:
    """What a block's segments hold: by number their groups as text, sizes, and the pairs that they link."""

    def __init__(self, rows: pa.Table):
        numbers = np.frombuffer(b"".join(rows.column("numbers").to_pylist()), np.uint32).astype(np.int64)
        data = b"".join(unpacked(x.as_py()) for x in rows.column("groups"))
        own = data.split(b"\n")
        self.texts = [b""] * len(numbers)
        for n, text in zip(numbers.tolist(), own, strict=False):
            self.texts[n] = text
        signs = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero((signs < 48) | (signs > 57))
        sign, starts = signs[ends], np.r_[0, ends[:-1] + 1]
        segment_of = np.cumsum(sign == 10) - (sign == 10)
        real = ends > starts  # else the end of an empty segment
        ends, sign, starts, segment_of = ends[real], sign[real], starts[real], segment_of[real]
        values = np.zeros(len(ends), np.int64)
        for k in range(int((ends - starts).max(initial=0))):
            has = ends - starts > k
            values[has] += (signs[ends[has] - 1 - k] - np.int64(48)) * 10**k
        closes = (sign == ord(";")) | (sign == 10)
        group = np.cumsum(closes) - closes
        n_groups = int(closes.sum())
        bars = np.cumsum(sign == ord("|"))
        in_b = bars - (sign == ord("|")) > group  # a group's bar comes before its tokens of B
        a, b = np.flatnonzero(~in_b), np.flatnonzero(in_b)
        in_group = np.bincount(group[b], minlength=n_groups)
        first_b = np.cumsum(in_group) - in_group
        n = in_group[group[a]]  # each token of A meets the tokens of B in its group
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        keys = np.repeat(values[a] << 32, n) | values[b][np.repeat(first_b[group[a]], n) + at]
        of = np.repeat(numbers[segment_of[a]], n)
        self.keys, pair = np.unique(keys, return_inverse=True)
        width = max(1, len(self.keys))
        each, self.times = np.unique(of * width + pair, return_counts=True)  # by segment, then pair
        self.pairs, of = each % width, each // width
        count = lambda x, weights=None: np.bincount(x, weights, minlength=len(numbers)).astype(np.int64)
        self.size = count(of)
        self.first = np.cumsum(self.size) - self.size
        of_token = numbers[segment_of]
        self.sums = np.stack([count(of_token[a]), count(of_token[b]), count(of_token[closes]), count(of, self.times)], 1)
        self.sound = self.sums[:, 0] > 0

    def linked(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that a document links, ascending, and how often."""
        own, times = np.unique(numbers, return_counts=True)
        n = self.size[own]
        at = np.arange(n.sum()) + np.repeat(self.first[own] - np.cumsum(n) + n, n)
        pairs, weights = self.pairs[at], self.times[at] * np.repeat(times, n)
        order = np.argsort(pairs, kind="stable")
        pairs, weights = pairs[order], weights[order]
        begin = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        return pairs[begin], np.add.reduceat(weights, begin)


_TOTALS = ("n_a", "n_b", "n_groups", "n_links")
#: Rows of documents have totals and the pairs they link; rows of pairs have a place, and the documents of the block that hold it.
_COMPOSED = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in _TOTALS], ("groups_sha256", pa.string()), ("links", pa.binary()), ("place", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("docs", pa.int64())])


def _compose(docs: pa.Table, known: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return _COMPOSED.empty_table()
    dictionary = _Dictionary(known) if known.num_rows else None  # None: all texts of the block are empty
    totals, digests, links = np.zeros((docs.num_rows, len(_TOTALS)), np.int64), [""] * docs.num_rows, [b""] * docs.num_rows
    held = np.zeros(len(dictionary.keys) if dictionary else 0, np.int64)
    for i, data in enumerate(docs.column("numbers")):
        planes = np.frombuffer(unpacked(data.as_py()), np.uint8)
        if not len(planes):
            continue
        numbers = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
        if not dictionary.sound[numbers].all():
            continue
        totals[i] = dictionary.sums[numbers].sum(0)
        digests[i] = hashlib.sha256(b";".join(map(dictionary.texts.__getitem__, numbers.tolist()))).hexdigest()
        pairs, times = dictionary.linked(numbers)
        held[pairs] += 1
        links[i] = packed(np.diff(pairs, prepend=0).astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() + times.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())
    block = docs.column("block")[0].as_py()
    rows = pa.table({"block": docs.column("block"), "doc_id": docs.column("id"), **{n: totals[:, k] for k, n in enumerate(_TOTALS)}, "groups_sha256": pa.array(digests, pa.string()), "links": pa.array(links, pa.binary()), **{n: pa.nulls(docs.num_rows, pa.int64()) for n in ("place", "a", "b", "docs")}}, _COMPOSED)
    met = np.flatnonzero(held)
    pairs = {"block": np.full(len(met), block), "place": met, "a": dictionary.keys[met] >> 32, "b": dictionary.keys[met] & 0xFFFFFFFF, "docs": held[met]} if len(met) else None
    if pairs is None:
        return rows
    return pa.concat_tables([rows, pa.table({f.name: pairs[f.name] if f.name in pairs else pa.nulls(len(met), f.type) for f in _COMPOSED}, _COMPOSED)])


_RANKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _rank(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Documents of a block with the sums of their links' counts."""
    top = int(pairs.column("at").to_numpy().max()) + 1 if pairs.num_rows else 0
    counts, best = np.zeros(top, np.int64), np.zeros(top, bool)
    if top:
        place = pairs.column("at").to_numpy()
        counts[place], best[place] = pairs.column("docs").to_numpy(), pairs.column("best").to_numpy()
    sums = np.zeros((docs.num_rows, 2), np.int64)
    for i, data in enumerate(docs.column("links") if docs.num_rows else ()):
        if data := data.as_py():
            planes = np.frombuffer(unpacked(data), np.uint8)
            n = len(planes) // 12
            own = np.cumsum(np.ascontiguousarray(planes[: 4 * n].reshape(4, n).T).view(np.uint32).ravel().astype(np.int64))
            times = np.ascontiguousarray(planes[4 * n :].reshape(8, n).T).view(np.int64).ravel()
            sums[i] = times[best[own]].sum(), (times * counts[own]).sum()
    names = [c.split()[0] for c in _RANKED.split(", ")]
    columns = {"n_best": pa.array(sums[:, 0]), "count_sum": pa.array(sums[:, 1])} if docs.num_rows else {n: pa.array([], pa.string() if n == "groups_sha256" else pa.int64()) for n in names}
    return pa.table([columns[n] if n in columns else docs.column(n) for n in names], names)


def align(docs: DataFrame, *, a: str | None = None, b: str | None = None, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for every document: its tokens, groups and links, and how they stand in the corpus.

    a, b: the tokenizers' files, at these paths on every machine; by default the public ones. n_best counts links whose
    pair of ids is in as many documents as any pair of its A id, count_sum adds the number of these documents up over links.
    """
    a, b = a or public_path(), b or public_path("piece_bpe_32k.model")
    cut, spark = cuts_hold(a, b), docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RANGE_BYTES))
    taken = stored(rows.mapInArrow(lambda batches: _cut(batches, block_bytes, ranges, cut), from_arrow_schema(_CUT)), "cut-documents")
    texts, dealt = taken.where("range is null").select("block", "id", "numbers"), taken.where("range is not null").select("range", "block", "numbers", "segments")

    def of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _align(batches, a, b, cut)

    groups = dealt.groupBy("range").applyInArrow(of_range, from_arrow_schema(_GROUPS))
    composed = stored(texts.groupBy("block").cogroup(groups.groupBy("block")).applyInArrow(_compose, from_arrow_schema(_COMPOSED)), "composed-documents")

    pairs = composed.where("place is not null").select("block", "place", "a", "b", "docs")
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "pair-counts")
    highest = stored(counts.groupBy("a").agg(F.max("docs").alias("highest")), "highest-counts")
    ranked = stored(counts.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best")), "ranked-pairs")
    standing = pairs.drop("docs").join(ranked, ["a", "b"]).select(F.col("block").alias("of_block"), F.col("place").alias("at"), "docs", "best")
    done = composed.where("place is null").select("block", "doc_id", *_TOTALS, "groups_sha256", "links")
    return done.groupBy("block").cogroup(standing.groupBy("of_block")).applyInArrow(_rank, _RANKED)


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
