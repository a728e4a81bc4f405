"""Byte-level BPE: encoding by contiguous rank arrays, many short words at a time, and decoding.

A word is held as a row of parts and a row of the ranks of adjacent parts. Each round finds the
smallest rank of every row, deletes that boundary, and looks up the two ranks beside it, for all rows that still
have a rank; finished rows leave. What was encoded is kept in bounded memos, once per worker.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from cantogram.llm.workers import kept_with

#: Entries and bytes of a worker's memo of chunks; a full one keeps the half used last. Its memo of words has half
#: as many entries and is emptied when full. The results don't depend on them.
MEMO, MEMO_BYTES = 500_000, 64_000_000
#: Longer words are merged one by one, all places of the smallest rank at once.
SHORT = 48
#: Rows of words that are merged together.
BLOCK = 4_000
# The split before the merges that the vocabulary was made for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_NONE = np.int32(np.iinfo(np.int32).max)
#: Kinds of bytes: other, letter or digit, part of a longer character, white space, control character that some take for it.
OTHER, WORD, WIDE, BLANK, UNSURE = range(5)
KINDS = bytes(WIDE if b >= 128 else WORD if chr(b).isalnum() else BLANK if b in b" \t\n\v\f\r" else UNSURE if 0x1C <= b <= 0x1F else OTHER for b in range(256))
#: White space beyond ASCII, and what resembles it, as numbers of UTF-8 bytes; and their first bytes.
WHITE = [int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
LEADS = [0xC2, 0xE1, 0xE2, 0xE3, 0xEF]
#: Bytes of text that are encoded at once, or one row.
PIECE = 4_000_000
Batches = Iterator[pa.RecordBatch]


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, as character to byte.

    Printable Latin-1 bytes stand for themselves, the others in turn for the characters from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _offsets(values: pa.Array) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]


class Chunks:
    """Splits texts into chunks that no word crosses and keeps chunks' ids.

    ``encode`` gives the ids (4 bytes each, little-endian) of each of some strings that need no context. Boundaries are
    found in the bytes of many texts at once, and equal chunks are numbered, so that Python only sees distinct ones.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], added: dict[str, int]):
        self.encode = encode
        marks = {k.encode(): np.array([v], dtype="<u4").tobytes() for k, v in added.items()}
        self.marks = re.compile(b"|".join(map(re.escape, sorted(marks, key=len, reverse=True)))) if added else None
        # Arrow arrays hold a chunk in a tenth of the memory of Python objects, and are looked up without them.
        self.known, self.values = pa.array(list(marks), pa.large_binary()), pa.array(list(marks.values()), pa.large_binary())
        self.used, self.turn = np.full(len(marks), np.iinfo(np.int64).max), 0

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where a chunk starts: a text, white space after another character, what follows a single line feed, and a
        full stop or comma between an ASCII letter or digit and another start. ``bounds``: texts' starts, and the end."""
        kind = np.frombuffer(data.tobytes().translate(KINDS), dtype=np.uint8)
        plain = kind < BLANK
        start = np.zeros(len(data) + 1, dtype=bool)
        start[1:-1] = (kind[1:] == BLANK) & plain[:-1]
        if (after := np.flatnonzero(start[1:-1] & (kind[:-1] == WIDE)) + 1).size:
            last = [data[np.maximum(after - k, 0)].astype(np.int32) << 8 * (k - 1) for k in (1, 2, 3)]
            start[after[np.isin(last[0] | last[1], WHITE) | np.isin(last[0] | last[1] | last[2], WHITE)]] = False
        feeds = np.flatnonzero((data[:-1] == 10) & start[:-2]) + 1
        start[feeds[plain[feeds] & ~np.isin(data[feeds], LEADS)]] = True
        start[bounds] = True
        stops = np.flatnonzero((data == 46) | (data == 44))
        stops = stops[start[stops + 1] & ~start[stops]]
        start[stops[kind[stops - 1] == WORD]] = True
        return start

    def _codes(self, chunks: pa.Array) -> np.ndarray:
        """Distinct chunks' places in the memo, which learns those that it lacks."""
        self.turn += 1
        codes = pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy().copy()
        old, lacking = codes[codes >= 0], np.flatnonzero(codes < 0)
        self.used[old] = np.maximum(self.used[old], self.turn)
        if not len(lacking):
            return codes
        if len(self.known) + len(lacking) > MEMO or self.known.nbytes + self.values.nbytes > MEMO_BYTES:
            stay = self._lasting()
            place = np.zeros(len(self.used), dtype=codes.dtype)
            place[stay] = np.arange(len(stay))
            codes = place[codes]
            self.known, self.values, self.used = self.known.take(pa.array(stay)), self.values.take(pa.array(stay)), self.used[stay]
        codes[lacking] = len(self.known) + np.arange(len(lacking))
        new = chunks.take(pa.array(lacking))
        self.values = pa.concat_arrays([self.values, pa.array(self._learnt(new.cast(pa.large_string()).to_pylist()), pa.large_binary())])
        self.known = pa.concat_arrays([self.known, new])
        self.used = np.concatenate([self.used, np.full(len(new), self.turn)])
        return codes

    def _lasting(self) -> np.ndarray:
        """Places of a full memo that stay: what is used now, and of the rest what was used last, up to half the limits."""
        order = np.argsort(-self.used, kind="stable")
        size = np.cumsum((np.diff(_offsets(self.known)) + np.diff(_offsets(self.values)))[order] + 16)
        recent = (np.arange(len(order)) < MEMO // 2) & (size <= MEMO_BYTES // 2)
        return np.sort(order[recent | (self.used[order] >= self.turn)])

    def _learnt(self, new: list[str]) -> list[bytes]:
        """A letter ends its word before a full stop or comma, so the part before it is encoded by itself."""
        ends = {c for c in new if c[-1] in ".," and len(c) > 1 and c[-2].isalpha()}
        if not ends:
            return self.encode(new)
        plain = list(dict.fromkeys(x for c in new for x in ([c[:-1], c[-1]] if c in ends else [c])))
        ids = dict(zip(plain, self.encode(plain), strict=True))
        return [ids[c[:-1]] + ids[c[-1]] if c in ends else ids[c] for c in new]

    def _marked(self, data: bytes, bounds: np.ndarray) -> tuple[list[int], list[int]]:
        """The places of added tokens, as starts and ends."""
        edges = bounds.tolist()
        found = [m.span() for m in self.marks.finditer(data)]
        # A match that runs over the end of a text is none, but may hide one behind its start.
        if any(edges[bisect.bisect_right(edges, a)] < b for a, b in found):
            found = [(a + m.start(), a + m.end()) for a, b in itertools.pairwise(edges) for m in self.marks.finditer(data[a:b])]
        return [a for a, _ in found], [b for _, b in found]

    def flat(self, texts: pa.Array) -> tuple[bytes, list[int]]:
        """The ids of all of some texts (no nulls), one after the other, and where each text's begin, with the end, in bytes."""
        texts = texts.cast(pa.large_binary())
        offsets = _offsets(texts)
        first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        if not size:
            return b"", [0] * (len(texts) + 1)
        held, bounds = texts.buffers()[2].slice(first, size), offsets - first
        data = np.frombuffer(held, dtype=np.uint8)
        heads, tails = self._marked(memoryview(held), bounds) if self.marks else ([], [])
        start = self._starts(data, np.unique(np.concatenate([bounds, np.array(heads + tails, dtype=np.int64)])))
        for a, b in zip(heads, tails, strict=True):
            start[a + 1 : b] = False
        places = np.flatnonzero(start)
        parts = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), held]).dictionary_encode()
        codes = self._codes(parts.dictionary)
        ids = self.values.take(pa.array(codes)).take(parts.indices)
        ends = _offsets(ids)
        at = ends[np.searchsorted(places, bounds)]
        return ids.buffers()[2].slice(0, int(ends[-1])).to_pybytes(), at.tolist()

    def ids(self, texts: list[str]) -> list[bytes]:
        flat, at = self.flat(pa.array(texts, pa.large_string()))
        return [flat[a:b] for a, b in itertools.pairwise(at)]


class RankBpe:
    """A byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, code = spec["model"], printable_bytes()
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {i: bytes(code[c] for c in token) for token, i in vocab.items() if token not in self.added}
        raw |= {i: token.encode() for token, i in self.added.items()}
        self.bytes_of = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.byte_id = np.zeros(256, dtype=np.int32)
        for char, byte in code.items():
            self.byte_id[byte] = vocab[char]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        order = np.argsort((left << 32) | right, kind="stable")
        self.keys = ((left << 32) | right)[order]
        self.rank_at = order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        a, b = np.meshgrid(self.byte_id, self.byte_id, indexing="ij")
        self.byte_ranks = self._ranks(a.ravel(), b.ravel()).reshape(256, 256)
        self.split = regex.compile(SPLIT)
        self.words: dict[str, bytes] = {}
        self.chunks = Chunks(self.encode_strings, self.added)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_at[at], _NONE)

    def _block(self, words: list[bytes]) -> list[bytes]:
        """Words of SHORT bytes at most."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width)
        parts = self.byte_id[raw]
        # Place i of a rank row belongs to parts i and i + 1; the last place stays empty.
        ranks = np.full((len(words), width), _NONE, dtype=np.int32)
        ranks[:, :-1] = self.byte_ranks[raw[:, :-1], raw[:, 1:]]
        ranks[np.arange(width)[None, :] >= lengths[:, None] - 1] = _NONE
        done, count, active = np.zeros((len(words), width), dtype="<u4"), lengths.copy(), np.arange(len(words))
        length = lengths
        while len(active):
            rows = np.arange(len(active))
            least = ranks.argmin(axis=1)
            rank = ranks[rows, least]
            over = rank == _NONE
            if over.any():
                done[active[over], : parts.shape[1]] = parts[over]
                count[active[over]] = length[over]
                stay = np.flatnonzero(~over)
                active, parts, ranks, least, rank, length = active[stay], parts[stay], ranks[stay], least[stay], rank[stay], length[stay]
                rows = np.arange(len(active))
            if not len(active):
                break
            # Every row left loses one boundary, so both arrays lose one column.
            parts[rows, least] = self.merged[rank]
            columns = np.arange(parts.shape[1] - 1)[None, :]
            at = least[:, None]
            parts = np.where(columns > at, parts[:, 1:], parts[:, :-1])
            ranks = np.where(columns >= at, ranks[:, 1:], ranks[:, :-1])
            length = length - 1
            for place, there in ((least - 1, least > 0), (least, least < length - 1)):
                r, c = rows[there], place[there]
                ranks[r, c] = self._ranks(parts[r, c], parts[r, c + 1])
        flat = done.tobytes()
        step = 4 * width
        return [flat[i * step : i * step + 4 * n] for i, n in enumerate(count.tolist())]

    def _long(self, word: bytes) -> bytes:
        parts = self.byte_id[np.frombuffer(word, dtype=np.uint8)]
        ranks = self._ranks(parts[:-1], parts[1:])
        while len(ranks) and (least := ranks.min()) != _NONE:
            at = np.flatnonzero(ranks == least)
            # Of overlapping places the first, third, ... of each run are merged.
            run = np.cumsum(np.concatenate([[True], np.diff(at) != 1]))
            place = np.arange(len(at)) - np.searchsorted(run, run)
            at = at[place % 2 == 0]
            parts[at] = self.merged[least]
            parts = np.delete(parts, at + 1)
            ranks = self._ranks(parts[:-1], parts[1:])
        return parts.astype("<u4").tobytes()

    def _merge(self, words: list[bytes]) -> list[bytes]:
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        cut = next((k for k, i in enumerate(order) if len(words[i]) > SHORT), len(order))
        for k in range(0, cut, BLOCK):
            block = order[k : min(k + BLOCK, cut)]
            for i, ids in zip(block, self._block([words[i] for i in block]), strict=True):
                out[i] = ids
        for i in order[cut:]:
            out[i] = self._long(words[i])
        return out

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        """Letters, with or without a space before them, are one word; other strings are split first."""
        single = [s.isalpha() or (s[:1] == " " and s[1:].isalpha()) for s in strings]
        found = iter(self._merge([s.encode() for s, one in zip(strings, single, strict=True) if one]))
        split = [self.split.findall(s) for s, one in zip(strings, single, strict=True) if not one]
        new = list({w for words in split for w in words}.difference(self.words))
        if len(self.words) + len(new) > MEMO // 2:
            self.words.clear()
            new = list({w for words in split for w in words})
        self.words.update(zip(new, self._merge([w.encode() for w in new]), strict=True))
        get, rest = self.words.__getitem__, iter(split)
        return [next(found) if one else b"".join(map(get, next(rest))) for one in single]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.chunks.ids(texts)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about PIECE bytes of text at most, or of one row; what Arrow held for one goes back before the next."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = (np.cumsum(sizes) - sizes) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(cuts):
        if b > a:
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file (a few MB, whatever the data) for every worker."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _coded(held: Broadcast, texts: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        bpe = kept_with(held, RankBpe)
        for batch in batches:
            for part in pieces(batch):
                flat, at = bpe.chunks.flat(part.column("text").fill_null(""))
                ids = [flat[a:b] for a, b in itertools.pairwise(at)]
                decoded = [bpe.decode(x) for x in ids]
                columns = [c for c in part.schema.names if c != "text"]
                result = [part.column(c) for c in columns] + [
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                ]
                names = [*columns, "n_tokens", "ids_sha256", "decoded_sha256"]
                if texts:
                    lists = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids]
                    result += [pa.array(lists, pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.record_batch(result, names=names)

    return run


def encode_decode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", outputs: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for each row of ``docs``.

    Ids are those of the vocabulary's own library without added tokens; a special token that stands in a text is
    one id. A null text is empty and has no ids. Rows stand for themselves: repeated rows give
    repeated results, null ids stay null. Other columns are ignored; an empty table gives an empty result.
    """
    held = vocabulary(docs.sparkSession, vocabulary_path)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if outputs else "")
    return source.mapInArrow(_coded(held, outputs), schema)
