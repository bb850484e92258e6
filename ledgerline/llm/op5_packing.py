"""Packing documents into fixed-length token sequences.

Method: first-fit decreasing with a tournament tree over bin capacities, run independently in
randomised groups of documents. Tokens are counted once and only (document, start, length,
crc32) pieces travel; no group holds more than about ``GROUP_DOCS`` documents on average, so
the packing of one task is bounded whatever the size of the corpus.

Pieces: a document's ids are cut at multiples of ``SEQ_LEN``; the full pieces fill a sequence
each, the rests are packed by first-fit decreasing. Then the emptiest bins of a group are
dissolved: their pieces are cut freely into the room left in the fuller bins, so padding is
left in at most one sequence per group. Because cuts are only known after packing, the crc32
of every piece is derived from prefix checksums taken at ``GRAIN`` ids, and cuts fall on
multiples of ``GRAIN`` inside a document.

Defined results: a null text counts as empty and gives one piece holding only the closing id;
repeated rows are packed each on their own; null ids are kept; an empty table gives an empty
result; extra input columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, require

SEQ_LEN = 2048
#: Fixed value: the id that closes a document.
CLOSING_ID = 1
#: Cuts of a rest fall on multiples of this many ids.
GRAIN = 16
#: Documents per randomised group, on average.
GROUP_DOCS = 2048
#: Entries of a Python worker's table from white-space-delimited chunk to packed ids.
CACHE_ENTRIES = 500_000

#: Entries of a Python worker's table from word to packed ids.
WORD_ENTRIES = 250_000
#: Fresh words encoded as one text, apart by a character that is an id of its own.
JOINED = 64
SEPARATOR = "\0"
#: Signs that end a word where the tokenizer splits letters from signs.
END_SIGNS = b".,;:!?*&"
#: The normalizers and the split under which an ASCII word may be lower-cased and parted from its end signs.
LOWERED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PARTED = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
          "behavior": "Removed", "invert": True}
#: The step after that split which leaves ASCII letters as they are, and what it makes of ``SEPARATOR``.
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
BARE_SEPARATOR = "\u0100"

_TOKENIZERS: dict[str, WordEncoder] = {}
_CHUNKS: dict[str, dict[bytes, bytes]] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Packed ids of words (text without ASCII white space), many to a call of the tokenizer.

    A call costs more than a word, so fresh words are joined around ``SEPARATOR`` and their ids cut at its id; a text
    whose separators do not all come back is encoded word by word. Where the tokenizer's file says that it lower-cases
    and splits letters from signs, ``Word.`` and ``word,`` share the ids of ``word``. Lower-case ASCII letters pass
    those steps as they are, so such words go to the same model without them.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        normalizer, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        self.parted = (normalizer.get("normalizers") == LOWERED and split.get("pretokenizers", [None])[0] == PARTED
                       and all(not t["content"][-1:].isalnum() for t in spec.get("added_tokens") or []))
        self.sep = self._only_id(self.tok, SEPARATOR)
        self.bare = None
        after = split.get("pretokenizers", [])[1:]
        if self.parted and len(after) == 1 and {k: after[0].get(k) for k in BYTES} == BYTES:
            self.bare = Tokenizer.from_str(json.dumps(
                {**spec, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [], "post_processor": None}))
            self.bare_sep = self._only_id(self.bare, BARE_SEPARATOR)
        self.words: dict[bytes, bytes] = {}

    @staticmethod
    def _only_id(tok, text: str) -> int | None:
        ids = tok.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return ids[0] if len(ids) == 1 else None

    def _joined(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of every word, from one call for ``JOINED`` of them."""
        if self.bare is None:
            return self._cut(words, self.tok, SEPARATOR, self.sep)
        letters = [w for w in words if w.isalpha() and w.islower()]  # of bytes: ASCII alone
        other = [w for w in words if not (w.isalpha() and w.islower())]
        ids = dict(zip(letters, self._cut(letters, self.bare, BARE_SEPARATOR, self.bare_sep)))
        ids.update(zip(other, self._cut(other, self.tok, SEPARATOR, self.sep)))
        return [ids[w] for w in words]

    def _cut(self, words: list[bytes], tok, separator: str, sep: int | None) -> list[bytes]:
        out: list[bytes] = []
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        between = f" {separator} ".encode()
        texts = [between.join(g).decode("utf-8") for g in groups] if sep is not None else []
        for g, e in zip(groups, tok.encode_batch_fast(texts, add_special_tokens=False) if texts else [None] * len(groups)):
            if e is not None:
                ids = np.array(e.ids, dtype="<u4")
                cuts = (4 * np.flatnonzero(ids == sep)).tolist()
                if len(cuts) == len(g) - 1:
                    packed = ids.tobytes()
                    out += [packed[i:j] for i, j in zip([0, *[c + 4 for c in cuts]], [*cuts, len(packed)])]
                    continue
            for each in self.tok.encode_batch_fast([w.decode("utf-8") for w in g], add_special_tokens=False):
                out.append(struct.pack(f"<{len(each.ids)}I", *each.ids))
        return out

    def _plain(self, words: list[bytes]) -> dict[bytes, bytes]:
        known = self.words
        fresh = [w for w in words if w not in known]
        new: dict[bytes, bytes] = {}
        for at in range(0, len(fresh), 4096):
            new.update(zip(fresh[at:at + 4096], self._joined(fresh[at:at + 4096])))
        out = {w: new[w] if w in new else known[w] for w in words}
        if len(known) < WORD_ENTRIES:
            known.update((w, ids) for w, ids in new.items() if len(w) <= 64)
        return out

    def encode(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct chunks."""
        if not self.parted:
            out: dict[bytes, bytes] = {}
            for at in range(0, len(chunks), 4096):
                out.update(zip(chunks[at:at + 4096], self._joined(chunks[at:at + 4096])))
            return out
        parts = []
        for chunk in chunks:
            word = chunk.rstrip(END_SIGNS)
            # Signs before the end signs belong to the same run, so the word has to end in a letter or digit.
            if not word[-1:].isalnum():
                word = chunk
            parts.append((word.lower() if word.isascii() and b"<|" not in word else word, chunk[len(word):]))
        ids = self._plain(list({p for pair in parts for p in pair if p}))
        ids[b""] = b""
        return {chunk: ids[word] + ids[end] for chunk, (word, end) in zip(chunks, parts)}


def encode_texts(texts: list[str | None], path: str) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of every text, without special tokens.

    The tokenizer drops ASCII white space and never looks across it, so ids are looked up by
    white-space-delimited chunk; chunks not met before are encoded together. The table
    stops growing at ``CACHE_ENTRIES``; chunks beyond are encoded again where they occur.
    """
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
        _CHUNKS[path] = {}
    encoder, known = _TOKENIZERS[path], _CHUNKS[path]
    split = [t.encode("utf-8").split() if t else [] for t in texts]
    found = [list(map(known.get, chunks)) for chunks in split]
    short = [i for i, ids in enumerate(found) if None in ids]
    if short:
        extra = encoder.encode(list({c for i in short for c, ids in zip(split[i], found[i]) if ids is None}))
        for i in short:
            found[i] = [extra[c] if ids is None else ids for c, ids in zip(split[i], found[i])]
        if len(known) < CACHE_ENTRIES:
            known.update((c, ids) for c, ids in extra.items() if len(c) <= 64)
    return list(map(b"".join, found))


def grain_crcs(ids: bytes, grain: int) -> list[int]:
    """crc32 of every run of ``grain`` ids (the last may be shorter), as signed 32-bit numbers."""
    step = 4 * grain
    crcs = [zlib.crc32(ids[i:i + step]) for i in range(0, len(ids), step)]
    return [c - (1 << 32) if c >> 31 else c for c in crcs]


def _gf2_times(mat: list[int], vec: int) -> int:
    total, i = 0, 0
    while vec:
        if vec & 1:
            total ^= mat[i]
        vec >>= 1
        i += 1
    return total


class CrcJoin:
    """crc32 of a concatenation from the parts' checksums and the second part's length.

    crc32 is linear over GF(2): appending n zero bytes is a 32 x 32 bit matrix, built by
    squaring the one-byte matrix and kept per length.
    """

    def __init__(self) -> None:
        one_bit = [0xEDB88320] + [1 << i for i in range(31)]  # fixed value: the polynomial of crc32
        mat = one_bit
        for _ in range(3):
            mat = self._square(mat)
        self.powers = [mat]  # powers[k]: 2**k zero bytes
        self.by_length: dict[int, list[int]] = {}

    @staticmethod
    def _square(mat: list[int]) -> list[int]:
        return [_gf2_times(mat, row) for row in mat]

    def _matrix(self, n: int) -> list[int]:
        if n not in self.by_length:
            out, k, m = [1 << i for i in range(32)], 0, n
            while m:
                if len(self.powers) <= k:
                    self.powers.append(self._square(self.powers[-1]))
                if m & 1:
                    out = [_gf2_times(self.powers[k], row) for row in out]
                m >>= 1
                k += 1
            self.by_length[n] = out
        return self.by_length[n]

    def __call__(self, first: int, second: int, second_bytes: int) -> int:
        return _gf2_times(self._matrix(second_bytes), first) ^ second


def tokenized(docs: DataFrame, text: str, doc_id: str, path: str, seq_len: int, grain: int, seed: int) -> DataFrame:
    """One row per document: id, token count, full pieces' checksums, grain checksums of the rest, a random number.

    The random number deals documents into groups; it is fixed once the table is written.
    """
    schema = "doc_id long, doc_tokens long, full array<long>, rest_crc long, rest array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closing = struct.pack("<I", CLOSING_ID)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 512):
                encoded = encode_texts(texts.slice(at, 512).to_pylist(), path)
                n, full, rest_crc, rest = [], [], [], []
                for e in encoded:
                    e += closing
                    k = len(e) // (4 * seq_len) * 4 * seq_len
                    n.append(len(e) // 4)
                    full.append([zlib.crc32(e[i:i + 4 * seq_len]) for i in range(0, k, 4 * seq_len)])
                    rest_crc.append(zlib.crc32(e[k:]))
                    rest.append(grain_crcs(e[k:], grain))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 512).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())),
                     pa.array(rest_crc, pa.int64()), pa.array(rest, pa.list_(pa.int32()))],
                    names=["doc_id", "doc_tokens", "full", "rest_crc", "rest"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumn("r", F.rand(seed))


class Tournament:
    """First fit over bin capacities: leaves hold the room of each bin, inner nodes the larger child."""

    def __init__(self, n: int, room: int) -> None:
        self.size = 1
        while self.size < max(1, n):
            self.size *= 2
        self.room = [room] * (2 * self.size)

    def place(self, need: int) -> int:
        """The first bin with room for ``need``; its room shrinks."""
        room, k = self.room, 1
        while k < self.size:
            k *= 2
            if room[k] < need:
                k += 1
        at = k - self.size
        room[k] -= need
        k //= 2
        while k:
            left, right = room[2 * k], room[2 * k + 1]
            top = left if left >= right else right
            if room[k] == top:
                break
            room[k] = top
            k //= 2
        return at


def pack_rests(lengths: list[int], seq_len: int, grain: int) -> list[tuple[int, int, int, int, int]]:
    """First-fit decreasing, then the emptiest bins are cut into the room of the others.

    ``lengths``: pieces shorter than ``seq_len``. Returns (piece, start in it, length, bin, offset).
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    tree = Tournament(len(lengths), seq_len)
    bins: list[list[int]] = []
    for i in order:
        b = tree.place(lengths[i])
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    fill = [sum(lengths[i] for i in b) for b in bins]
    by_fill = sorted(range(len(bins)), key=lambda b: (-fill[b], b))
    # parts: (piece, start, length) in every bin that stays.
    parts = {b: [(i, 0, lengths[i]) for i in bins[b]] for b in by_fill}
    room = {b: seq_len - fill[b] for b in by_fill}
    lo, hi = 0, len(by_fill) - 1
    while lo < hi:
        donor = by_fill[hi]
        i, start, length = parts[donor][-1]
        while lo < hi and room[by_fill[lo]] < min(grain, length):
            lo += 1
        if lo == hi:
            break
        to = by_fill[lo]
        take = length if length <= room[to] else room[to] // grain * grain
        # The moved part is taken from the front, on a multiple of the grain.
        parts[to].append((i, start, take))
        room[to] -= take
        room[donor] += take
        if take == length:
            parts[donor].pop()
            if not parts[donor]:
                hi -= 1
        else:
            parts[donor][-1] = (i, start + take, length - take)
    out, k = [], 0
    for b in by_fill:
        if parts[b]:
            at = 0
            for i, start, length in parts[b]:
                out.append((i, start, length, k, at))
                at += length
            k += 1
    return out


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None,
         seq_len: int = SEQ_LEN, grain: int = GRAIN, group_docs: int = GROUP_DOCS, seed: int = 42) -> DataFrame:
    """Pieces of all documents with their sequence and the offset in it."""
    require(docs, text, doc_id)
    path = tokenizer or default_tokenizer()
    counted = materialize(tokenized(docs, text, doc_id, path, seq_len, grain, seed), "pack-tokens")
    groups = max(1, -(-counted.count() // group_docs))
    dealt = counted.withColumn("g", F.floor(F.col("r") * groups).cast("long")).drop("r")
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

    def run(key, rows):
        g, join = key[0].as_py(), CrcJoin()
        rows = rows.sort_by([("doc_id", "ascending"), ("doc_tokens", "descending")])
        ids, tokens = rows.column("doc_id").to_pylist(), rows.column("doc_tokens").to_pylist()
        full, rest_crc, rest = (rows.column(c).to_pylist() for c in ("full", "rest_crc", "rest"))
        out: list[tuple] = []
        n = 0
        rests = []
        for d, crcs in enumerate(full):
            for k, crc in enumerate(crcs):
                out.append((ids[d], k * seq_len, seq_len, crc, tokens[d], (g << 32) + n, 0))
                n += 1
            if rest[d]:
                rests.append(d)
        lengths = [tokens[d] - len(full[d]) * seq_len for d in rests]
        for i, start, length, b, at in pack_rests(lengths, seq_len, grain):
            d = rests[i]
            if length == lengths[i]:
                out.append((ids[d], len(full[d]) * seq_len, length, rest_crc[d], tokens[d], (g << 32) + n + b, at))
                continue
            crcs = [c & 0xFFFFFFFF for c in rest[d]]
            crcs = crcs[start // grain:-(-(start + length) // grain)]
            crc, left = crcs[0], length - min(grain, length)
            for c in crcs[1:]:
                m = min(grain, left)
                crc = join(crc, c, 4 * m)
                left -= m
            out.append((ids[d], len(full[d]) * seq_len + start, length, crc, tokens[d], (g << 32) + n + b, at))
        cols = list(zip(*out)) if out else [[]] * 7
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(names, cols)})

    return dealt.groupBy("g").applyInArrow(run, schema)
