"""Byte-pair encoding and decoding with the merge table of a tokenizer file.

A text is cut at the file's special tokens, normalised (NFC, white space, lower case), split into words, and each word
is merged: its symbols form a doubly linked list, adjacent pairs wait in a priority queue by merge rank and place, and
an entry whose pair has changed meanwhile is skipped. Decoding looks the ids up and joins their vocabulary strings (by
a space, as the file has no decoder). Merged words are kept in dictionaries of bounded size while a task runs.

The file has to be of this kind: BPE with word ends, byte-level symbols, no decoder. It is sent to the workers once.

* null and empty text: no tokens, the digests of nothing. A word of any length is merged in n log n steps.
* characters that Unicode versions class differently: the splitter of the tokenizers library decides, as the results
  must be the same; words are merged here in every case. Unknown ids decode to nothing.
* repeated rows encode alike. Empty table: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.ship import ship
from stratamart.llm.storage import documents

KEPT_WORDS = 150_000
KEPT_CHUNKS = 100_000
ROWS_AT_ONCE = 200
#: Characters that Python and the tokenizers library class alike, but for the four separators 1C to 1F.
_UNUSUAL = re.compile(r"[\x1c-\x1f]|[^\x00-ԯ‐-‧‰-⁞€™]")
#: The file's pattern, for the usual characters: contractions, letters, one number sign, other signs.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file, given as its text."""

    def __init__(self, file_text: str) -> None:
        self.file_text = file_text
        # what has been merged, in two generations: a full one becomes the old one, what is used again returns
        self._words: dict[str, bytes] = {}
        self._old_words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        self._old_chunks: dict[str, bytes] = {}

    def __reduce__(self):
        return Bpe, (self.file_text,)

    @cached_property
    def _file(self) -> dict:
        return json.loads(self.file_text)

    @cached_property
    def _special(self) -> dict[str, int]:
        return {x["content"]: x["id"] for x in self._file["added_tokens"]}

    @cached_property
    def _cuts(self) -> re.Pattern:
        return re.compile("(" + "|".join(map(re.escape, self._special)) + ")")

    @cached_property
    def _merges(self) -> tuple[dict[int, int], list[int]]:
        """Rank by pair of ids (as one number), and the merged id by rank."""
        vocab, ranks, made = self._file["model"]["vocab"], {}, []
        for rank, (left, right) in enumerate(self._file["model"]["merges"]):
            ranks[vocab[left] << 20 | vocab[right]] = rank
            made.append(vocab[left + right])
        return ranks, made

    @cached_property
    def _symbols(self) -> tuple[list[int], list[int]]:
        """Ids of the bytes inside a word and at its end."""
        vocab, end = self._file["model"]["vocab"], self._file["model"]["end_of_word_suffix"]
        return [vocab[c] for c in byte_symbols()], [vocab[c + end] for c in byte_symbols()]

    @cached_property
    def strings(self) -> list[str]:
        out = [""] * (1 + max(*self._file["model"]["vocab"].values(), *self._special.values()))
        for text, at in (*self._file["model"]["vocab"].items(), *self._special.items()):
            out[at] = text
        return out

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.file_text)

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        ranks, made = self._merges
        inside, last = self._symbols
        raw = word.encode()
        n = len(raw)
        ids = [inside[b] for b in raw]
        ids[-1] = last[raw[-1]]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            rank = ranks.get(ids[i] << 20 | ids[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if j >= n or ids[i] < 0 or ranks.get(ids[i] << 20 | ids[j]) != rank:
                continue  # stale: one of its symbols has been merged since
            ids[i], ids[j] = made[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(ids[i] << 20 | ids[k])
                if rank is not None:
                    heapq.heappush(queue, rank * n + i)
            k = before[i]
            if k >= 0:
                rank = ranks.get(ids[k] << 20 | ids[i])
                if rank is not None:
                    heapq.heappush(queue, rank * n + k)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> bytes:
        ids = self._words.get(word)
        if ids is None:
            ids = self._old_words.get(word)
            if ids is None:
                ids = array("I", self.merge(word)).tobytes()
            if len(word) < 64:
                self._words[word] = ids
                if len(self._words) >= KEPT_WORDS:
                    self._old_words, self._words = self._words, {}
        return ids

    def _chunk(self, chunk: str) -> bytes:
        """Ids of usual text without white space."""
        ids = self._old_chunks.get(chunk)
        if ids is None:
            ids = b"".join([self._word(x) for x in _PIECES.findall(chunk)])
        if len(chunk) < 64:
            self._chunks[chunk] = ids
            if len(self._chunks) >= KEPT_CHUNKS:
                self._old_chunks, self._chunks = self._chunks, {}
        return ids

    def _plain(self, text: str) -> bytes:
        """Ids of text without special tokens, as little-endian 32-bit numbers."""
        if _UNUSUAL.search(text):
            library = self._library
            split = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
            back = self._bytes_back
            return b"".join([self._word(bytes([back[c] for c in piece]).decode()) for piece, _ in split])
        if not text.isascii():
            # each capital sigma becomes the inner small one, wherever it stands
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        known, make = self._chunks, self._chunk
        return b"".join([known.get(x) or make(x) for x in text.lower().split()])

    @cached_property
    def _bytes_back(self) -> dict[str, int]:
        return {c: b for b, c in enumerate(byte_symbols())}

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if "<|" not in text:
            return self._plain(text)
        parts = self._cuts.split(text)
        special = self._special
        return b"".join([np.array(special[x], dtype="<u4").tobytes() if x in special else self._plain(x) for x in parts])

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        n = len(strings)
        found = [strings[i] for i in np.frombuffer(ids, dtype="<u4").tolist() if i < n]
        return " ".join([x for x in found if x])


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def coder(spark: SparkSession, path: str | None = None) -> Bpe:
    with open(path or default_file(), encoding="utf-8") as file:
        return Bpe(file.read())


def _id_lists(coded: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<i4")))


def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The same rows in smaller arrays: results are handed over as they are made."""
    for batch in batches:
        for start in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def encoder(spark: SparkSession, path: str | None = None):
    """Column function: text to ids (array of int)."""
    shared = ship(spark).broadcast(coder(spark, path))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = Bpe(shared.value.file_text)  # its words are let go when the task ends
        for texts in _parts(batches):
            yield _id_lists([bpe.encode(x.as_py()) for x in texts])

    return encode


def decoder(spark: SparkSession, path: str | None = None):
    """Column function: ids to text; null ids to the empty text."""
    shared = ship(spark).broadcast(coder(spark, path))

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = Bpe(shared.value.file_text)  # its words are let go when the task ends
        for lists in _parts(batches):
            yield pa.array([bpe.decode(np.array(x.as_py() or [], dtype="<u4").tobytes()) for x in lists], pa.string())

    return decode


def digests(spark: SparkSession, path: str | None = None, with_ids: bool = False):
    """Column function: text to the number of ids and the digests of the ids and of the text decoded from them.

    Both directions run in one pass, so that ids need not travel between the engines. ``with_ids`` adds the ids.
    """
    shared = ship(spark).broadcast(coder(spark, path))

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string" + (", ids: array<int>>" if with_ids else ">"))
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = Bpe(shared.value.file_text)  # its words are let go when the task ends
        for texts in _parts(batches):
            counts, ids, decoded, coded = [], [], [], []
            for x in texts:
                own = bpe.encode(x.as_py())
                counts.append(len(own) // 4)
                ids.append(sha256(own).hexdigest())
                decoded.append(sha256(bpe.decode(own).encode()).hexdigest())
                if with_ids:
                    coded.append(own)
            columns = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(_id_lists(coded))
            yield pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return digest


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = digests(spark)
    return documents(spark, sf_dir).select("doc_id", digest("text").alias("d")).select("doc_id", "d.*")
