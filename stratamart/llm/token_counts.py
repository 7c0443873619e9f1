"""Token counts of whole texts: pieces are counted once per distinct pre-token and summed per document.

A pre-token is a run of text that no piece of the model can cross: it starts at a run of spaces (which begin pieces and
never end or split one), and characters that occur in no longer piece, such as digits and line ends, stand alone. The
merges inside a pre-token do not depend on what is around it, so the counts of a text's pre-tokens add up to its own.
Both properties are read from the model; a model without them is refused.

1. All texts are cut; each task hands on its distinct pre-tokens with their number, added up by the shuffle.
2. The library counts the pieces of each distinct pre-token, once.
3. Texts are cut again, to pre-token frequencies. Those of the ``HOT`` most frequent pre-tokens, a table of fixed size
   that every task holds, are summed where they are found: as keys of a join they would be the skewed ones. All others
   are joined by pre-token with their pieces and summed per document. No ids are kept anywhere.

Pre-tokens travel as 64-bit hashes; should two that occur share one, all is done again with another hash.

* null and empty text: no bytes, no tokens. A pre-token or text of any length is counted whole.
* repeated rows count alike. Null ids are kept. Empty table: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, stored
from stratamart.llm.text import Block, blocks, mix, powers, sums_per_text, text_of

HOT = 1 << 18
LIMIT = 4096
HELD = 200_000
SPACE = "▁"
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A piece model, given as the bytes of its file."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        n = self.processor.get_piece_size()
        special = [self.processor.is_control(i) or self.processor.is_unknown(i) or self.processor.is_byte(i) for i in range(n)]
        self.pieces = [self.processor.id_to_piece(i) for i in range(n) if not special[i]]
        joined = {c for piece in self.pieces if len(piece) > 1 for c in piece}
        #: the ASCII characters that occur in no piece of several characters, so that merges never cross them
        self.alone = [b for b in range(128) if chr(b) not in joined and chr(b) != " "]

    def check(self) -> None:
        if any(SPACE in piece.lstrip(SPACE) or " " in piece for piece in self.pieces):
            raise ValueError("pieces of this model reach over the start of a word")
        if not self.alone or self.processor.encode("a  b", out_type=str)[0][0] != SPACE:
            raise ValueError("this model does not put a space before a text")
        for text in ("a  b ", "Ａ  ﬁ e\u0301"):
            if self.processor.decode(self.processor.encode(text)) != text:
                raise ValueError("this model changes texts before it cuts them")

    def counts(self, pre_tokens: list[str]) -> list[int]:
        """Number of pieces of each pre-token, as inside a text."""
        # the library puts a space before what it gets; a pre-token without one follows a character that stands alone
        anchor = chr(self.alone[0])
        begun = [x[1:] if x.startswith(" ") else anchor + x for x in pre_tokens]
        ids = self.processor.encode(begun, num_threads=1)
        return [1 if x == " " else len(own) if x.startswith(" ") else len(own) - 2 for x, own in zip(pre_tokens, ids)]


def cut(block: Block, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the block's pre-tokens; ``alone`` tells for each byte whether it stands alone."""
    data = block.data
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    single, space = alone[data], data == 0x20
    start = single.copy()
    start[1:] |= single[:-1] | (space[1:] & ~space[:-1])
    start[block.offsets[block.offsets < len(data)]] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], len(data))


def begun(texts: pa.Array) -> pa.Array:
    """Texts as the model sees them: a space first, and its own sign for a space as one."""
    plain = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    return pc.if_else(pc.equal(plain, nothing), plain, pc.binary_join_element_wise(space, plain, nothing))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64), n + 1)[starts]).view(np.int64)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])


def _kinds(alone: np.ndarray, base: int):
    """Distinct pre-tokens of a task: hash, text, n."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts)
        keys, first, place = np.unique(table.column("hash").to_numpy(), return_index=True, return_inverse=True)
        n = np.bincount(place, weights=table.column("n").to_numpy()).astype(np.int64)
        return pa.table({"hash": keys, "text": table.column("text").take(pa.array(first)), "n": n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        held = 0
        for batch in batches:
            for block in blocks(begun(batch.column("text"))):
                starts, ends = cut(block, alone)
                if not len(starts):
                    continue
                keys, first, n = np.unique(hashes(block.data, starts, ends, base), return_index=True, return_counts=True)
                parts.append(pa.table({"hash": keys, "text": _strings(block.data, starts[first], ends[first]).cast(pa.binary()), "n": n}))
                held += len(keys)
                if held > 2 * HELD:
                    parts = [merged(parts)]
                    held = parts[0].num_rows
                    if held > HELD:  # more kinds than a worker should hold: the shuffle adds them up
                        yield from parts[0].to_batches(max_chunksize=1 << 14)
                        parts, held = [], 0
        if parts:
            yield from merged(parts).to_batches(max_chunksize=1 << 14)

    return run


def _counted(shared):
    """Column function: pre-token to its number of pieces."""

    @F.arrow_udf("int")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(shared.value)
        for texts in batches:
            yield pa.array(pieces.counts([x.as_py().decode("utf-8", "replace") for x in texts]), pa.int32())

    return counted


def distinct_pre_tokens(docs: DataFrame, model: bytes) -> tuple[DataFrame, int]:
    """hash, n (occurrences in all texts) and pieces of each distinct pre-token; and the hash's base."""
    context = ship(docs.sparkSession)
    pieces = Pieces(model)
    pieces.check()
    alone = np.isin(np.arange(256), pieces.alone)
    shared = context.broadcast(model)
    for base in _BASES:
        kinds = docs.select("text").mapInArrow(_kinds(alone, base), "hash long, text binary, n long")
        kinds = stored(kinds.groupBy("hash", "text").agg(F.sum("n").alias("n")), "pre-tokens")
        if kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").isEmpty():
            return stored(kinds.select("hash", "n", _counted(shared)("text").alias("pieces")), "pieces"), base
    raise ValueError("different pre-tokens share a hash under every base")


def _frequencies(context: SparkContext, hot: pa.Table, alone: np.ndarray, base: int):
    """Column function: text to the tokens of its hot pre-tokens and the frequencies of the others."""
    order = np.argsort(hot.column("hash").to_numpy())
    shared = context.broadcast((hot.column("hash").to_numpy()[order], hot.column("pieces").to_numpy()[order].astype(np.int64)))

    @F.arrow_udf("struct<hot: bigint, rest: array<struct<hash: bigint, n: int>>>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, pieces = shared.value
        for texts in batches:
            for block in blocks(begun(texts)):
                starts, ends = cut(block, alone)
                found = hashes(block.data, starts, ends, base)
                at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
                known = keys[at] == found if len(keys) else np.zeros(len(found), dtype=bool)
                offsets = np.searchsorted(starts, block.offsets)
                own = np.zeros(len(found), dtype=np.int64)
                own[known] = pieces[at[known]]
                text, rest = text_of(offsets)[~known], found[~known]
                order = np.lexsort((rest, text))
                text, rest = text[order], rest[order]
                first = np.ones(len(rest), dtype=bool)
                first[1:] = (rest[1:] != rest[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(first)
                n = np.diff(np.append(first, len(rest))).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(rest[first]), pa.array(n)], names=["hash", "n"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text[first], np.arange(len(block) + 1)).astype(np.int32)), pairs)
                yield pa.StructArray.from_arrays([pa.array(sums_per_text(own, offsets)), lists], names=["hot", "rest"])

    return count


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    with open(path or default_file(), "rb") as file:
        model = file.read()
    docs = docs.select("doc_id", "text")
    kinds, base = distinct_pre_tokens(docs, model)
    frequent = kinds.orderBy(F.desc("n"), "hash").limit(hot).select("hash", "pieces").toArrow()
    alone = np.isin(np.arange(256), Pieces(model).alone)
    count = _frequencies(docs.sparkSession.sparkContext, frequent, alone, base)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select("doc_id", size, F.monotonically_increasing_id().alias("_row"), count("text").alias("c"))
    rows = stored(rows.select("doc_id", "n_bytes", "_row", "c.hot", "c.rest"), "frequencies")
    rest = rows.select("_row", F.inline("rest")).join(kinds.select("hash", "pieces"), "hash")
    rest = rest.groupBy("_row").agg(F.sum(F.col("n") * F.col("pieces")).alias("rest"))
    joined = rows.select("doc_id", "n_bytes", "_row", "hot").join(rest, "_row", "left")
    n_tokens = F.col("hot") + F.coalesce(F.col("rest"), F.lit(0))
    return joined.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
