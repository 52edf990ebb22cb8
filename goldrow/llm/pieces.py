"""SentencePiece encoding and decoding with distinct-chunk tables.

Where no piece of a model holds a white-space marker behind another character, no merge
crosses from a character to a marker. A text then falls into chunks, each a run of markers
and the characters up to the next one, that are segmented on their own. Every block of
texts gets a table of its distinct chunks; each is segmented once, and its ids are joined
back by position. Tables belong to blocks: to move every chunk to a table of the whole
corpus and its ids back costs several times what it saves, see the README.

Decoding joins the bytes of each id's piece from the table of pieces in the same way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.words import as_row, blocks, of_row, schema_with, texts_of

#: White space inside SentencePiece texts.
MARKER = "▁"
_PROBE = "  a b\t\n é é ﬁ A  "
_CHUNK = re.compile(" +[^ ]*")
#: Chunks that go to the library in one call.
CALL_CHUNKS = 16_384
#: Text bytes of a block: larger ones need fewer segmentations and more memory.
BLOCK_BYTES = 12 << 20
#: Ids in one Arrow batch that goes back to Spark.
BATCH_IDS = 1_000_000


@lru_cache(maxsize=2)
def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=2)
def splits_at_markers(model: bytes) -> bool:
    """Whether chunks can be segmented on their own: no piece crosses into a marker, and
    the model changes nothing in a text but to mark its spaces and its start."""
    sp = _processor(model)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    marked = MARKER + _PROBE.replace(" ", MARKER)
    return all(MARKER not in p.lstrip(MARKER) for p in pieces) and sp.normalize(_PROBE) == marked


class _Encoder:
    def __init__(self, model: bytes, end: bool):
        self.sp = _processor(model)
        self.end = [self.sp.eos_id()] if end else []
        self.by_chunk = splits_at_markers(model)

    def encode(self, texts: pa.Array) -> pa.Array:
        """Lists of ids, one per text."""
        if not self.by_chunk:
            ids = self.sp.encode(texts.to_pylist(), num_threads=1)
            return pa.array([i + self.end for i in ids], pa.large_list(pa.int32()))
        texts = pc.replace_substring(texts, MARKER, " ")
        # A text whose words stand one space apart has one chunk per word.
        single = pc.invert(
            pc.or_(
                pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")),
                pc.or_(pc.ends_with(texts, " "), pc.equal(texts, "")),
            )
        )
        chosen = single.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(single), " ")
        if chosen.all():
            return self._segment(lists)
        # Others are cut at runs of markers; a chunk's first marker stays implicit.
        rest = [
            [c[1:] for c in _CHUNK.findall(" " + t)] if t else []
            for t in texts.filter(pc.invert(single)).to_pylist()
        ]
        both = [self._segment(lists), self._segment(pa.array(rest, pa.large_list(pa.large_string())))]
        order = np.concatenate([np.flatnonzero(chosen), np.flatnonzero(~chosen)])
        return pa.concat_arrays(both).take(pa.array(np.argsort(order)))

    def _segment(self, lists: pa.Array) -> pa.Array:
        starts = lists.offsets.to_numpy().astype(np.int64)
        table = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        starts -= starts[0]
        flat, lengths = [], []
        for at in range(0, len(table.dictionary), CALL_CHUNKS):
            chunks = table.dictionary.slice(at, CALL_CHUNKS).to_pylist()
            segmented = self.sp.encode(chunks, num_threads=1)
            for place, chunk in enumerate(chunks):
                if not chunk:  # a single marker; the library leaves out an empty text's marker
                    segmented[place] = [self.sp.piece_to_id(MARKER)]
            lengths.append(np.fromiter(map(len, segmented), np.int64, len(segmented)))
            flat.append(np.fromiter(chain.from_iterable(segmented), np.int32, int(lengths[-1].sum())))
        flat = np.concatenate([*flat, np.array(self.end, np.int32)])
        lengths = np.concatenate([*lengths, [len(self.end)]]).astype(np.int64)
        codes = np.insert(table.indices.to_numpy(), starts[1:], len(table.dictionary))
        ends = starts[1:] + np.arange(1, len(starts))
        return join_back(flat, lengths, codes, np.concatenate([[0], ends]))


def join_back(
    flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray, starts: np.ndarray
) -> pa.Array:
    """Lists made of table entries: entry e is ``flat`` cut by ``lengths``, list i is the
    entries ``codes[starts[i]:starts[i + 1]]``."""
    begins = np.cumsum(lengths) - lengths
    taken = lengths[codes]
    ends = np.cumsum(taken)
    where = np.repeat(begins[codes] - (ends - taken), taken)
    where += np.arange(len(where))
    offsets = np.concatenate([[0], ends])[starts]
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat[where]))


def _small(ids: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded numbers of ids."""
    offsets = ids.offsets.to_numpy()
    start = 0
    while start < len(ids):
        stop = int(np.searchsorted(offsets, offsets[start] + BATCH_IDS, side="right")) - 1
        stop = min(max(stop, start + 1), len(ids))
        yield start, stop
        start = stop


def _encoding(model: bytes, end: bool):
    """Task: rows (row, text) to (row, ids)."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(model, end)
        for block in blocks(batches, "text", BLOCK_BYTES):
            ids = encoder.encode(texts_of(block))
            for start, stop in _small(ids):
                column = ids.slice(start, stop - start).cast(pa.list_(pa.int32()))
                row = block.column("row").slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([row, column], names=["row", "ids"])
            del ids
            pa.default_memory_pool().release_unused()

    return task


def encode(
    df: DataFrame, model_file: str, text: str = "text", out: str = "ids", end: bool = True
) -> DataFrame:
    """Add ``out`` (array<int>): exactly the library's ids of the text, with an end id if
    ``end``. A null text counts as empty. A column of that name is replaced; all other
    columns stay. The model is read on the driver and travels with the tasks.
    """
    kept = [c for c in df.columns if c != out]
    rows = df.select(as_row(kept), F.col(f"`{text}`").alias("text"))
    done = rows.mapInArrow(
        _encoding(_read(model_file), end), schema_with(rows, ["row"], "ids array<int>")
    )
    return done.select(*of_row(kept), F.col("ids").alias(out))


class _Decoder:
    def __init__(self, model: bytes):
        sp = self.sp = _processor(model)
        n = sp.get_piece_size()
        pieces = [self._bytes(i) for i in range(n)]
        self.lengths = np.fromiter(map(len, pieces), np.int64, n)
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.plain = np.array([not sp.is_unknown(i) for i in range(n)])

    def _bytes(self, i: int) -> bytes:
        sp = self.sp
        if sp.is_control(i):
            return b""
        piece = sp.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if sp.is_byte(i) else piece.replace(MARKER, " ").encode()

    def decode(self, lists: pa.Array) -> list[str]:
        starts = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy()[starts[0] : starts[-1]]
        starts -= starts[0]
        joined = join_back(self.flat, self.lengths, ids, starts)
        data, offsets = joined.values.to_numpy().tobytes(), joined.offsets.to_numpy()
        odd = np.flatnonzero(~self.plain[ids])
        unknown = set(np.searchsorted(starts, odd, side="right") - 1)
        out = []
        for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            own = slice(starts[row], starts[row + 1])
            try:
                if row in unknown:
                    raise UnicodeError
                text = data[a:b].decode()
            except UnicodeError:  # ids that no text gives; the library has its own rules
                out.append(self.sp.decode(ids[own].tolist()))
                continue
            out.append(text[1:] if text.startswith(" ") else text)
        return out


def _decoding(model: bytes):
    """Task: rows (row, ids) to (row, ids, decoded)."""

    def task(batches) -> Iterator[pa.RecordBatch]:
        decoder = _Decoder(model)
        empty = pa.scalar([], pa.list_(pa.int32()))
        for batch in batches:
            texts = pa.array(decoder.decode(pc.fill_null(batch.column("ids"), empty)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=["row", "ids", "decoded"])

    return task


def decode(df: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (string): exactly the library's text of the ids; null ids give ''."""
    kept = [c for c in df.columns if c != out]
    rows = df.select(as_row(kept), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    schema = schema_with(rows, ["row", "ids"], "decoded string")
    done = rows.mapInArrow(_decoding(_read(model_file)), schema)
    return done.select(*of_row(kept), F.col("decoded").alias(out))


def round_trip(
    df: DataFrame,
    model_file: str,
    text: str = "text",
    ids: str = "ids",
    out: str = "decoded",
    end: bool = True,
) -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one pass; the text is left out."""
    model = _read(model_file)
    kept = [c for c in df.columns if c not in (text, ids, out)]
    rows = df.select(as_row(kept), F.col(f"`{text}`").alias("text"))
    schema = schema_with(rows, ["row"], "ids array<int>, decoded string")
    first, then = _encoding(model, end), _decoding(model)
    done = rows.mapInArrow(lambda batches: then(first(batches)), schema)
    return done.select(*of_row(kept), F.col("ids").alias(ids), F.col("decoded").alias(out))


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
